"""The four marts (M1-M4) over staged events.

Plan shape (the point of this module)
-------------------------------------
A SQL star of per-event-type CTEs scans the events once per CTE (four
scans, four partial aggregates, four shuffles). Here each mart reads the
events ONCE: a single ``groupBy`` with conditional aggregates computes the
per-type metrics side by side, and the map-side partial aggregate shrinks
thousands of events per match to one row per group before the only
event-sized shuffle. The star is then re-formed from that one small
aggregate, which keeps the left-join semantics exact:

- player mart: the spine is every (match, team, player) with a player; each
  per-type row joins on (match, player) only, so a name used by two teams of
  a match fans out exactly like the star of CTEs does;
- team mart: the spine is the pass rows per (match, team, home, away);
  the other types join on (match, team).

The star is re-formed from that one small aggregate by grouping it once
more on the join key and exploding the short per-key lists (no self-join,
so the optimizer cannot split the aggregate into one copy per branch). A
hot key (say a third of all events in one match) costs nothing extra:
partial aggregation emits one row per key per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import (count_when, false_if_null, is_true, merge_states, round_half, safe_pct,
                                 state_mean, state_sum, sum_state, zero_if_null)
from ..functions.events import home_away, is_goal, is_on_target, time_bracket
from ..schema import DRIBBLE, PASS, PRESSURE, SHOT

def _is(t: str) -> Column:
    return F.col("event_type") == F.lit(t)


def _has(count_field: str):
    """Array-filter predicate: entries whose count field is positive."""
    return lambda x: x[count_field] > 0


# ----------------------------------------------------------------------------
# M1 player performance
# ----------------------------------------------------------------------------

PLAYER_COLUMNS = [
    "match_id", "team_name", "player_name",
    "total_passes", "completed_passes", "incomplete_passes", "pass_completion_pct",
    "avg_pass_length", "goal_assists", "shot_assists", "crosses", "through_balls",
    "total_shots", "goals", "shots_on_target", "total_xg", "avg_xg_per_shot",
    "first_time_shots", "one_on_ones",
    "total_dribbles", "successful_dribbles", "dribble_success_pct",
]


def player_aggregates(events: DataFrame) -> DataFrame:
    """One pass: per (match, team, player) all pass, shot and dribble metrics."""
    p, s, d = _is(PASS), _is(SHOT), _is(DRIBBLE)
    agg = events.groupBy("match_id", "team_name", "player_name").agg(
        F.count_if(p).alias("total_passes"),
        count_when(p & F.col("pass_outcome").isNull()).alias("completed_passes"),
        count_when(p & (F.col("pass_outcome") == "Incomplete")).alias("incomplete_passes"),
        sum_state(F.when(p, F.col("pass_length"))).alias("pass_length"),
        count_when(p & is_true("pass_goal_assist")).alias("goal_assists"),
        count_when(p & is_true("pass_shot_assist")).alias("shot_assists"),
        count_when(p & is_true("pass_cross")).alias("crosses"),
        count_when(p & is_true("pass_through_ball")).alias("through_balls"),
        F.count_if(s).alias("total_shots"),
        count_when(s & (F.col("shot_outcome") == "Goal")).alias("goals"),
        count_when(s & (F.col("shot_outcome") == "On Target")).alias("shots_on_target"),
        sum_state(F.when(s, F.col("shot_xg"))).alias("shot_xg"),
        count_when(s & is_true("shot_first_time")).alias("first_time_shots"),
        count_when(s & is_true("shot_one_on_one")).alias("one_on_ones"),
        F.count_if(d).alias("total_dribbles"),
        count_when(d & (F.col("dribble_outcome") == "Complete")).alias("successful_dribbles"),
    )
    agg = agg.withColumns({"xg": state_sum("shot_xg"), "avg_pass_length": round_half(state_mean("pass_length"), 2)})
    return agg.withColumns({
        "total_xg": round_half("xg", 3),
        "avg_xg_per_shot": round_half(F.try_divide("xg", F.col("shot_xg.n")), 3)}).drop("xg", "pass_length", "shot_xg")


_PASS_METRICS = ["total_passes", "completed_passes", "incomplete_passes", "avg_pass_length",
                 "goal_assists", "shot_assists", "crosses", "through_balls"]
_SHOT_METRICS = ["total_shots", "goals", "shots_on_target", "total_xg", "avg_xg_per_shot",
                 "first_time_shots", "one_on_ones"]
_DRIBBLE_METRICS = ["total_dribbles", "successful_dribbles"]


def _player_final(joined: DataFrame) -> DataFrame:
    doubles = {"avg_pass_length", "total_xg", "avg_xg_per_shot"}
    out = []
    for c in PLAYER_COLUMNS:
        if c == "pass_completion_pct":
            out.append(safe_pct("completed_passes", "total_passes").alias(c))
        elif c == "dribble_success_pct":
            out.append(safe_pct("successful_dribbles", "total_dribbles").alias(c))
        elif c in ("match_id", "team_name", "player_name"):
            out.append(F.col(c))
        else:
            out.append(zero_if_null(c, "double" if c in doubles else "bigint").alias(c))
    return joined.select(*out)


def mart_player_performance(events: DataFrame, by_team: bool = False) -> DataFrame:
    """M1, exact star semantics (spine of players; joins on match and player).

    ``by_team=True`` adds the team to the join key (no fan-out when two teams
    of a match share a name): that star is exactly the single aggregate, so
    it is computed as ``mart_player_single_pass``.

    The per-(match, team, player) aggregate is grouped once more by (match,
    player); each group holds one entry per team that used the name in the
    match (home, away, at most a null team), so the collected lists are
    bounded by the teams of one match. Exploding spine x passes x shots x
    dribbles per group reproduces the left-join star, fan-out included,
    without a self-join: one scan of the events, two exchanges (the second
    one over the small aggregate).
    """
    if by_team:
        return mart_player_single_pass(events)
    key = ["match_id", "player_name"]
    agg = player_aggregates(events).filter(F.col("player_name").isNotNull())
    metrics = [c for c in agg.columns if c not in ("match_id", "player_name")]
    per = agg.groupBy(*key).agg(F.collect_list(F.struct(*metrics)).alias("rows"))
    star = per.select(*key, "rows", F.explode("rows").alias("s"))
    for side, n in (("pa", "total_passes"), ("sh", "total_shots"), ("dr", "total_dribbles")):
        # a null match never joins, not even to itself
        joined = F.when(F.col("match_id").isNotNull(), F.filter("rows", _has(n)))
        star = star.select("*", F.explode_outer(joined).alias(side))
    cols = [F.col("match_id"), F.col("s.team_name").alias("team_name"), F.col("player_name")]
    cols += [F.col(f"pa.{c}").alias(c) for c in _PASS_METRICS]
    cols += [F.col(f"sh.{c}").alias(c) for c in _SHOT_METRICS]
    cols += [F.col(f"dr.{c}").alias(c) for c in _DRIBBLE_METRICS]
    return _player_final(star.select(*cols))


def mart_player_single_pass(events: DataFrame) -> DataFrame:
    """M1 as one aggregate, no joins.

    Equal to ``mart_player_performance`` when a (match, player) name belongs
    to one team; with a name shared by both teams of a match it keeps one
    row per team instead of the star's fan-out.
    """
    agg = player_aggregates(events).filter(F.col("player_name").isNotNull())
    return _player_final(agg)


# ----------------------------------------------------------------------------
# M2 team summary
# ----------------------------------------------------------------------------

TEAM_COLUMNS = [
    "match_id", "team_name", "home_team", "away_team", "home_away",
    "total_passes", "completed_passes", "pass_completion_pct", "avg_pass_length",
    "crosses", "through_balls", "assists",
    "total_shots", "goals", "shots_saved", "total_xg", "one_on_ones",
    "total_dribbles", "successful_dribbles", "total_pressures",
]


def team_aggregates(events: DataFrame) -> DataFrame:
    """One pass: per (match, team, home, away) counts and unrounded sums."""
    p, s, d, pr = _is(PASS), _is(SHOT), _is(DRIBBLE), _is(PRESSURE)
    pl = F.when(p, F.col("pass_length"))
    counted = events.filter(F.col("event_type").isin(PASS, SHOT, DRIBBLE, PRESSURE))
    return counted.groupBy("match_id", "team_name", "home_team", "away_team").agg(
        F.count_if(p).alias("total_passes"),
        count_when(p & F.col("pass_outcome").isNull()).alias("completed_passes"),
        count_when(p & is_true("pass_cross")).alias("crosses"),
        count_when(p & is_true("pass_through_ball")).alias("through_balls"),
        count_when(p & is_true("pass_goal_assist")).alias("assists"),
        sum_state(pl).alias("pass_length"),
        F.count_if(s).alias("total_shots"),
        count_when(s & (F.col("shot_outcome") == "Goal")).alias("goals"),
        count_when(s & (F.col("shot_outcome") == "Saved")).alias("shots_saved"),
        sum_state(F.when(s, F.col("shot_xg"))).alias("shot_xg"),
        count_when(s & is_true("shot_one_on_one")).alias("one_on_ones"),
        F.count_if(d).alias("total_dribbles"),
        count_when(d & (F.col("dribble_outcome") == "Complete")).alias("successful_dribbles"),
        F.count_if(pr).alias("total_pressures"),
    )


def mart_team_summary(events: DataFrame) -> DataFrame:
    """M2, exact star semantics: spine = pass groups; others join on (match, team).

    The per-(match, team, home, away) aggregate is grouped once more by
    (match, team): the pass rows of the group are the spine (kept as a short
    list, one entry per home/away pairing of the match) and the shot,
    dribble and pressure sums are what the (match, team) side tables of the
    star hold. A null key never matches in the star, so its side metrics
    are null (then 0) here too. One scan, two exchanges.
    """
    key = ["match_id", "team_name"]
    agg = team_aggregates(events)
    spine_cols = ["home_team", "away_team", "total_passes", "completed_passes", "crosses",
                  "through_balls", "assists", "pass_length"]
    side_sums = ["total_shots", "goals", "shots_saved", "one_on_ones",
                 "total_dribbles", "successful_dribbles", "total_pressures"]
    per = agg.groupBy(*key).agg(
        F.collect_list(F.struct(*spine_cols)).alias("rows"),
        merge_states("shot_xg").alias("shot_xg"), *[F.sum(c).alias(c) for c in side_sums])
    spine = per.select("*", F.explode(F.filter("rows", lambda x: x["total_passes"] > 0)).alias("p"))
    joinable = F.col("match_id").isNotNull() & F.col("team_name").isNotNull()

    def side(value, present):
        return F.when(joinable & present, value)

    has_shots = F.col("total_shots") > 0
    has_dribbles = F.col("total_dribbles") > 0
    joined = spine.select(
        *key, "p.home_team", "p.away_team", "p.total_passes", "p.completed_passes",
        round_half(state_mean("p.pass_length"), 2).alias("avg_pass_length"),
        "p.crosses", "p.through_balls", "p.assists",
        side(F.col("total_shots"), has_shots).alias("total_shots"),
        side(F.col("goals"), has_shots).alias("goals"),
        side(F.col("shots_saved"), has_shots).alias("shots_saved"),
        side(round_half(state_sum("shot_xg"), 3), has_shots).alias("total_xg"),
        side(F.col("one_on_ones"), has_shots).alias("one_on_ones"),
        side(F.col("total_dribbles"), has_dribbles).alias("total_dribbles"),
        side(F.col("successful_dribbles"), has_dribbles).alias("successful_dribbles"),
        side(F.col("total_pressures"), F.col("total_pressures") > 0).alias("total_pressures"))
    doubles = {"avg_pass_length", "total_xg"}
    out = []
    for c in TEAM_COLUMNS:
        if c == "home_away":
            out.append(home_away().alias(c))
        elif c == "pass_completion_pct":
            out.append(safe_pct("completed_passes", "total_passes").alias(c))
        elif c in ("match_id", "team_name", "home_team", "away_team"):
            out.append(F.col(c))
        else:
            out.append(zero_if_null(c, "double" if c in doubles else "bigint").alias(c))
    return joined.select(*out)


# ----------------------------------------------------------------------------
# M3 shot analysis
# ----------------------------------------------------------------------------

def mart_shot_analysis(events: DataFrame) -> DataFrame:
    """M3: one row per shot with flags and a time bracket. Narrow: no shuffle."""
    shots = events.filter(_is(SHOT))
    return shots.select(
        "event_id", "match_id", "home_team", "away_team", "team_name", "player_name",
        "period", "minute", "second", "play_pattern",
        "shot_outcome", "shot_body_part", "shot_technique", "shot_type",
        zero_if_null("shot_xg", "double").alias("shot_xg"),
        false_if_null("shot_first_time").alias("is_first_time"),
        false_if_null("shot_one_on_one").alias("is_one_on_one"),
        false_if_null("shot_open_goal").alias("is_open_goal"),
        false_if_null("under_pressure").alias("is_under_pressure"),
        is_goal("shot_outcome").alias("is_goal"),
        is_on_target("shot_outcome").alias("is_on_target"),
        time_bracket("minute").alias("time_bracket"),
        "location",
    )


# ----------------------------------------------------------------------------
# M4 pass network
# ----------------------------------------------------------------------------

NETWORK_KEYS = ["match_id", "home_team", "away_team", "team_name", "passer_name", "recipient_name"]
NETWORK_COLUMNS = NETWORK_KEYS + [
    "total_passes", "completed_passes", "incomplete_passes", "completion_pct",
    "avg_pass_length", "min_pass_length", "max_pass_length",
    "crosses", "through_balls", "switches", "goal_assists", "shot_assists", "avg_minute",
]


def valid_edges(events: DataFrame) -> DataFrame:
    """Passes with both ends named (F1 + F2), renamed to an edge list."""
    return (events.filter(_is(PASS) & F.col("player_name").isNotNull()
                          & F.col("pass_recipient_name").isNotNull())
                  .withColumnsRenamed({"player_name": "passer_name",
                                       "pass_recipient_name": "recipient_name"}))


def mart_pass_networks(events: DataFrame, min_passes: int = 2, ordered: bool = False) -> DataFrame:
    """M4: directed weighted edges per match and team, at least ``min_passes``.

    ``ordered`` adds the presentation sort (match, team, passes desc); a
    stored table or a downstream aggregate does not need it, and at scale it
    is a full range-partitioning shuffle, so it is off by default.
    """
    edges = valid_edges(events)
    completed = count_when(F.col("pass_outcome").isNull())
    net = edges.groupBy(*NETWORK_KEYS).agg(
        F.count(F.lit(1)).alias("total_passes"),
        completed.alias("completed_passes"),
        count_when(F.col("pass_outcome") == "Incomplete").alias("incomplete_passes"),
        sum_state("pass_length").alias("pass_length"),
        round_half(F.min("pass_length"), 2).alias("min_pass_length"),
        round_half(F.max("pass_length"), 2).alias("max_pass_length"),
        count_when(is_true("pass_cross")).alias("crosses"),
        count_when(is_true("pass_through_ball")).alias("through_balls"),
        count_when(is_true("pass_switch")).alias("switches"),
        count_when(is_true("pass_goal_assist")).alias("goal_assists"),
        count_when(is_true("pass_shot_assist")).alias("shot_assists"),
        # whole numbers add up exactly as they are
        round_half(F.try_divide(F.sum("minute"), F.count("minute")), 1).alias("avg_minute"),
    )
    net = (net.filter(F.col("total_passes") >= min_passes)
              .withColumns({"completion_pct": safe_pct("completed_passes", "total_passes"),
                            "avg_pass_length": round_half(state_mean("pass_length"), 2)})
              .select(*NETWORK_COLUMNS))
    if ordered:
        net = net.orderBy(F.col("match_id").asc_nulls_first(), F.col("team_name").asc_nulls_first(),
                          F.col("total_passes").desc())
    return net
