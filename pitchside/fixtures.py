"""Deterministic staged match events derived from the test tables.

F-ME: every ``events`` row becomes one staged event (39 columns) of match
``event_id div 500``; home/away teams come from ``nation``. Work grows with
the ``events`` table; the builder is one scan plus two broadcast joins to a
25-row dimension, all in one codegen stage (no shuffle).

Variants
- ``fanout``: player ids modulo 21 instead of 22, so the same player name
  plays for both teams of a match (join fan-out case).
- ``dirty``: period 9 on ``event_id % 1700 = 0``, null team on
  ``event_id % 2300 = 7`` and a duplicate of each ``event_id % 3100 = 0``
  row (negative cases for the quality rules). These inject faults into the
  full table; no row is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.joins import broadcast_if_small
from .sources.tables import read_table

EVENTS_PER_MATCH = 500
N_NATIONS = 25


# The staged columns as Spark SQL expressions over (seq, k, user_id, value,
# event_type, ...): one ``selectExpr`` builds all 39 in a single call;
# ``{n}`` is the squad size (22, or 21 for the fan-out variant).
_FME_COLUMNS = [
    'event_id',
    'match_id',
    'seq as event_index',
    'case when seq < 250 then 1 else 2 end as period',
    'cast(seq div 5 as int) as minute',
    'cast(seq * 12 % 60 as int) as second',
    "concat('00:', lpad(cast(seq % 250 div 5 as string), 2, '0'), ':', lpad(cast(seq * 12 % 60 as string), 2, '0'), '.000') as event_timestamp",
    'home_team',
    'away_team',
    'event_type',
    'team_name',
    "case when k = 0 then null else concat('Player#', cast(user_id % {n} as string)) end as player_name",
    'case when k = 0 then null else user_id % {n} end as player_id',
    "concat('Position', cast(user_id % {n} div 2 as string)) as player_position",
    "concat('Pattern', cast(k % 4 as string)) as play_pattern",
    'case when k % 3 = 0 then true end as under_pressure',
    "case when event_type = 'Pass' then value end as pass_length",
    "case when event_type = 'Pass' then cast(k - 50 as double) / 16 end as pass_angle",
    "case when event_type = 'Pass' then concat('Height', cast(k % 3 as string)) end as pass_height",
    "case when event_type = 'Pass' then concat('Body', cast(k % 2 as string)) end as pass_body_part",
    "case when event_type = 'Pass' and k between 75 and 89 then 'Incomplete' when event_type = 'Pass' and k >= 90 then 'Out' end as pass_outcome",
    "case when event_type = 'Pass' and k % 7 = 0 then 'Corner' end as pass_type",
    "case when event_type = 'Pass' and k % 10 = 1 then true end as pass_cross",
    "case when event_type = 'Pass' and k % 20 = 7 then true end as pass_switch",
    "case when event_type = 'Pass' and k % 25 = 3 then true end as pass_through_ball",
    "case when event_type = 'Pass' and k % 50 = 11 then true end as pass_goal_assist",
    "case when event_type = 'Pass' and k % 12 = 5 then true end as pass_shot_assist",
    "case when event_type = 'Pass' and k < 90 then concat('Player#', cast((user_id + 2 + 2 * (k % 2)) % {n} as string)) end as pass_recipient_name",
    "case when event_type = 'Shot' then value / 500 end as shot_xg",
    "case when event_type = 'Shot' and k < 12 then 'Goal' when event_type = 'Shot' and k < 40 then 'Saved' when event_type = 'Shot' and k < 70 then 'Off T' when event_type = 'Shot' and k < 95 then 'Blocked' end as shot_outcome",
    "case when event_type = 'Shot' then concat('Body', cast(k % 3 as string)) end as shot_body_part",
    "case when event_type = 'Shot' then concat('Tech', cast(k % 5 as string)) end as shot_technique",
    "case when event_type = 'Shot' then case when k % 20 = 0 then 'Penalty' else 'Open Play' end end as shot_type",
    "case when event_type = 'Shot' and k % 4 = 0 then true end as shot_first_time",
    "case when event_type = 'Shot' and k % 9 = 0 then true end as shot_one_on_one",
    "case when event_type = 'Shot' and k % 33 = 0 then true end as shot_open_goal",
    'case when k % 6 = 1 then array(cast(k as double), cast(seq % 80 as double)) end as carry_end_location',
    "case when event_type = 'Dribble' and k < 55 then 'Complete' when event_type = 'Dribble' then 'Incomplete' end as dribble_outcome",
    'array(cast(seq % 120 as double), cast(k % 80 as double)) as location',
]


def match_events(spark: SparkSession, sf_dir: str, variant: str = "me") -> DataFrame:
    squad = 21 if variant == "fanout" else 22
    ev = read_table(spark, sf_dir, "events", ["event_id", "event_type", "value", "user_id", "props"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])

    e = ev.selectExpr("event_id", "event_type as et", "value", "user_id",
                      "cast(get_json_object(props, '$.k') as int) as k",
                      f"event_id div {EVENTS_PER_MATCH} as match_id", f"event_id % {EVENTS_PER_MATCH} as seq")
    # one broadcast of the 25-row dimension serves both lookups (same plan, reused exchange)
    home = broadcast_if_small(nation).alias("h")
    away = broadcast_if_small(nation).alias("a")
    m = (e.join(home, F.col("h.n_nationkey") == F.col("match_id") % N_NATIONS)
          .join(away, F.col("a.n_nationkey") == (F.col("match_id") + 7) % N_NATIONS)
          .select(*[F.col(c) for c in e.columns], F.col("h.n_name").alias("home_team"),
                  F.col("a.n_name").alias("away_team")))
    b = m.selectExpr(
        "*", "case when user_id % 2 = 0 then home_team else away_team end as team_name",
        "case et when 'click' then 'Pass' when 'view' then 'Pass' when 'purchase' then 'Shot' "
        "when 'signup' then 'Dribble' else 'Pressure' end as event_type")
    out = b.selectExpr(*[c.format(n=squad) for c in _FME_COLUMNS])
    if variant == "dirty":
        out = make_dirty(out)
    return out


def make_dirty(fme: DataFrame) -> DataFrame:
    """F-DIRTY: inject rule violations into every qualifying row (no sampling).

    The duplicate of a row is generated in place (a narrow ``explode`` of a
    one- or two-element array), so the events are scanned once.
    """
    eid = F.col("event_id")
    copies = F.when(eid % 3100 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    dirty = (fme.withColumn("period", F.when(eid % 1700 == 0, F.lit(9)).otherwise(F.col("period")))
                .withColumn("team_name", F.when(eid % 2300 == 7, F.lit(None).cast("string"))
                            .otherwise(F.col("team_name"))))
    return dirty.select("*", F.explode(copies).alias("_copy")).drop("_copy")


def matches_dim(fme: DataFrame, competitions: DataFrame | None = None) -> DataFrame:
    """Match catalogue from the events: teams and goals per side.

    With ``competitions`` each match gets the (competition_id, season_id) of
    its home nation (season_name = home team), joined behind a size check.
    """
    goal = (F.col("event_type") == "Shot") & (F.col("shot_outcome") == "Goal")
    dim = (fme.groupBy("match_id", "home_team", "away_team")
              .agg(F.count_if(goal & (F.col("team_name") == F.col("home_team"))).alias("home_score"),
                   F.count_if(goal & (F.col("team_name") == F.col("away_team"))).alias("away_score")))
    if competitions is None:
        return dim
    comp = competitions.select("competition_id", "season_id", F.col("season_name").alias("home_team"))
    return dim.join(broadcast_if_small(comp), "home_team", "left").select(
        "match_id", "competition_id", "season_id", "home_team", "away_team", "home_score", "away_score")


def competitions_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Competition catalogue from region x nation."""
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    return (nation.join(broadcast_if_small(region), F.col("n_regionkey") == F.col("r_regionkey"))
                  .select(F.col("r_regionkey").cast("int").alias("competition_id"),
                          F.col("n_nationkey").cast("int").alias("season_id"),
                          F.col("r_name").alias("competition_name"),
                          F.col("n_name").alias("season_name")))
