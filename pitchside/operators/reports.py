"""Reports over the marts.

Each top-k report is an aggregate of a mart followed by ``orderBy(...)
.limit(k)``, which Spark plans as TakeOrderedAndProject: every task keeps
its own k best rows and only those reach the final merge, so no global
sort happens. Ties on the ranking value are broken by the group keys
(nulls last) so the k rows are deterministic.

Means of per-match percentages are unweighted on purpose (a match with few
passes counts as much as a busy one).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import exact_mean, exact_sum, merge_states, round_half, state_mean, sum_state


def _top(df: DataFrame, by: str, keys: list[str], k: int) -> DataFrame:
    order: list[Column] = [F.col(by).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in keys]
    return df.orderBy(*order).limit(k)


def report_top_players(player_mart: DataFrame, k: int = 10) -> DataFrame:
    keys = ["player_name", "team_name"]
    agg = player_mart.groupBy(*keys).agg(
        F.sum("total_passes").alias("passes"),
        round_half(exact_mean("pass_completion_pct"), 1).alias("avg_completion_pct"),
        F.sum("goals").alias("goals"),
        round_half(exact_sum("total_xg"), 2).alias("total_xg"),
    )
    return _top(agg, "passes", keys, k)


def report_teams(team_mart: DataFrame, k: int = 10) -> DataFrame:
    keys = ["team_name"]
    agg = team_mart.groupBy(*keys).agg(
        F.sum("total_passes").alias("passes"),
        round_half(exact_mean("pass_completion_pct"), 1).alias("avg_completion_pct"),
        F.sum("total_shots").alias("shots"),
        F.sum("goals").alias("goals"),
        round_half(exact_sum("total_xg"), 2).alias("total_xg"),
    )
    return _top(agg, "goals", keys, k)


def report_time_brackets(shot_mart: DataFrame) -> DataFrame:
    """Shots, goals and mean xG per bracket, in bracket (lexical) order."""
    return (shot_mart.groupBy("time_bracket").agg(
                F.count(F.lit(1)).alias("shots"),
                F.sum(F.when(F.col("is_goal"), 1).otherwise(0)).alias("goals"),
                round_half(exact_mean("shot_xg"), 3).alias("avg_xg"))
            .orderBy(F.col("time_bracket").asc_nulls_last()))


def report_pass_combinations(network: DataFrame, k: int = 15) -> DataFrame:
    keys = ["passer_name", "recipient_name", "team_name"]
    agg = network.groupBy(*keys).agg(
        F.sum("total_passes").alias("total_passes"),
        round_half(exact_mean("completion_pct"), 1).alias("avg_completion_pct"),
        round_half(exact_mean("avg_pass_length"), 1).alias("avg_length"),
        F.sum("goal_assists").alias("goal_assists"),
        F.sum("shot_assists").alias("shot_assists"),
    )
    return _top(agg, "total_passes", keys, k)


def report_hubs(network: DataFrame, k: int = 10, approximate: bool = False) -> DataFrame:
    """Players with the most distinct recipients (out-degree).

    Exact form: two plain aggregations instead of a distinct aggregate (which
    would expand every row): first per (passer, team, recipient), carrying
    pass totals and the exact sum state of the completion rates, then
    per (passer, team), where counting the non-null recipient keys is the
    distinct count and the carried sums give the unweighted mean over all
    network rows. ``approximate`` uses a HyperLogLog++ sketch in one pass.
    """
    keys = ["passer_name", "team_name"]
    if approximate:
        agg = network.groupBy(*keys).agg(
            F.approx_count_distinct("recipient_name").alias("unique_recipients"),
            F.sum("total_passes").alias("total_passes_made"),
            round_half(exact_mean("completion_pct"), 1).alias("avg_completion_pct"))
        return _top(agg, "unique_recipients", keys, k)
    pairs = network.groupBy(*keys, "recipient_name").agg(
        F.sum("total_passes").alias("passes"),
        sum_state("completion_pct").alias("pct"))
    agg = pairs.groupBy(*keys).agg(
        F.count("recipient_name").alias("unique_recipients"),
        F.sum("passes").alias("total_passes_made"),
        round_half(state_mean(merge_states("pct")), 1).alias("avg_completion_pct"))
    return _top(agg, "unique_recipients", keys, k)


def report_dangerous_links(network: DataFrame, k: int = 10) -> DataFrame:
    keys = ["passer_name", "recipient_name", "team_name"]
    agg = (network.filter((F.col("goal_assists") > 0) | (F.col("shot_assists") > 0))
                  .groupBy(*keys).agg(
                      F.sum("total_passes").alias("total_passes"),
                      F.sum("goal_assists").alias("goal_assists"),
                      F.sum("shot_assists").alias("shot_assists"),
                      (F.sum("goal_assists") + F.sum("shot_assists")).alias("total_chances_created")))
    return _top(agg, "total_chances_created", keys, k)


def list_competitions(competitions: DataFrame, name: str | None = None) -> DataFrame:
    """Competitions (optionally one name): ids and season."""
    df = competitions if name is None else competitions.filter(F.col("competition_name") == name)
    return df.select("competition_id", "season_id", "competition_name", "season_name")


def list_matches(matches: DataFrame, competition_id: int | None = None,
                 season_id: int | None = None) -> DataFrame:
    """Match catalogue with scores, optionally for one competition season."""
    df = matches
    if competition_id is not None:
        df = df.filter(F.col("competition_id") == competition_id)
    if season_id is not None:
        df = df.filter(F.col("season_id") == season_id)
    return df.select("match_id", "home_team", "away_team", "home_score", "away_score")


def first_n_matches(matches: DataFrame, n: int) -> DataFrame:
    """The first n matches of the catalogue, in match_id order."""
    return matches.orderBy(F.col("match_id").asc_nulls_last()).limit(n)


def dataset_profile(events: DataFrame) -> DataFrame:
    """Events, matches, teams and column count (R9, A8): distinct counts over
    the (match, team) groups, so the events are not expanded per distinct."""
    pairs = events.groupBy("match_id", "team_name").agg(F.count(F.lit(1)).alias("n"))
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_events"),
        F.count_distinct("match_id").alias("n_matches"),
        F.count_distinct("team_name").alias("n_teams"),
        F.lit(len(events.columns)).cast("bigint").alias("n_columns"),
    )
