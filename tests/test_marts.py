"""Mart invariants and plan shape."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, SF001
from pitchside.fixtures import match_events
from pitchside.operators import marts, reports


@pytest.fixture(scope="module")
def fme(spark):
    return match_events(spark, SF001).cache()


def test_pass_counts_are_consistent(fme):
    bad = marts.mart_player_performance(fme).filter(
        F.col("completed_passes") + F.col("incomplete_passes") > F.col("total_passes")).count()
    assert bad == 0


def test_goals_not_above_shots(fme):
    assert marts.mart_team_summary(fme).filter(F.col("goals") > F.col("total_shots")).count() == 0


def test_network_passes_within_player_passes(fme):
    net = marts.mart_pass_networks(fme).agg(F.sum("total_passes")).first()[0]
    ply = marts.mart_player_performance(fme).agg(F.sum("total_passes")).first()[0]
    assert net <= ply


def test_player_totals_within_team_totals(fme):
    p = marts.mart_player_performance(fme).groupBy("match_id", "team_name").agg(F.sum("total_passes").alias("p"))
    t = marts.mart_team_summary(fme).select("match_id", "team_name", "total_passes")
    assert p.join(t, ["match_id", "team_name"]).filter(F.col("p") > F.col("total_passes")).count() == 0


def test_single_pass_equals_star(fme):
    a = marts.mart_player_performance(fme)
    b = marts.mart_player_single_pass(fme)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0


def test_fanout_keeps_star_semantics(spark):
    fan = match_events(spark, SF001, "fanout")
    assert marts.mart_player_performance(fan).count() == 5418
    assert marts.mart_player_single_pass(fan).count() == 840


def test_players_without_actions_are_kept(fme):
    # a player with only pressures has zeros, not a missing row
    only_press = (fme.filter(F.col("player_name").isNotNull())
                     .groupBy("match_id", "team_name", "player_name")
                     .agg(F.count_if(F.col("event_type") != "Pressure").alias("n"))
                     .filter("n = 0"))
    mart = marts.mart_player_performance(fme)
    assert only_press.join(mart, ["match_id", "team_name", "player_name"], "left_anti").count() == 0


def _event_scans(plan: str) -> int:
    return sum(1 for line in plan.splitlines() if "FileScan" in line and "events.parquet" in line)


def test_player_mart_scans_events_once(fme, spark):
    ev = match_events(spark, SF0001)
    plan = marts.mart_player_performance(ev)._jdf.queryExecution().executedPlan().toString()
    assert _event_scans(plan) == 1


def test_team_mart_scans_events_once(spark):
    ev = match_events(spark, SF0001)
    plan = marts.mart_team_summary(ev)._jdf.queryExecution().executedPlan().toString()
    assert _event_scans(plan) == 1


def test_shot_mart_has_no_shuffle(spark):
    ev = match_events(spark, SF0001)
    plan = marts.mart_shot_analysis(ev)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan


def test_event_type_filter_is_pushed_to_scan(spark):
    from pitchside.sources.tables import read_table
    df = read_table(spark, SF001, "events").filter(F.col("event_type") == "error").select("ts")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan


def test_network_order_option(fme):
    rows = marts.mart_pass_networks(fme, ordered=True).select("match_id", "team_name", "total_passes").collect()
    keys = [(r.match_id, r.team_name, -r.total_passes) for r in rows]
    assert keys == sorted(keys)


def test_top_k_is_take_ordered(fme):
    plan = reports.report_teams(marts.mart_team_summary(fme))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_time_brackets_cover_every_label(fme):
    got = [r.time_bracket for r in reports.report_time_brackets(marts.mart_shot_analysis(fme)).collect()]
    assert got == ["0-15", "15-30", "30-45", "45-60", "60-75", "75+"]


def test_hubs_approximate_close_to_exact(fme):
    net = marts.mart_pass_networks(fme)
    exact = {(r.passer_name, r.team_name): r.unique_recipients for r in reports.report_hubs(net, k=1000).collect()}
    approx = {(r.passer_name, r.team_name): r.unique_recipients
              for r in reports.report_hubs(net, k=1000, approximate=True).collect()}
    assert exact == approx  # small distinct counts are exact in HLL++


def test_no_key_plans_a_cartesian_or_nested_loop_join(spark):
    from pitchside.registry import QUERIES, SIDE_EFFECT_KEYS
    for key, fn in QUERIES.items():
        if key in SIDE_EFFECT_KEYS:
            continue
        plan = fn(spark, SF0001)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan, key
        assert "NestedLoopJoin" not in plan, key


def test_ingest_split_is_a_broadcast_anti_join(spark):
    from pitchside.operators import quality as Q
    ev = match_events(spark, SF0001, "dirty")
    v = Q.violations(ev, Q.INGEST_ROW_RULES, ["match_id", "event_id"])
    good, _ = Q.split_by_file(ev, Q.rejected_files(v), max_files=100)
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_events_of_match_prunes_partitions(spark, scratch):
    from pitchside.sinks.writers import write_partitioned
    from pitchside.sources.tables import events_of_match
    write_partitioned(match_events(spark, SF0001).drop("location", "carry_end_location"), scratch)
    df = events_of_match(spark.read.parquet(scratch), 1)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(match_id" in plan and "(match_id#" in plan
    assert df.count() == 500 and df.filter("match_id <> 1").count() == 0


def test_hot_match_is_pre_aggregated_before_the_shuffle(spark):
    # one match holds a third of all events: the plan must combine map-side
    ev = match_events(spark, SF001)
    h0, a0 = ev.filter("match_id = 0").select("home_team", "away_team").first()
    move = F.col("event_id") % 3 == 0  # these events join match 0, keeping their side
    side = F.when(F.col("team_name") == F.col("home_team"), F.lit(h0)).otherwise(F.lit(a0))
    hot = (ev.withColumn("team_name", F.when(move, side).otherwise(F.col("team_name")))
             .withColumn("home_team", F.when(move, F.lit(h0)).otherwise(F.col("home_team")))
             .withColumn("away_team", F.when(move, F.lit(a0)).otherwise(F.col("away_team")))
             .withColumn("match_id", F.when(move, F.lit(0)).otherwise(F.col("match_id"))))
    mart = marts.mart_player_performance(hot)
    plan = mart._jdf.queryExecution().executedPlan().toString()
    first_exchange = plan.rfind("Exchange hashpartitioning")
    assert "partial_count" in plan[first_exchange:]
    single = marts.mart_player_single_pass(hot)
    assert mart.count() == single.count() and mart.exceptAll(single).count() == 0
    total = hot.filter(F.col("event_type") == "Pass").filter(F.col("player_name").isNotNull()).count()
    assert mart.agg(F.sum("total_passes")).first()[0] == total


def test_team_keyed_star_has_no_fanout(spark):
    fan = match_events(spark, SF001, "fanout")
    keyed = marts.mart_player_performance(fan, by_team=True)
    assert keyed.count() == 840
    assert keyed.select("match_id", "team_name", "player_name").distinct().count() == 840
