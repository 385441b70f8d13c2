"""Quality rules: negative cases on F-DIRTY, schema checks, keys, metrics."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from pitchside.fixtures import match_events
from pitchside.functions.keys import key_version, match_id_from_key, processed_key, raw_key
from pitchside.functions.metrics import round_half, safe_pct
from pitchside.operators import quality as Q
from pitchside.operators.standardize import standardize_columns
from pitchside.schema import REQUIRED_RAW


@pytest.fixture(scope="module")
def dirty(spark):
    return match_events(spark, SF001, "dirty").cache()


def test_dirty_staging_tests_fail(dirty):
    rep = {(r.column_name, r.test): (r.failures, r.status)
           for r in Q.run_checks(dirty, Q.STAGING_TESTS, "stg_events").collect()}
    assert rep[("event_id", "unique")][1] == "fail"
    assert rep[("period", "accepted_values")] == (1, "fail")  # one distinct bad value: 9
    assert rep[("event_id", "not_null")] == (0, "pass")


def test_violations_report_every_failure(dirty):
    v = Q.violations(dirty, Q.INGEST_ROW_RULES, ["match_id", "event_id"])
    rules = {r.rule for r in v.select("rule").distinct().collect()}
    assert rules == {"accepted_values_period", "not_null_team_name"}
    assert v.filter("rule = 'accepted_values_period'").count() == dirty.filter("period = 9").count()


def test_file_split_is_complete(dirty):
    v = Q.violations(dirty, Q.INGEST_ROW_RULES, ["match_id", "event_id"])
    good, bad = Q.split_by_file(dirty, Q.rejected_files(v))
    assert good.count() + bad.count() == dirty.count()
    assert good.filter("period = 9 or team_name is null").count() == 0


def test_accepted_values_null_modes(spark):
    df = spark.createDataFrame([(1,), (None,), (7,)], "period int")
    lax = Q.accepted_values_failures(df, "period", [1, 2])
    strict = Q.accepted_values_failures(df, "period", [1, 2], null_fails=True)
    assert lax.count() == 1 and strict.count() == 2


def test_schema_problems_on_driver(spark):
    df = spark.createDataFrame([("a", 1, "x")], "id string, index int, timestamp string")
    problems = Q.schema_problems(df, REQUIRED_RAW)
    assert "column index has type int, expected bigint" in problems
    assert "missing column period" in problems


def test_freshness_status(spark):
    df = spark.createDataFrame([("2024-01-31 12:00:00",)], "t string").select(
        F.to_timestamp_ntz("t").alias("ts"))
    row = Q.freshness(df, "ts", "2024-02-01 00:00:00", 6, 24).first()
    assert row.status == "warn" and row.age_us == 12 * 3600 * 10 ** 6


def test_standardize_rejects_case_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "`Team.Name` int, `team_name` int")
    with pytest.raises(ValueError):
        standardize_columns(df)


def test_key_functions(spark):
    df = spark.createDataFrame([(7,)], "m bigint").select(raw_key("m").alias("k"))
    row = df.select("k", processed_key("k").alias("p"), match_id_from_key("k").alias("id"),
                    key_version(F.lit("raw/match_7__v3.json")).alias("v"),
                    match_id_from_key(F.lit("raw/notes.txt")).alias("none")).first()
    assert (row.k, row.p, row.id, row.v, row.none) == ("raw/match_7.json", "processed/match_7.parquet", 7, 3, None)


def test_rounding_is_binary_scaled(spark):
    row = spark.range(1).select(round_half(F.lit(0.285), 2).alias("a"), round_half(F.lit(1.005), 2).alias("b"),
                                safe_pct(F.lit(0), F.lit(0)).alias("c")).first()
    assert (row.a, row.b, row.c) == (0.28, 1.0, 0.0)


def test_empty_manifest_rate_is_null(spark):
    from pitchside.plans.verify import verification_summary
    empty = spark.createDataFrame([], "raw_key string, processed_key string, status string, size bigint")
    assert verification_summary(empty).first().success_rate is None


def test_listing_reads_no_file_content(spark, scratch):
    import os
    from pitchside.plans.verify import list_objects
    os.makedirs(os.path.join(scratch, "processed", "match_id=4"))
    with open(os.path.join(scratch, "processed", "match_id=4", "part-0.parquet"), "wb") as f:
        f.write(b"x" * 123)
    df = list_objects(spark, os.path.join(scratch, "processed"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1].split("\n")[0]
    row = df.first()
    assert row.key == "match_id=4/part-0.parquet" and row.size == 123
