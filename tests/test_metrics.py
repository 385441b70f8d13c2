"""Property tests: exact sums and rounding on random data, against fsum and DuckDB."""

import math

import duckdb
import pandas as pd
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pitchside.functions.metrics import exact_mean, exact_sum, merge_states, round_half, state_mean, state_sum, sum_state

# values with 1..5 decimals, like lengths, minutes and xG
cents = st.integers(min_value=-10_000_000, max_value=10_000_000)
scales = st.sampled_from([10, 100, 1000, 10000, 100000])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(cents, scales), min_size=1, max_size=400), st.integers(1, 3))
def test_round_half_matches_duckdb(spark, pairs, digits):
    xs = [a / s for a, s in pairs]
    pdf = pd.DataFrame({"x": xs})
    got = [r.y for r in spark.createDataFrame(pdf).select(round_half("x", digits).alias("y")).collect()]
    want = duckdb.sql(f"select round(x, {digits}) as y from pdf").df()["y"].tolist()
    assert got == want


magnitudes = st.floats(min_value=-12, max_value=12)
values = st.builds(lambda m, e, s: s * m * 10.0 ** e, st.floats(1, 10), magnitudes, st.sampled_from([1.0, -1.0]))


@settings(max_examples=6, deadline=None)
@given(st.lists(values, min_size=1, max_size=300))
def test_exact_sum_is_rounded_once(spark, xs):
    """Equal to the correctly rounded sum, whatever the order and the partitions."""
    df = spark.createDataFrame(pd.DataFrame({"x": xs}))
    want = math.fsum(xs)
    for part in (df.coalesce(1), df.repartition(7).orderBy(F.rand(3))):
        got = part.agg(exact_sum("x").alias("s"), exact_mean("x").alias("m")).first()
        assert (got.s, got.m) == (want, want / len(xs))


def test_exact_sum_by_group_and_merged(spark):
    groups = {
        "cancel": [1e16, 1.0, -1e16], "tenths": [0.1] * 10, "none": [None, None], "zeros": [0.0, -0.0], "one": [-1e-12, None],
        "wide": [2.0 ** 62, 2.0 ** -75, -2.0 ** 62], "ties": [0.5, 2.0 ** 53], "half": [2.0 ** 53, 1.0, 2.0 ** -60],
        "negative": [-(2.0 ** 53), -1.0, -(2.0 ** -60)], "small": [5e-23, -1e-22], "xg": [0.0004999], "inf": [math.inf, 1.0],
        "off": [1e300, 1.0], "many": [0.1 * k for k in range(5000)]}
    rows = [(g, n, x) for g, xs in groups.items() for n, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "g string, n int, x double").repartition(5)
    states = df.groupBy("g", F.pmod("n", F.lit(3)).alias("h")).agg(sum_state("x").alias("s"))
    merged = {r.g: r for r in states.groupBy("g").agg(merge_states("s").alias("s")).select(
        "g", state_sum("s").alias("total"), state_mean("s").alias("mean")).collect()}
    got = {r.g: r.total for r in df.groupBy("g").agg(exact_sum("x").alias("total")).collect()}
    for g, xs in groups.items():
        xs = [x for x in xs if x is not None]
        want = math.fsum(xs) if xs else None
        assert got[g] == want and merged[g].total == want, g
        assert merged[g].mean == (want / len(xs) if xs else None)
