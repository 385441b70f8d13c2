"""Distinct counts that merge: exact bitmaps over dense ids.

A dictionary gives every name a dense id. Per match and passer, the ids of
the recipients are set in bitmaps of 32,768 bits (``bitmap_construct_agg``),
one row per bitmap that has a bit; they are stored beside the pass totals.
A report over any set of matches merges bitmaps by OR and counts bits, so it
reads neither events nor network rows, and partial results of separate days
or files merge exactly, which a stored number of distinct names cannot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.metrics import merge_states, round_half, state_mean, sum_state

SLICES = 1 << 10


def dense_ids(names: DataFrame, column: str) -> DataFrame:
    """(column, id) with ids 0, 1, ... in hash-slice order, counted in slices
    so that no task numbers all names."""
    rows = names.select(column).filter(F.col(column).isNotNull()).distinct()
    rows = rows.withColumn("slice", F.pmod(F.xxhash64(column), F.lit(SLICES)))
    sizes = rows.groupBy("slice").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # at most SLICES rows
    sizes = sizes.select("slice", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("slice").orderBy(column)
    return rows.join(sizes, "slice").select(
        column, (F.col("offset") + F.row_number().over(inside) - 1).alias("id"))


def recipient_bitmaps(network: DataFrame, ids: DataFrame) -> DataFrame:
    """Per match, passer and team: a row per bitmap (``part``) with the bits
    of its recipients, and on one extra row (part -1) the pass totals and the
    exact state of the completion rates."""
    keys = ["match_id", "passer_name", "team_name"]
    rows = network.join(ids.withColumnRenamed(ids.columns[0], "recipient_name"), "recipient_name")
    bits = rows.groupBy(*keys, F.bitmap_bucket_number("id").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))
    totals = network.groupBy(*keys).agg(F.sum("total_passes").alias("passes"), sum_state("completion_pct").alias("pct"))
    return (bits.unionByName(totals.withColumn("part", F.lit(-1).cast("long")), allowMissingColumns=True)
            .select(*keys, "part", "bits", "passes", "pct"))


def hubs_from_bitmaps(stored: DataFrame, k: int = 10) -> DataFrame:
    """Players with the most distinct recipients over all stored matches."""
    keys = ["passer_name", "team_name"]
    merged = stored.filter("part >= 0").groupBy(*keys, "part").agg(F.bitmap_or_agg("bits").alias("bits"))
    counted = merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("unique_recipients"))
    totals = stored.filter("part = -1").groupBy(*keys).agg(
        F.sum("passes").alias("total_passes_made"), merge_states("pct").alias("pct"))
    both = totals.alias("t").join(counted.alias("c"), F.col("t.passer_name").eqNullSafe(F.col("c.passer_name"))
                                  & F.col("t.team_name").eqNullSafe(F.col("c.team_name")), "left")
    out = both.select("t.passer_name", "t.team_name",
                      F.coalesce("c.unique_recipients", F.lit(0)).alias("unique_recipients"), "t.total_passes_made",
                      round_half(state_mean("t.pct"), 1).alias("avg_completion_pct"))
    return out.orderBy(F.desc_nulls_last("unique_recipients"), F.asc_nulls_last("passer_name"),
                       F.asc_nulls_last("team_name")).limit(k)
