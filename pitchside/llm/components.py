"""Connected components of an edge table by alternating star operations.

Each round ties every node to the smallest node it knows (large star: its
larger neighbours; small star: its smaller ones), which never adds edges and
ends in stars in a logarithmic number of rounds. Edges are shuffled and
checkpointed, never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).head()
    return row["n"], row["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, label) of every node of an edge: the smallest node of its
    component."""
    edges = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u <> v").checkpoint()
    state = _state(edges)
    while state[0]:
        edges = _small_star(_large_star(edges)).checkpoint()
        now = _state(edges)
        if now == state:
            break
        state = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()).distinct()
