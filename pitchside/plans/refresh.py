"""Refresh of stored marts by change: only the partitions that hold a match
touched by an ingest are computed again.

Every mart row belongs to one match. Events and marts are stored in the same
fixed number of match buckets, so a set of touched matches is a set of touched
buckets; the events of these are read (partition pruning), the marts over them
computed and the buckets replaced by a dynamic overwrite. What it costs follows
the touched buckets, not the store.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.writers import write_partitioned
from .pipeline import build_marts

BUCKETS = 64


def bucket_of(match_id: Column | str, buckets: int = BUCKETS) -> Column:
    """Match bucket; events without a match form bucket -1."""
    m = F.col(match_id) if isinstance(match_id, str) else match_id
    return F.when(m.isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(m), F.lit(buckets)).cast("int"))


def store_events(events: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Replace the buckets that ``events`` has rows of, each whole."""
    write_partitioned(events.withColumn("bucket", bucket_of("match_id", buckets)), path, ["bucket"], rebalance=True)


def touched_buckets(changed: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Buckets of the changed matches: at most ``buckets`` + 1 numbers."""
    rows = changed.select(bucket_of("match_id", buckets).alias("bucket")).distinct().collect()
    return sorted(r["bucket"] for r in rows)


def replace_matches(store: str, changed: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Put the rows of ``changed`` (all rows of its matches) in place of what
    the event store has of these matches; returns the buckets rewritten.

    A dynamic overwrite cannot read what it replaces, so the new buckets are
    written beside the store first.
    """
    spark = changed.sparkSession
    numbers = touched_buckets(changed, buckets)
    if not numbers:
        return []
    stored = spark.read.parquet(store)
    old = stored.filter(F.col("bucket").isin(numbers)).drop("bucket").join(
        changed.select("match_id").distinct(), "match_id", "left_anti")
    beside = store.rstrip("/") + "_incoming"
    new = old.unionByName(changed).withColumn("bucket", bucket_of("match_id", buckets))
    new.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(beside)
    write_partitioned(spark.read.schema(new.schema).parquet(beside), store, ["bucket"])
    return numbers


def refresh_marts(spark: SparkSession, store: str, marts_root: str, numbers: list[int] | None = None,
                  names: list[str] | None = None, buckets: int = BUCKETS) -> dict[str, DataFrame]:
    """Compute the marts of the given buckets (None: all) and replace these
    partitions of the stored marts; returns the stored marts.

    A bucket whose mart rows are all gone keeps an empty partition: its old
    files are removed although a dynamic overwrite writes none.
    """
    events = spark.read.parquet(store)
    part = events if numbers is None else events.filter(F.col("bucket").isin(numbers))
    out = {}
    for name, mart in build_marts(part.drop("bucket")).items():
        if names is not None and name not in names:
            continue
        path = f"{marts_root.rstrip('/')}/{name}"
        rows = mart.withColumn("bucket", bucket_of("match_id", buckets))
        if numbers is None:
            rows.hint("rebalance", "bucket").write.mode("overwrite").option(
                "partitionOverwriteMode", "static").partitionBy("bucket").parquet(path)
        else:
            write_partitioned(rows, path, ["bucket"], rebalance=True)
            _drop_stale(spark, path, numbers, {r["bucket"] for r in rows.select("bucket").distinct().collect()})
        out[name] = spark.read.schema(rows.schema).parquet(path).drop("bucket")
    return out


def _drop_stale(spark: SparkSession, path: str, numbers: list[int], written: set[int]) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    for number in numbers:
        if number not in written:
            folder = hadoop.Path(f"{path}/bucket={number}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
