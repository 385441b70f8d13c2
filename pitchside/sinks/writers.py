"""Sinks: partitioned Parquet (K1/K3/K4), quarantine (K7), JSON export (K6)."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.staging import to_raw_names
from ..plans.verify import list_objects
from ..schema import NAMED_FIELDS, NESTED_GROUPS
from ..session import bound_listings, small_methods

RENAMES_AT_ONCE = 16  # requests of the driver in flight, as to an object store


def rebalanced(df: DataFrame, cols: list[str]) -> DataFrame:
    """Cluster rows by the output partition key before a partitioned write.

    Without it every task writes one file per key it happens to hold
    (tasks x keys small files). The ``rebalance`` hint is an AQE shuffle:
    small keys are coalesced into one task and a hot key (say a third of all
    rows in one match) is split over several tasks, so no task takes a
    whole hot key.
    """
    return df.hint("rebalance", *cols)


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str] | None = None,
                      rebalance: bool = False) -> None:
    """Overwrite only the partitions present in ``df`` (idempotent per key).

    A rerun of the same matches replaces exactly those matches; other
    partitions are untouched. ``rebalance`` when a task holds rows of many
    keys (line-per-event input); an input that is already one key per task
    (one match file per task) needs no shuffle.
    """
    cols = partition_cols or ["match_id"]
    out = rebalanced(df, cols) if rebalance else df
    bound_listings(df.sparkSession)  # a reader of the folders is near
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*cols).parquet(path))


def write_table(df: DataFrame, path: str) -> None:
    """Full refresh of a table (mart materialisation)."""
    df.write.mode("overwrite").parquet(path)


def write_quarantine(violations: DataFrame, path: str, batch_key: str) -> None:
    """Write the failures of one batch into its own ``batch=<key>`` partition.

    Dynamic overwrite makes a retried batch (same key) replace its own rows
    instead of appending them twice; other batches are untouched.
    """
    out = (violations.withColumn("ingested_at", F.current_timestamp())
                     .withColumn("batch", F.lit(batch_key)))
    write_partitioned(out, path, ["batch"])


def _named(c: Column) -> Column:
    return F.when(c.isNotNull(), F.struct(c.alias("name")))


def to_nested(staged: DataFrame) -> DataFrame:
    """Staged events -> the nested raw event shape (``type: {name}``,
    ``pass: {length, recipient: {name}, ...}``); match_id stays top level."""
    raw = to_raw_names(staged)
    top: list[Column] = []
    groups: dict[str, list[Column]] = {g: [] for g in NESTED_GROUPS}
    for name in raw.columns:
        c = F.col(f"`{name}`")
        value = _named(c) if name in NAMED_FIELDS else c
        group, _, rest = name.partition("_")
        if rest and group in groups:
            groups[group].append(value.alias(rest))
        else:
            top.append(value.alias(name))
    top += [F.struct(*fields).alias(g) for g, fields in groups.items() if fields]
    return raw.select(*top)


def export_events_json(df: DataFrame, path: str, nested: bool = True, rebalance: bool = True) -> None:
    """JSON lines, one folder per match (``match_id=<id>/``); nulls written as
    JSON null. Splittable on read, and no match is ever gathered into one row
    or one task. ``rebalance`` clusters by match first (fewer files when the
    input tasks each hold rows of many matches)."""
    out = to_nested(df) if nested else df
    out = rebalanced(out, ["match_id"]) if rebalance else out
    with small_methods(df.sparkSession):
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", "false")
            .partitionBy("match_id").json(path))


def _name_by_match(spark: SparkSession, parts: str, target: Callable[[str], str]) -> int:
    """Rename the one file of every ``match_id=<id>`` folder to ``target(id)``,
    some at a time; returns their number. The listing is a Spark job and comes
    in chunks, so the driver holds neither all names nor waits for each answer."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    fs = path_of(parts).getFileSystem(spark._jsc.hadoopConfiguration())
    match = F.regexp_extract("key", r"^match_id=([^/]*)/", 1).alias("match")
    files = list_objects(spark, parts, "part-*").groupBy(match).agg(
        F.count(F.lit(1)).alias("files"), F.min("path").alias("path"))

    def rename(row) -> None:
        if row["files"] != 1:
            raise ValueError(f"match {row['match']} was written as {row['files']} files")
        to = path_of(target(row["match"]))
        fs.delete(to, False)
        if not fs.rename(path_of(row["path"]), to):
            raise OSError(f"{row['path']} could not be renamed")

    n, rows = 0, files.toLocalIterator()
    with ThreadPoolExecutor(RENAMES_AT_ONCE) as pool:
        while chunk := list(islice(rows, 10_000)):
            n += sum(1 for _ in pool.map(rename, chunk))
    return n


def export_match_arrays(df: DataFrame, path: str, nested: bool = True, suffix: str = "") -> int:
    """One file ``match_<id><suffix>.json`` per match, one JSON array of its events in
    event order: the upload format. Returns the number of files.

    A line per event is written under its match; the first opens the array and
    the last closes it, so no match is gathered into a row. One task writes a
    match, as one file must be. The files get their names by one rename each,
    on the driver, many at once, as an upload of single objects does.
    """
    spark = df.sparkSession
    out = to_nested(df) if nested else to_raw_names(df)
    body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in out.columns if c != "match_id"]), {"ignoreNullFields": "false"})
    order = Window.partitionBy("match_id").orderBy("index", "id")
    lines = out.select(
        "match_id", F.lag(F.lit(1)).over(order).isNull().alias("first"),
        F.lead(F.lit(1)).over(order).isNull().alias("last"), body.alias("body"))
    text = lines.select("match_id", F.concat(  # in the window's order
        F.when(F.col("first"), "[").otherwise(","), "body", F.when(F.col("last"), "]").otherwise("")).alias("value"))
    parts = path.rstrip("/") + "/_parts"
    with small_methods(spark):
        text.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("match_id").text(parts)
    n = _name_by_match(spark, parts, lambda match: f"{path.rstrip('/')}/match_{match}{suffix}.json")
    folder = spark._jvm.org.apache.hadoop.fs.Path(parts)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return n


def write_bucketed(df: DataFrame, table: str, path: str, key: str = "match_id", buckets: int = 16) -> DataFrame:
    """Store ``df`` at ``path`` hashed into ``buckets`` sorted files by ``key``
    and register it as ``table``. Tables with the same key and number of
    buckets join and group on the key without an exchange."""
    (df.repartition(buckets, key).write.mode("overwrite").option("path", path)
       .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    return df.sparkSession.table(table)


def open_bucketed(spark: SparkSession, table: str, path: str, schema: str, key: str = "match_id",
                  buckets: int = 16) -> DataFrame:
    """Register a stored bucketed folder in another session."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet "
              f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)
