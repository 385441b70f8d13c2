"""Streaming de-duplication of records that arrive under more than one key.

A delivery may repeat (the store promises at least once), and the same record
may come again in another file, where a checkpoint that remembers files does
not help. ``dropDuplicatesWithinWatermark`` keeps the ids of the last
``delay`` of event time only: state is bounded by what arrives in that time,
and an id is forgotten ``delay`` after its record. A repeat within the delay
is dropped whatever its own timestamp says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def deduplicated(stream: DataFrame, keys: list[str], ts_col: str, delay: str = "1 day") -> DataFrame:
    """The first row of every key; later ones within ``delay`` are dropped."""
    kind = stream.schema[ts_col].dataType
    marked = stream.withColumn("_event_time", F.col(ts_col).cast(T.TimestampType()))
    kept = marked.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(keys)
    return kept.drop("_event_time").withColumn(ts_col, F.col(ts_col).cast(kind))


def run_dedup(spark: SparkSession, source_dir: str, schema: T.StructType, out_path: str, checkpoint: str,
              keys: list[str], ts_col: str, delay: str = "1 day", max_files_per_trigger: int = 1000) -> DataFrame:
    """De-duplicate every Parquet file below ``source_dir`` as an
    ``availableNow`` stream; a restart goes on with the files it has not seen."""
    source = (spark.readStream.schema(schema).option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir))
    query = (deduplicated(source, keys, ts_col, delay).writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint).option("path", out_path).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return spark.read.schema(schema).parquet(out_path)
