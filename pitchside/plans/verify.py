"""Manifest verification.

Expected keys (the manifest of uploaded raw files) are matched against an
object listing of the processed store. Both sides have one row per file,
so the join is small next to the event data; AQE picks broadcast or
shuffle from runtime sizes.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import processed_key
from ..functions.metrics import round_half
from ..session import bound_listings


def list_objects(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """Object listing with sizes: (key relative to root, path, size, modified).

    ``binaryFile`` with only path/length selected never reads file content
    (the scan's ReadSchema is path and length). The key is what follows the
    root's own path in the object's, compared as text.
    """
    root = root.rstrip("/")
    bound_listings(spark)
    try:
        df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
              .option("recursiveFileLookup", "true").load(root)
              .select("path", "length", "modificationTime"))
    except AnalysisException as e:  # nothing written there yet: an empty listing
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "key string, path string, size bigint, modified timestamp")
    inner = root.partition("://")[2].partition("/")[2] if "://" in root else root.partition(":")[2] or root
    inner = F.lit("/" + inner.strip("/") + "/")
    key = F.substring(F.col("path"), F.instr("path", inner) + F.char_length(inner), F.lit(1 << 20))
    return df.select(key.alias("key"), "path", F.col("length").alias("size"),
                     F.col("modificationTime").alias("modified"))


def verify_processed(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Per expected raw key: processed key, found/missing status, size."""
    expected = manifest.select("raw_key", processed_key("raw_key").alias("processed_key"))
    found = listing.select(F.col("key").alias("processed_key"), "size")
    joined = expected.join(found, "processed_key", "left")
    return joined.select("raw_key", "processed_key",
                         F.when(F.col("size").isNotNull(), "found").otherwise("missing").alias("status"),
                         "size")


def missing_files(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Expected keys with no processed object (anti join)."""
    expected = manifest.select("raw_key", processed_key("raw_key").alias("processed_key"))
    return expected.join(listing.select(F.col("key").alias("processed_key")), "processed_key", "left_anti")


def verify_stored(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """``verify_processed`` over stored tables bucketed alike by
    ``processed_key`` (manifest: raw_key, processed_key; listing:
    processed_key, size): merged bucket by bucket without an exchange."""
    joined = manifest.join(listing.select("processed_key", "size").hint("merge"), "processed_key", "left")
    return joined.select("raw_key", "processed_key",
                         F.when(F.col("size").isNotNull(), "found").otherwise("missing").alias("status"),
                         "size")


def verification_summary(status: DataFrame) -> DataFrame:
    """expected, found, missing and success rate in % (one decimal; null when
    nothing was expected instead of a division by zero)."""
    agg = status.agg(F.count(F.lit(1)).alias("expected"),
                     F.count_if(F.col("status") == "found").alias("found"),
                     F.count_if(F.col("status") == "missing").alias("missing"))
    rate = F.try_divide(F.col("found") * F.lit(100.0), F.col("expected"))
    return agg.withColumn("success_rate", round_half(rate, 1))
