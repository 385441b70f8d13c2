"""Uniqueness across batches (Q4) without reading stored events.

An index beside the store keeps, per batch, how often each id came: rows
``(id, n)`` under ``bucket=<b>/batch=<key>``, sorted inside. A new batch is
counted alone, and only the index rows of its ids are joined (semi join by
bucket and id, so buckets without a row of the batch are pruned). An id that
is now over one is appended to the findings.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.writers import write_partitioned


@dataclass(frozen=True)
class UniqueIndex:
    root: str
    column: str
    buckets: int = 64

    def _path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _stored(self, spark: SparkSession, name: str, like: DataFrame) -> DataFrame:
        schema = like.withColumn("batch", F.lit("")).schema
        try:
            return spark.read.schema(schema).parquet(self._path(name))
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return spark.createDataFrame([], schema)

    def counted(self, batch: DataFrame) -> DataFrame:
        """id, n, bucket of the non-null values of a batch."""
        c = F.col(self.column)
        return (batch.filter(c.isNotNull()).groupBy(c.alias("id")).agg(F.count(F.lit(1)).alias("n"))
                .withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(self.buckets)).cast("int")))

    def add(self, batch: DataFrame, batch_key: str) -> DataFrame:
        """Take a batch into the index; returns the ids of the batch that
        came more than once by now: (id, n_records). A retry with the same
        key replaces what it wrote."""
        spark = batch.sparkSession
        own = self.counted(batch)
        write_partitioned(own.withColumn("batch", F.lit(batch_key)).sortWithinPartitions("bucket", "id"),
                          self._path("ids"), ["bucket", "batch"], rebalance=False)
        index = self._stored(spark, "ids", own)
        mine = index.filter(F.col("batch") == batch_key).select("bucket", "id")
        found = (index.join(mine, ["bucket", "id"], "left_semi").groupBy("id")
                 .agg(F.sum("n").alias("n_records")).filter("n_records > 1"))
        write_partitioned(found.withColumn("batch", F.lit(batch_key)), self._path("found"), ["batch"])
        return self._stored(spark, "found", found).filter(F.col("batch") == batch_key).drop("batch")

    def duplicates(self, spark: SparkSession) -> DataFrame:
        """All ids found so far with the records of all batches; reads the
        findings only (the newest finding of an id has its full count)."""
        found = self._stored(spark, "found", spark.createDataFrame([], "id bigint, n_records bigint"))
        return found.groupBy(F.col("id").alias(self.column)).agg(F.max("n_records").alias("n_records"))
