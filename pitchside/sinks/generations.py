"""A store of match statements in generations, without a folder per match.

``data/generation=<g>/bucket=<b>/`` holds the rows of one append, hashed into
a fixed number of buckets by match; ``commits/generation=<g>/`` holds one row
per match of that append and is written after the data, so a generation
without a finished commit (its job was killed) is never seen. Readers take the
statement of the highest version, then generation, of every match. Rows of
older statements are hidden by an anti join with the (match, generation)
pairs that lost: only restated matches have such pairs, so the set is small
next to the events and empty after a compaction.

``compact`` rewrites the live statements as one new generation, which wins
over all before it, and then removes those: a compaction that breaks off
leaves a store that reads the same. One writer at a time is assumed, readers may be many; a reader
that planned before a compaction can miss the files it removes and must plan
again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small
from ..schema import STAGED

# as ingested: real event ids are uuids, so ids stay text
ROW_SCHEMA = ", ".join(f"`{name}` {'string' if raw == 'id' else kind}" for raw, name, kind in STAGED)
COMMIT_SCHEMA = "match_id bigint, version decimal(38,0), unit string, batch_key string"


@dataclass(frozen=True)
class GenerationStore:
    root: str
    buckets: int = 64

    def data_path(self, generation: int | None = None) -> str:
        base = f"{self.root.rstrip('/')}/data"
        return base if generation is None else f"{base}/generation={generation:08d}"

    def commit_path(self, generation: int | None = None) -> str:
        base = f"{self.root.rstrip('/')}/commits"
        return base if generation is None else f"{base}/generation={generation:08d}"

    # -- driver-side listing: one entry per generation, never per file or match

    def _folders(self, spark: SparkSession, base: str, finished: bool) -> list[int]:
        path = spark._jvm.org.apache.hadoop.fs.Path(base)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        found = []
        for status in fs.listStatus(path):
            name = status.getPath().getName()
            if name.startswith("generation="):
                done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
                if not finished or fs.exists(done):
                    found.append(int(name.partition("=")[2]))
        return sorted(found)

    def generations(self, spark: SparkSession) -> list[int]:
        """The committed generations."""
        return self._folders(spark, self.commit_path(), finished=True)

    def commits(self, spark: SparkSession) -> DataFrame:
        """match_id, version, unit, batch_key, generation of all statements."""
        known = self.generations(spark)
        if not known:
            return spark.createDataFrame([], COMMIT_SCHEMA + ", generation int")
        return (spark.read.schema(COMMIT_SCHEMA + ", generation int").option("basePath", self.commit_path())
                .parquet(*[self.commit_path(g) for g in known]))

    def versions(self, spark: SparkSession) -> DataFrame:
        return self.commits(spark).select("match_id", "version")

    def _ranked(self, spark: SparkSession) -> DataFrame:
        order = Window.partitionBy("match_id").orderBy(F.desc("version"), F.desc("generation"))
        return self.commits(spark).withColumn("place", F.row_number().over(order))

    def latest(self, spark: SparkSession) -> DataFrame:
        """The live statement of every match."""
        return self._ranked(spark).filter("place = 1").drop("place")

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows of the live statements."""
        known = self.generations(spark)
        if not known:
            return spark.createDataFrame([], ROW_SCHEMA)
        rows = (spark.read.schema(ROW_SCHEMA + ", generation int, bucket int").option("basePath", self.data_path())
                .parquet(*[self.data_path(g) for g in known]))
        lost = self._ranked(spark).filter("place > 1").select("match_id", "generation")
        live = rows.join(broadcast_if_small(lost), ["match_id", "generation"], "left_anti")
        return live.select(*[name for _, name, _ in STAGED])

    # -- writing

    def write_rows(self, rows: DataFrame, generation: int) -> int:
        """Data of a generation that is not committed yet; returns its rows."""
        seen = Observation(f"generation_{generation}")
        out = rows.withColumn("bucket", F.pmod(F.xxhash64("match_id"), F.lit(self.buckets)).cast("int"))
        (out.observe(seen, F.count(F.lit(1)).alias("rows")).hint("rebalance", "bucket").write.mode("overwrite")
            .option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(self.data_path(generation)))
        return int(seen.get.get("rows", 0))

    def write_commit(self, statements: DataFrame, generation: int, batch_key: str) -> None:
        out = statements.select(
            "match_id", F.col("version").cast("decimal(38,0)").alias("version"), "unit",
            F.lit(batch_key).alias("batch_key"))
        out.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.commit_path(generation))

    def next_generation(self, spark: SparkSession) -> int:
        used = self._folders(spark, self.data_path(), False) + self._folders(spark, self.commit_path(), False)
        return max(used, default=0) + 1

    def append(self, rows: DataFrame, statements: DataFrame, batch_key: str) -> int:
        """Store the rows of a batch; ``statements`` has match_id, version and
        unit of its matches. Returns the rows written, 0 for a repeated key."""
        spark = rows.sparkSession
        if self.commits(spark).filter(F.col("batch_key") == batch_key).head(1):
            return 0
        generation = self.next_generation(spark)
        n = self.write_rows(rows, generation)
        self.write_commit(statements, generation, batch_key)
        return n

    def compact(self, spark: SparkSession) -> int:
        """Fold all generations into one; returns its number. The batch keys
        of the folded ones are forgotten."""
        below = sorted({*self._folders(spark, self.data_path(), False), *self._folders(spark, self.commit_path(), False)})
        if not below:
            return 0
        generation = below[-1] + 1
        self.write_rows(self.read(spark), generation)
        self.write_commit(self.latest(spark), generation, f"compact-{generation:08d}")
        for old in below:
            for name in (self.commit_path(old), self.data_path(old)):  # a commit never outlives its data
                path = spark._jvm.org.apache.hadoop.fs.Path(name)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        return generation
