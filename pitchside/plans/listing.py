"""Difference of two object listings: which raw keys are new, rewritten or gone.

A listing has one row per file (key, path, size, modified); both sides are
small next to the events and meet in one full outer join on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .verify import list_objects

LISTING = "key string, path string, size bigint, modified timestamp"
CHANGES = LISTING + ", change string"


def difference(stored: DataFrame, current: DataFrame) -> DataFrame:
    """key, path, size, modified, change: ``created``, ``changed`` (another
    length or time) or ``gone``; keys that stayed as they were have no row."""
    old, new = stored.alias("old"), current.alias("new")
    both = old.join(new, F.col("old.key") == F.col("new.key"), "full_outer")
    same = F.col("old.size").eqNullSafe(F.col("new.size")) & F.col("old.modified").eqNullSafe(F.col("new.modified"))
    change = (F.when(F.col("old.key").isNull(), "created").when(F.col("new.key").isNull(), "gone")
              .when(~same, "changed"))
    pick = lambda c: F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}")).alias(c)
    return both.select(*[pick(c) for c in ("key", "path", "size", "modified")], change.alias("change")).filter(
        "change is not null")


def _exists(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _last(spark: SparkSession, state_dir: str) -> int:
    """Number of the newest committed listing (0: none)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(state_dir)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    done = [int(n.partition("=")[2]) for n in names if n.startswith("done=")]
    return max(done, default=0)


def _listing_path(state_dir: str, number: int) -> str:
    return f"{state_dir.rstrip('/')}/listing={number:08d}"


def listing_changes(spark: SparkSession, raw_dir: str, state_dir: str,
                    glob: str = "*.json") -> tuple[DataFrame, int, bool]:
    """Changes since the committed listing, the number of this one, and
    whether a run before began with them.

    Both the new listing and its changes are stored first: a run that broke
    off between them and ``commit_listing`` finds the same changes again,
    even if the folder has changed meanwhile.
    """
    done = _last(spark, state_dir)
    number = done + 1
    changes = _listing_path(state_dir, number) + "-changes"
    begun = _exists(spark, changes + "/_SUCCESS")
    if not begun:
        stored = (spark.read.schema(LISTING).parquet(_listing_path(state_dir, done)) if done
                  else spark.createDataFrame([], LISTING))
        now = list_objects(spark, raw_dir, glob).select("key", "path", "size", "modified")
        now.write.mode("overwrite").parquet(_listing_path(state_dir, number))
        now = spark.read.schema(LISTING).parquet(_listing_path(state_dir, number))
        difference(stored, now).write.mode("overwrite").parquet(changes)
    return spark.read.schema(CHANGES).parquet(changes), number, begun


def commit_listing(spark: SparkSession, state_dir: str, number: int) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{state_dir.rstrip('/')}/done={number:08d}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
