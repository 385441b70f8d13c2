"""Session helpers: a tuned builder for local runs and shared scratch paths.

On a cluster the session is created by the platform; only ``scratch_path``
is used there, and it reads ``spark.checkpoint.dir`` from that session.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at any scale: AQE re-plans joins and coalesces
# shuffle partitions at runtime, skew join splits hot partitions, UTC keeps
# timestamps engine-neutral, dynamic overwrite replaces only touched
# partitions (idempotent per match).
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "pitchside", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that value
    always wins. Only a local/test session without it gets a fresh folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not current:
        # local runs and tests only: a cluster always names a shared folder
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="pitchside-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    jsc = spark.sparkContext._jsc.sc()
    if not jsc.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(current)
    return current


def bound_listings(spark: SparkSession) -> None:
    """Let a listing of many folders or files run in a few tasks per core.

    Spark's default is a task per path, up to 10,000: at a folder per match each
    listing sends a task result per match to the driver. A session that
    has its own value keeps it.
    """
    if spark.conf.get(LISTING_TASKS) == "10000":
        spark.conf.set(LISTING_TASKS, str(2 * max(spark.sparkContext.defaultParallelism, 4)))


@contextmanager
def small_methods(spark: SparkSession):
    """Run a write of many computed columns without one method for all of them.

    The JVM never compiles a method of over 8,000 bytes, and Spark's default
    lets a fused stage grow to 65,535; beyond the limit the operators run one
    by one, in methods that are compiled. A session's own value stays.
    """
    before = spark.conf.get(METHOD_LIMIT)
    if before == "65535":
        spark.conf.set(METHOD_LIMIT, "8000")
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder name below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
