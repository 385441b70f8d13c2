"""Parquet table scans.

Every reader selects only the columns asked for, so the parquet
``ReadSchema`` is pruned even before Catalyst sees the rest of the plan,
and filters placed on the result are pushed to the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def events_of_match(events: DataFrame, match_id: int) -> DataFrame:
    """Events of one match (S8): an equality on the partition/filter column.

    On a ``partitionBy("match_id")`` layout this prunes to one folder; on a
    flat layout the predicate is pushed to the parquet row-group stats.
    """
    return events.filter(F.col("match_id") == F.lit(match_id))
