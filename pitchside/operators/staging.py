"""Staging projection (P6): raw event names -> the 39 staged columns.

A pure projection; Catalyst collapses it into the scan's projection, so the
columns a mart does not use are never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import STAGED, STAGED_TO_RAW


def stg_events(base: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Select and rename the staged columns from a raw-named base table.

    ``allow_missing`` fills an absent source column with a typed null (for
    stacks of matches that never carried, say, carry details); by default an
    absent column is an error, as in a plain SQL select.
    """
    present = set(base.columns)
    cols = []
    for raw, staged, dtype in STAGED:
        if raw in present:
            cols.append(F.col(f"`{raw}`").alias(staged))
        elif allow_missing:
            cols.append(F.lit(None).cast(dtype).alias(staged))
        else:
            raise ValueError(f"base table lacks column {raw!r}")
    return base.select(*cols)


def to_raw_names(staged: DataFrame) -> DataFrame:
    """Inverse projection: staged names back to the raw source names."""
    return staged.select(*[F.col(c).alias(STAGED_TO_RAW.get(c, c)) for c in staged.columns])
