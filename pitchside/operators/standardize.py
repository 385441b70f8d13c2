"""Flatten, standardise and project event frames.

These work on typed DataFrames (struct columns), e.g. a JSON read with an
inferred or declared schema. Raw VARIANT rows go through
``sources.raw_json.extract`` instead, which yields the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CORE_COLUMNS, NAME_RENAMES

CORE_TYPES = {"id": "string", "index": "bigint", "period": "bigint", "timestamp": "string",
              "type": "string", "team": "string"}


def _leaves(dtype: T.DataType, prefix: list[str]):
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            yield from _leaves(f.dataType, prefix + [f.name])
    else:
        yield prefix


def flatten_json(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs -> one column per leaf, path joined by ``sep``.

    Arrays stay arrays. A pure projection: no job, no shuffle.
    """
    cols = []
    for f in df.schema.fields:
        for path in _leaves(f.dataType, [f.name]):
            ref = ".".join(f"`{p}`" for p in path)
            cols.append(F.col(ref).alias(sep.join(path)))
    return df.select(*cols)


def standardize_columns(df: DataFrame) -> DataFrame:
    """Dots -> underscores, lowercase (P2); then type_name -> type etc..

    Two names that differ only in case would make every later reference
    ambiguous, so such a collision is an error here, before any job runs.
    """
    new = [c.replace(".", "_").lower() for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(f"columns {seen[n]!r} and {old!r} both standardise to {n!r}")
        seen[n] = old
    out = df.toDF(*new)
    return out.withColumnsRenamed({k: v for k, v in NAME_RENAMES.items() if k in out.columns})


def core_projection(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Keep the core columns that exist, in fixed order, typed.

    ``try_cast`` turns an ill-typed value into null (reported by the not-null
    rules) instead of failing the whole job.
    """
    keep = [c for c in CORE_COLUMNS if c in df.columns] + [c for c in (extra or []) if c in df.columns]
    cols = []
    for c in keep:
        t = CORE_TYPES.get(c)
        cols.append(F.expr(f"try_cast(`{c}` as {t})").alias(c) if t else F.col(f"`{c}`"))
    return df.select(*cols)
