"""Object-key formatting.

Fixed values: raw files are named ``raw/match_<id>.json``; the processed
object replaces every ``raw/`` with ``processed/`` and every ``.json`` with
``.parquet``. A restated match may carry a version suffix ``__v<n>``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RAW_PREFIX, PROCESSED_PREFIX = "raw/", "processed/"
RAW_SUFFIX, PROCESSED_SUFFIX = ".json", ".parquet"
KEY_PATTERN = r"match_([0-9]+)(__v[0-9]+)?\.json$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def raw_key(match_id: Column | str) -> Column:
    return F.format_string("raw/match_%d.json", _c(match_id))


def processed_key(key: Column | str) -> Column:
    """Every 'raw/' -> 'processed/', every '.json' -> '.parquet' (literal, all)."""
    k = F.replace(_c(key), F.lit(RAW_PREFIX), F.lit(PROCESSED_PREFIX))
    return F.replace(k, F.lit(RAW_SUFFIX), F.lit(PROCESSED_SUFFIX))


def match_id_from_key(path: Column | str) -> Column:
    """Match id from a raw object key or file path; null when it does not match."""
    digits = F.regexp_extract(_c(path), KEY_PATTERN, 1)
    return F.when(digits != "", digits.cast("bigint"))


def key_version(path: Column | str) -> Column:
    """Restatement version from ``__v<n>`` (0 when absent)."""
    v = F.regexp_extract(_c(path), KEY_PATTERN, 2)
    digits = F.regexp_replace(v, "^__v", "").try_cast("decimal(38,0)")
    return F.when(v == "", F.lit(0).cast("decimal(38,0)")).otherwise(digits)
