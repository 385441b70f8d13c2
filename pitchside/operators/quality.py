"""Data-quality rules (Q1-Q11) as DataFrame jobs.

Rules are plain dataclasses; checks are aggregates:

- every not-null and accepted-values rule of one table is evaluated in ONE
  aggregate pass (``count_if`` / distinct failing values per rule);
- a unique rule is one ``groupBy(col)`` on the non-null values (the only
  rule that must shuffle its column);
- row-level violations (lazy validation, Q7) are one scan: each row builds
  an array of (rule, column, value, failed) structs, keeps the failed ones
  and explodes them, so all failures are reported together;
- file-level rejection (J6): files with a violation form a key set that
  splits the rows with a semi join (quarantine) and an anti join (accepted).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ACCEPTED_PERIODS
from .joins import broadcast_if_small


@dataclass(frozen=True)
class Rule:
    column: str
    kind: str                      # "not_null" | "unique" | "accepted_values" | "type"
    values: tuple = field(default=())
    null_fails: bool = False       # accepted_values: a null fails too (strict form)
    model: str = ""

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.model + '_' if self.model else ''}{self.column}"

    def failed(self) -> Column:
        """Row-level failure condition (not defined for ``unique``)."""
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "accepted_values":
            bad = ~F.coalesce(c.isin(*self.values), F.lit(False))
            return bad if self.null_fails else (c.isNotNull() & bad)
        if self.kind == "type":
            # a value was there (column ``_raw_<c>``) but did not read as the type
            return F.col(f"_raw_{self.column}") & c.isNull()
        raise ValueError(f"{self.kind} is not a row rule")


# The declared tests of the staged table and the four marts.
STAGING_TESTS = [
    Rule("event_id", "unique", model="stg_events"),
    Rule("event_id", "not_null", model="stg_events"),
    Rule("match_id", "not_null", model="stg_events"),
    Rule("period", "not_null", model="stg_events"),
    Rule("period", "accepted_values", tuple(ACCEPTED_PERIODS), model="stg_events"),
    Rule("event_type", "not_null", model="stg_events"),
]
MART_TESTS = {
    "mart_player_performance": [Rule("player_name", "not_null"), Rule("match_id", "not_null")],
    "mart_team_summary": [Rule("team_name", "not_null"), Rule("match_id", "not_null")],
    "mart_shot_analysis": [Rule("event_id", "unique"), Rule("event_id", "not_null")],
    "mart_pass_networks": [Rule("passer_name", "not_null"), Rule("recipient_name", "not_null"),
                           Rule("match_id", "not_null"), Rule("total_passes", "not_null")],
}

# Row rules of an ingested file (staged names): required, typed, period in range.
INGEST_ROW_RULES = [
    Rule("event_id", "not_null"),
    Rule("event_index", "not_null"),
    Rule("period", "accepted_values", tuple(ACCEPTED_PERIODS), null_fails=True),
    Rule("event_timestamp", "not_null"),
    Rule("event_type", "not_null"),
    Rule("team_name", "not_null"),
]

# Row rules of a raw file (raw names): types of required columns, not-null
# except player, period in range (a null period fails too).
RAW_ROW_RULES = (
    [Rule(c, "type") for c in ("id", "index", "period", "timestamp", "type", "team", "player")]
    + [Rule(c, "not_null") for c in ("id", "index", "timestamp", "type", "team")]
    + [Rule("period", "accepted_values", tuple(ACCEPTED_PERIODS), null_fails=True)]
)

REPORT_SCHEMA = "model string, column_name string, test string, failures bigint, status string"


def _status(failures: Column) -> Column:
    return F.when(failures == 0, "pass").otherwise("fail")


def run_checks(df: DataFrame, rules: list[Rule], model: str) -> DataFrame:
    """One row per rule: (model, column_name, test, failures, status).

    Failures follow the SQL test convention: not_null counts null rows,
    accepted_values counts distinct failing values, unique counts
    duplicated values.
    """
    parts: list[DataFrame] = []
    row_rules = [r for r in rules if r.kind in ("not_null", "accepted_values")]
    if row_rules:
        # every row rule of the table in ONE aggregate pass
        def measure(r: Rule) -> Column:
            if r.kind == "not_null":
                return F.count_if(r.failed())
            # accepted values: number of distinct failing values (a failing null counts once)
            c = F.col(r.column)
            distinct_bad = F.count_distinct(F.when(r.failed(), c))
            null_bad = F.max(F.when(r.failed() & c.isNull(), 1).otherwise(0))
            return distinct_bad + null_bad

        agg = df.agg(*[measure(r).alias(f"r{i}") for i, r in enumerate(row_rules)])
        stack = ", ".join(f"'{r.column}', '{r.kind}', r{i}" for i, r in enumerate(row_rules))
        parts.append(agg.selectExpr(f"stack({len(row_rules)}, {stack}) as (column_name, test, failures)"))
    for r in rules:
        if r.kind == "unique":
            dups = (df.filter(F.col(r.column).isNotNull()).groupBy(r.column).count()
                      .filter(F.col("count") > 1).agg(F.count(F.lit(1)).alias("failures")))
            parts.append(dups.select(F.lit(r.column).alias("column_name"),
                                     F.lit(r.kind).alias("test"), "failures"))
    out = reduce(DataFrame.unionByName, parts)
    return out.select(F.lit(model).alias("model"), "column_name", "test",
                      F.col("failures").cast("bigint").alias("failures"),
                      _status(F.col("failures")).alias("status"))


def not_null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """All not-null rules of a table in one aggregate: (column_name, failures)."""
    return run_checks(df, [Rule(c, "not_null") for c in columns], "").select("column_name", "failures")


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Duplicated non-null values with their counts (Q4)."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n_records"))
              .filter(F.col("n_records") > 1))


def accepted_values_failures(df: DataFrame, column: str, values: list,
                             null_fails: bool = False) -> DataFrame:
    """Values outside the accepted set, with counts (Q5)."""
    rule = Rule(column, "accepted_values", tuple(values), null_fails)
    return df.filter(rule.failed()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def violations(df: DataFrame, rules: list[Rule], keep: list[str]) -> DataFrame:
    """Every failing (row, rule) pair in one scan (lazy validation, Q7).

    Output: ``keep`` columns + rule, column_name, value (as text).
    """
    checks = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column_name"),
                 F.col(r.column).cast("string").alias("value"),
                 F.coalesce(r.failed(), F.lit(False)).alias("failed"))
        for r in rules])
    failed = F.filter(checks, lambda s: s["failed"])
    return (df.select(*keep, failed.alias("_f"))
              .filter(F.size("_f") > 0)
              .select(*keep, F.explode("_f").alias("_v"))
              .select(*keep, "_v.rule", "_v.column_name", "_v.value"))


def any_failed(rules: list[Rule]) -> Column:
    """True when a row breaks at least one of the row rules."""
    out = F.lit(False)
    for r in rules:
        out = out | F.coalesce(r.failed(), F.lit(False))
    return out


def rejected_files(viol: DataFrame, file_col: str = "match_id") -> DataFrame:
    """File keys with at least one violation."""
    return viol.select(file_col).distinct()


# A file key is a path of ~100 bytes: 200k keys stay near 20 MB on every executor.
MAX_BROADCAST_FILES = 200_000


def split_by_file(df: DataFrame, bad_files: DataFrame, file_col: str = "match_id",
                  max_files: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, quarantined rows): one bad row rejects its whole file.

    The bad-file set has at most one row per input file. When the caller
    knows the number of input files (an ingest batch does), pass it as
    ``max_files``: a bounded key set is broadcast and the row side is never
    shuffled. Otherwise the size check and AQE pick the join.
    """
    if max_files is not None and max_files <= MAX_BROADCAST_FILES:
        keys = F.broadcast(bad_files)
    else:
        keys = broadcast_if_small(bad_files)
    accepted = df.join(keys, file_col, "left_anti")
    quarantined = df.join(keys, file_col, "left_semi")
    return accepted, quarantined


def quarantine_summary(df: DataFrame, viol: DataFrame, file_col: str = "match_id") -> DataFrame:
    """Per rejected file: rows, violations and the sorted list of failed rules."""
    per_file = viol.groupBy(file_col).agg(
        F.count(F.lit(1)).alias("n_violations"),
        F.array_join(F.array_sort(F.collect_set("rule")), ",").alias("rules"))
    rows = df.groupBy(file_col).agg(F.count(F.lit(1)).alias("n_rows"))
    return per_file.join(rows, file_col, "inner").select(file_col, "n_rows", "n_violations", "rules")


def freshness(df: DataFrame, ts_col: str, as_of: str, warn_after_hours: float,
              error_after_hours: float, group_by: list[str] | None = None) -> DataFrame:
    """Age of the newest row against warn/error limits (Q10).

    ``as_of`` is a literal timestamp so the check is reproducible; age is
    reported in whole microseconds.
    """
    keys = group_by or []
    g = df.groupBy(*keys) if keys else df
    agg = g.agg(F.max(ts_col).alias("max_loaded_at"))
    now = F.lit(as_of).cast(T.TimestampNTZType())
    age = F.expr("timestampdiff(MICROSECOND, max_loaded_at, to_timestamp_ntz('%s'))" % as_of)
    hours = age / F.lit(3.6e9)
    status = (F.when(hours > error_after_hours, "error")
               .when(hours > warn_after_hours, "warn").otherwise("pass"))
    return agg.select(*keys, "max_loaded_at", now.alias("as_of"), age.alias("age_us"), status.alias("status"))


def schema_problems(df: DataFrame, required: list[tuple[str, str, bool]]) -> list[str]:
    """Driver-side schema check (Q1, Q2): missing columns and wrong types.

    Works on the schema only; no job runs.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = []
    for name, dtype, _nullable in required:
        if name not in types:
            out.append(f"missing column {name}")
        elif types[name] != dtype:
            out.append(f"column {name} has type {types[name]}, expected {dtype}")
    return out


# Declared kind of a raw column by the type names that a VARIANT value can
# have: whole numbers and text as declared, a name also as an object.
_FOUND_AS = {"bigint": ("BIGINT",), "string": ("STRING",)}


def schema_of_files(events: DataFrame, required: list[tuple[str, str, bool]], objects: set[str] = frozenset(),
                    file_col: str = "unit") -> DataFrame:
    """Declared against found types of raw files, as one aggregate (Q1, Q2):
    (file, column_name, declared, found, status).

    ``events`` has a VARIANT ``value`` per record. The found type is the merged
    schema of the column over all records of the file
    (``schema_of_variant_agg``): one type name, ``VOID`` if the key is absent
    or null in all of them, ``VARIANT`` if records disagree. ``objects`` names
    the columns that may come as an object with a ``name`` instead.

    ``status``: ``ok``, ``missing`` (no record has the key), ``null`` (a
    required value is nowhere given), ``type``.
    """
    aggs, parts = [], []
    for i, (name, declared, nullable) in enumerate(required):
        node = F.variant_get("value", f"$.{name}", "variant")
        if name in objects:
            node = F.coalesce(F.variant_get("value", f"$.{name}.name", "variant"), node)
        aggs += [F.schema_of_variant_agg(node).alias(f"s{i}"), F.count(F.variant_get("value", f"$.{name}", "variant")).alias(f"n{i}")]
        found = F.col(f"s{i}")
        fits = F.lit(False)
        for kind in _FOUND_AS[declared]:
            fits = fits | (found == kind)
        status = (F.when(F.col(f"n{i}") == 0, "missing").when(fits, "ok")
                  .when(found == "VOID", F.lit("ok" if nullable else "null")).otherwise("type"))
        parts.append(F.struct(F.lit(name).alias("column_name"), F.lit(declared).alias("declared"),
                              found.alias("found"), status.alias("status")))
    per_file = events.groupBy(file_col).agg(*aggs)
    return per_file.select(file_col, F.explode(F.array(*parts)).alias("c")).select(file_col, "c.*")
