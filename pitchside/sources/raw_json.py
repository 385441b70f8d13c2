"""Raw match-event JSON: read files as VARIANT, explode, extract typed columns.

Two on-disk layouts are read:

- ``array``: one JSON array per match file, ``.../match_<id>.json`` (the
  upload format). Such a file is not splittable, so one file is one task;
  a match file is a few MB at most.
- ``lines``: one event object per line (splittable), e.g. the export of
  ``sinks.writers.export_events_json`` under ``match_id=<id>/`` folders.

Both shapes of an event are accepted: nested (``"type": {"name": ..}``,
``"pass": {"length": ..}``) and flat (``"type": "Pass"``,
``"pass_length": ..``). Reading as VARIANT keeps every file readable: a
malformed file yields a null value plus ``_corrupt_record`` instead of an
exception, and an object field without ``name`` yields null, never its
JSON text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import key_version
from ..schema import NAMED_FIELDS, NESTED_GROUPS, REQUIRED_KEYS
from ..session import bound_listings

_PART_ID = r"match_id=([0-9]+)"


def unit_match_id(path: Column) -> Column:
    """Match id of a source file: ``match_<id>[__v<n>].json`` or a ``match_id=<id>`` folder."""
    from_name = F.regexp_extract(path, r"match_([0-9]+)(__v[0-9]+)?\.json$", 1)
    from_dir = F.regexp_extract(path, _PART_ID, 1)
    digits = F.when(from_name != "", from_name).when(from_dir != "", from_dir)
    return digits.try_cast("bigint")


def _reader(spark: SparkSession, layout: str, stream: bool, max_files_per_trigger: int | None):
    r = spark.readStream if stream else spark.read
    r = (r.option("singleVariantColumn", "v")
          .option("pathGlobFilter", "*.json")
          .option("recursiveFileLookup", "true")
          .option("multiLine", layout == "array"))
    if stream and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    schema = "v variant" if stream else "v variant, _corrupt_record string"
    return r.schema(schema)


def read_raw_files(spark: SparkSession, root: str | list[str], layout: str = "array", stream: bool = False,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Rows of raw JSON with their source: (file_path, modified, v, corrupt).

    ``array``: one row per file; ``lines``: one row per line.
    """
    bound_listings(spark)
    df = _reader(spark, layout, stream, max_files_per_trigger).json(root)
    corrupt = F.col("v").isNull()
    if "_corrupt_record" in df.columns:
        corrupt = corrupt | F.col("_corrupt_record").isNotNull()
    return df.select(F.col("_metadata.file_path").alias("file_path"),
                     F.col("_metadata.file_modification_time").alias("modified"), "v", corrupt.alias("corrupt"))


def stream_names(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the raw files' names alone (file_path): no content is read."""
    bound_listings(spark)
    r = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
              .option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(root).select(F.col("_metadata.file_path").alias("file_path"))


def explode_events(files: DataFrame, layout: str = "array") -> DataFrame:
    """One row per event: (unit, match_id, version, modified, corrupt, pos, value).

    The unit of acceptance is the source file for ``array`` (one match per
    file) and the match folder for ``lines``. ``array`` files are exploded
    with ``posexplode_outer``, so an empty or unreadable file still leaves
    one row (value null) that the file facts see.
    """
    path = F.col("file_path")
    unit = path if layout == "array" else F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    base = files.select(unit.alias("unit"), unit_match_id(path).alias("match_id"),
                        key_version(path).alias("version"), "modified", "corrupt", "v")
    if layout == "lines":
        return base.select("unit", "match_id", "version", "modified", "corrupt",
                           F.lit(None).cast("int").alias("pos"), F.col("v").alias("value"))
    arr = F.expr("try_cast(v as array<variant>)")
    return base.select("unit", "match_id", "version", "modified", "corrupt",
                       F.posexplode_outer(arr).alias("pos", "value"))


def present(value: Column, raw_name: str) -> Column:
    """The key exists in the record (a JSON null counts as present)."""
    return F.variant_get(value, f"$.{raw_name}", "variant").isNotNull()


def file_facts(events: DataFrame, required: list[str] = REQUIRED_KEYS, failed: Column | None = None) -> DataFrame:
    """One row per source file: corrupt, event count and required-key presence,
    and with a row condition ``failed`` how many rows meet it (``n_failed``).

    A per-file aggregate: partial aggregation leaves one row per file per
    task, so the shuffle carries file counts, never events.
    """
    def has(k: str):
        if f"_has_{k}" in events.columns:
            return F.col(f"_has_{k}")
        return F.coalesce(present(F.col("value"), k), F.lit(False))

    n = F.count_if(F.col("_has_value")) if "_has_value" in events.columns else F.count("value")
    aggs = [F.max(F.col("corrupt").cast("int")).alias("corrupt"), n.alias("n_events"),
            F.max("modified").alias("modified")]
    aggs += [F.bool_or(has(k)).alias(f"has_{k}") for k in required]
    if failed is not None:
        aggs.append(F.count_if(failed).alias("n_failed"))
    return events.groupBy("unit", "match_id", "version").agg(*aggs)


def rejection_reasons(required: list[str] = REQUIRED_KEYS) -> Column:
    """The file-level failures of a row of facts: array of (rule, column_name, failed)."""
    reasons = [
        F.struct(F.lit("bad_key").alias("rule"), F.lit("unit").alias("column_name"),
                 (F.col("match_id").isNull() | F.col("version").isNull()).alias("failed")),
        F.struct(F.lit("corrupt").alias("rule"), F.lit(None).cast("string").alias("column_name"),
                 (F.col("corrupt") == 1).alias("failed")),
        F.struct(F.lit("empty").alias("rule"), F.lit(None).cast("string").alias("column_name"),
                 ((F.col("corrupt") == 0) & (F.col("n_events") == 0)).alias("failed")),
    ]
    reasons += [F.struct(F.lit("missing_column").alias("rule"), F.lit(k).alias("column_name"),
                         ((F.col("n_events") > 0) & ~F.col(f"has_{k}")).alias("failed"))
                for k in required]
    return F.filter(F.array(*reasons), lambda s: s["failed"])


def _read(node: Column, path: str, dtype: str, named: bool) -> Column:
    """Typed value at ``path`` of ``node``; a named field reads ``.name`` of an
    object, the text of a string, and null for an object without a name."""
    if dtype == "string" and named:
        name_path = "$.name" if path == "$" else f"{path}.name"
        text = F.try_variant_get(node, path, "string")
        # the text branch only runs when there is no name (flat shape or no value)
        return F.coalesce(F.try_variant_get(node, name_path, "string"),
                          F.when(~text.startswith("{"), text))
    return F.try_variant_get(node, path, dtype)


def _struct_ddl(fields: list[tuple[str, str]]) -> str:
    return "struct<" + ", ".join(f"`{n}`: {t}" for n, t in fields) + ">"


def typed_columns(events: DataFrame, wanted: list[tuple[str, str]], keys: list[str]) -> DataFrame:
    """Typed raw columns of exploded events, both shapes, from ONE cast per record.

    The whole event object is cast once to a struct holding every flat
    column and every detail group (an ill-typed field becomes null, the rest
    of the record survives). Fields with two shapes (``{name}`` objects or
    plain text) and the checked keys are cast to VARIANT and resolved from
    that small value; an absent key is SQL NULL, a JSON null a variant null.
    A detail group read from its object when present (nested shape), else
    from the flat key. Adds ``_has_<k>`` (key present, JSON null included)
    and ``_raw_<k>`` (a non-null value present) for ``keys``.
    """
    v = F.col("value")
    top: list[tuple[str, str]] = []
    groups: dict[str, list[tuple[str, str]]] = {}
    for raw, dtype in wanted:
        named = raw in NAMED_FIELDS
        group, _, rest = raw.partition("_")
        top.append((raw, "variant" if (named or raw in keys) else dtype))
        if rest and group in NESTED_GROUPS:
            groups.setdefault(group, []).append((rest, "variant" if named else dtype))
    have = {n for n, _ in top}
    top += [(k, "variant") for k in keys if k not in have]
    names = {n for n, _ in top}
    top += [(g, _struct_ddl(fs)) for g, fs in groups.items()]
    inner = events.select("*", F.try_variant_get(v, "$", _struct_ddl(top)).alias("_r"))

    def field(c: Column, raw: str, dtype: str) -> Column:
        if raw in NAMED_FIELDS and dtype == "string":
            return _read(c, "$", dtype, True)
        if raw in keys:
            return F.try_variant_get(c, "$", dtype)
        return c

    cols = [c for c in events.columns if c != "value"] + [v.isNotNull().alias("_has_value")]
    for raw, dtype in wanted:
        group, _, rest = raw.partition("_")
        flat = field(F.col(f"_r.`{raw}`"), raw, dtype)
        if rest and group in groups:
            g = F.col(f"_r.`{group}`")
            val = F.when(g.isNotNull(), field(g.getField(rest), raw, dtype)).otherwise(flat)
        else:
            val = flat
        if raw == "player_id" and "player" in names:  # nested shape: player {id, name}
            val = F.coalesce(val, F.try_variant_get(F.col("_r.player"), "$.id", dtype))
        cols.append(val.alias(raw))
    for k in keys:
        node = F.col(f"_r.`{k}`")
        cols.append(node.isNotNull().alias(f"_has_{k}"))
        cols.append((node.isNotNull() & ~F.is_variant_null(node)).alias(f"_raw_{k}"))
    return inner.select(*cols)
