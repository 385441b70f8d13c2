"""Ingest of raw match files: one function for batch and stream.

``ingest_batch`` takes the raw rows of some files (a batch read, or one
micro-batch of the file stream) and

1. explodes them to events and extracts typed columns (both event shapes);
2. derives per-file facts (corrupt, empty, required keys present) with a
   per-file aggregate (file counts are shuffled, never events);
3. evaluates all row rules in one scan (lazy: every failure is reported);
4. keeps, per match, one valid file: the newest restatement (``__v<n>``) of
   this and all earlier batches, of equal versions in one batch the file
   modified last (then the larger path); the others are ``superseded``;
5. splits rows by file: a file with any failure is rejected whole; the
   bad-file keys are counted first and broadcast if they are few, so the
   events are not shuffled for the split (beyond that, a shuffle join);
6. writes accepted events as staged Parquet, partitioned by match_id with
   dynamic overwrite (a rerun or restatement replaces just those matches),
   and appends all failures to the quarantine table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.joins import attach_match_context
from ..schema import CORE_COLUMNS, REQUIRED_KEYS, STAGED
from ..sinks.generations import GenerationStore
from ..sinks.writers import write_partitioned, write_quarantine
from ..session import small_methods
from ..sources import raw_json as R
from .listing import commit_listing, listing_changes
from .verify import list_objects

# Raw columns read from every event: the staged set; ``id`` stays text (real
# ids are uuids), the other types follow the staged contract.
_RAW_TYPES = [(raw, "string" if raw == "id" else ("bigint" if raw == "period" else t))
              for raw, _, t in STAGED if raw != "match_id"]
_TYPE_CHECKED = ["id", "index", "period", "timestamp", "type", "team", "player"]
_VIOLATION_COLS = ["unit", "match_id", "rule", "column_name", "value"]


@dataclass
class BatchResult:
    files: int
    accepted_files: int
    rejected_files: int
    accepted_rows: int


def typed_events(events: DataFrame, core_only: bool = False) -> DataFrame:
    """Exploded raw rows -> typed raw-named columns + per-row key/raw flags."""
    wanted = [(r, t) for r, t in _RAW_TYPES if not core_only or r in CORE_COLUMNS]
    keys = list(dict.fromkeys(REQUIRED_KEYS + _TYPE_CHECKED))
    return R.typed_columns(events.select("unit", "match_id", "version", "modified", "corrupt", "value"), wanted, keys)


def _staged_output(accepted: DataFrame, matches: DataFrame | None, core_only: bool) -> DataFrame:
    if core_only:
        return accepted.select("match_id", *[c for c in CORE_COLUMNS])
    out = accepted
    if matches is not None:
        out = attach_match_context(out.drop("home_team", "away_team"), matches)
    cols = []
    for raw, staged, t in STAGED:
        src = F.col(f"`{raw}`")
        if raw in ("period", "minute", "second"):
            src = src.cast("int")
        cols.append(src.alias(staged))
    return out.select(*cols)


def versions_path(processed_dir: str) -> str:
    """Folder beside the processed store with the version of each restated match."""
    return processed_dir.rstrip("/") + "_versions"


def stored_versions(spark: SparkSession, processed_dir: str) -> DataFrame | None:
    """(match_id, version) of restatements of earlier batches; matches that
    were never restated (version 0) have no row, so the table stays small."""
    path = spark._jvm.org.apache.hadoop.fs.Path(versions_path(processed_dir))
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    stored = spark.read.schema("match_id bigint, version decimal(38,0)").parquet(versions_path(processed_dir))
    return stored.select("match_id", "version")


@dataclass
class Checked:
    """One batch after its rules: the rows that may be stored, what becomes of
    each file (``invalid``, ``stale``, ``bad``: one of both), all failures, and
    the numbers of files, files that are out and valid restated ones."""
    typed: DataFrame
    rows: DataFrame
    files: DataFrame
    violations: DataFrame
    n_files: int
    n_bad: int
    n_restated: int

    def accepted(self) -> DataFrame:
        if not self.n_bad:
            return self.rows
        bad = self.files.filter("bad").select("unit").distinct()
        return Q.split_by_file(self.rows, bad, file_col="unit", max_files=self.n_bad)[0]

    def valid(self) -> DataFrame:
        return self.files.filter("not invalid")

    def result(self, n_rows: int) -> BatchResult:
        return BatchResult(files=self.n_files, accepted_files=self.n_files - self.n_bad,
                           rejected_files=self.n_bad, accepted_rows=n_rows)

    def release(self) -> None:
        self.files.unpersist()
        self.typed.unpersist()


def decided_files(facts: DataFrame, stored: DataFrame | None, reject: str) -> DataFrame:
    """The facts with ``reasons`` (file-level failures), ``invalid``, ``stale`` and ``bad``.

    Of the valid files one per match wins by version, modification time and
    path, unless ``stored`` (match_id, version) has a higher version from an
    earlier batch; the others are stale. Only rows of files are shuffled.
    """
    of_unit, of_match = Window.partitionBy("unit"), Window.partitionBy("match_id")
    failed = F.size("reasons") > 0
    if reject != "row":
        failed = failed | (F.col("n_failed") > 0)
    files = facts.withColumn("reasons", R.rejection_reasons(REQUIRED_KEYS))
    files = files.withColumn("invalid", F.bool_or(failed).over(of_unit))
    order = F.struct("version", "modified", "unit")
    files = files.withColumn("best", F.max(F.when(~F.col("invalid"), order)).over(of_match))
    newest = F.coalesce(F.col("best.unit") == F.col("unit"), F.lit(False))
    if stored is not None:
        earlier = stored.groupBy("match_id").agg(F.max("version").alias("stored"))
        files = files.join(earlier, "match_id", "left")
        newest = newest & (F.col("stored").isNull() | (F.col("best.version") >= F.col("stored")))
    files = files.withColumn("kept", F.bool_or(newest).over(of_unit))
    return files.select("unit", "match_id", "version", "n_failed", "reasons", "invalid",
                        (~F.col("invalid") & ~F.col("kept")).alias("stale"),
                        (F.col("invalid") | ~F.col("kept")).alias("bad"))


def file_violations(files: DataFrame) -> DataFrame:
    """The file-level failures and the superseded files, a row each."""
    none = F.lit(None).cast("string")
    reasons = F.transform("reasons", lambda r: F.struct(r["rule"].alias("rule"), r["column_name"].alias("column_name"),
                                                        none.alias("value")))
    late = F.array(F.struct(F.lit("superseded").alias("rule"), F.lit("version").alias("column_name"),
                            F.col("version").cast("string").alias("value")))
    found = F.when(F.col("stale"), F.concat(reasons, late)).otherwise(reasons)
    return (files.filter("stale or size(reasons) > 0").select("unit", "match_id", F.explode(found).alias("r"))
                 .select("unit", "match_id", "r.rule", "r.column_name", "r.value"))


def checked_batch(raw_rows: DataFrame, layout: str, core_only: bool, reject: str, stored: DataFrame | None) -> Checked:
    spark = raw_rows.sparkSession
    events = R.explode_events(raw_rows, layout)
    failed = F.col("_has_value") & Q.any_failed(Q.RAW_ROW_RULES)
    # the typed rows feed the facts, the rules and the write: computed once
    typed = (typed_events(events, core_only).withColumn("_failed", failed.cast("int"))
             .persist(StorageLevel.MEMORY_AND_DISK))
    # one aggregate per file decides what is accepted: events are not shuffled
    facts = R.file_facts(typed, REQUIRED_KEYS, F.col("_failed") == 1)
    tasks = 2 * max(spark.sparkContext.defaultParallelism, 4)  # a row per file
    files = decided_files(facts, stored, reject).coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK)
    n = files.agg(F.count(F.lit(1)).alias("files"), F.count_distinct(F.when(F.col("bad"), F.col("unit"))).alias("bad"),
                  F.count_if(~F.col("invalid") & (F.col("version") > 0)).alias("restated"))
    with small_methods(spark):
        n = n.first()
    rows = typed.filter(F.col("_has_value"))
    # the cache keeps the bounds of its batches: those without a failed row are passed over
    viol = Q.violations(typed.filter("_failed = 1"), Q.RAW_ROW_RULES, ["unit", "match_id"])
    viol = viol.select(*_VIOLATION_COLS).unionByName(file_violations(files).select(*_VIOLATION_COLS))
    if reject == "row":
        rows = rows.filter("_failed = 0")
    return Checked(typed, rows, files, viol, n["files"], n["bad"], n["restated"])


def ingest_batch(raw_rows: DataFrame, processed_dir: str, quarantine_dir: str, layout: str = "array",
                 batch_key: str | None = None, matches: DataFrame | None = None,
                 core_only: bool = False, reject: str = "file") -> BatchResult:
    """Validate and write one batch of raw files; returns the batch counts.

    ``reject="file"`` (default): one failing row rejects its whole file.
    ``reject="row"``: only failing rows are held back (filtered inline, no
    join); file-level failures (corrupt, empty, missing key) still reject
    the file.

    ``batch_key`` names the batch in the quarantine table; a retry must pass
    the same key (a stream passes its micro-batch id) so it replaces its rows.
    """
    batch_key = batch_key or f"run-{uuid.uuid4().hex[:16]}"
    stored = stored_versions(raw_rows.sparkSession, processed_dir)
    batch = checked_batch(raw_rows, layout, core_only, reject, stored)
    try:
        obs = Observation(f"ingest_{uuid.uuid4().hex[:8]}")
        out = _staged_output(batch.accepted(), matches, core_only).observe(obs, F.count(F.lit(1)).alias("rows"))
        write_partitioned(out, processed_dir, ["match_id"])
        write_quarantine(batch.violations, quarantine_dir, batch_key)
        if batch.n_restated:
            restated = batch.valid().filter("version > 0").groupBy("match_id").agg(F.max("version").alias("version"))
            write_partitioned(restated.withColumn("batch", F.lit(batch_key)), versions_path(processed_dir), ["batch"])
        return batch.result(int(obs.get.get("rows", 0)))
    finally:
        batch.release()


def ingest_generation(raw_rows: DataFrame, store: GenerationStore, quarantine_dir: str, batch_key: str,
                      layout: str = "array", matches: DataFrame | None = None,
                      reject: str = "file") -> BatchResult:
    """Validate one batch and append it to a generation store.

    The store hides older statements of a match when it is read, so a batch
    only adds: nothing stored is rewritten. A batch key that was committed
    before is not stored again (a retry after a lost driver).
    """
    batch = checked_batch(raw_rows, layout, False, reject, store.versions(raw_rows.sparkSession))
    try:
        kept = batch.files.filter("not bad").select("match_id", "version", "unit")
        n_rows = store.append(_staged_output(batch.accepted(), matches, False), kept, batch_key)
        write_quarantine(batch.violations, quarantine_dir, batch_key)
        return batch.result(n_rows)
    finally:
        batch.release()


def ingest_changes(spark: SparkSession, raw_dir: str, state_dir: str,
                   ingest: Callable[[DataFrame, str], BatchResult], layout: str = "array",
                   max_files: int = Q.MAX_BROADCAST_FILES) -> DataFrame:
    """Ingest the raw keys that were created or rewritten since the last call.

    The difference of the folder's listing and the stored one (path, length,
    modification time) is the batch, so a rewritten key is read again. It is
    written to ``state_dir`` before anything is ingested and counts as the
    stored listing only when all of it was: a run that breaks off is taken up
    with the same batch keys. A key that is gone is reported and its match
    stays stored. ``ingest(rows, batch_key)`` stores one batch of at most
    ``max_files`` files, in the lines layout folders: each touched folder is
    read whole, once. Returns the changes (key, change, size, modified).
    """
    changes, number, begun = listing_changes(spark, raw_dir, state_dir)
    unit = F.col("path") if layout == "array" else F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    units = changes.filter("change <> 'gone'").select(unit.alias("path")).distinct().withColumn("there", F.lit(True))
    if begun:  # what went meanwhile keeps its place in the batches but is not read
        now = list_objects(spark, raw_dir, "*.json").select(unit.alias("path")).distinct()
        units = units.drop("there").join(now.withColumn("there", F.lit(True)), "path", "left")

    def store(part: int, paths: list[str]) -> None:
        if paths:
            ingest(R.read_raw_files(spark, paths, layout), f"listing-{number:08d}-{part:05d}")

    n, paths = 0, []
    for row in units.orderBy("path").toLocalIterator():
        paths += [row["path"]] if row["there"] else []
        n += 1
        if n % max_files == 0:
            store(n // max_files - 1, paths)
            paths = []
    store(n // max_files, paths)
    commit_listing(spark, state_dir, number)
    return changes.select("key", "change", "size", "modified")


def ingest_files(spark, raw_dir: str, processed_dir: str, quarantine_dir: str, layout: str = "array",
                 matches: DataFrame | None = None, core_only: bool = False,
                 reject: str = "file", max_files_per_batch: int | None = None,
                 checkpoint: str | None = None) -> BatchResult:
    """Batch entry: ingest every ``*.json`` below ``raw_dir`` (recursively).

    All files are one batch, or, with ``max_files_per_batch``, an
    ``availableNow`` stream over the same folder in bounded micro-batches. A
    failed backfill of that kind resumes where it stopped if called again
    with the same ``checkpoint``; without one each call starts over.
    """
    if max_files_per_batch is None:
        rows = R.read_raw_files(spark, raw_dir, layout)
        return ingest_batch(rows, processed_dir, quarantine_dir, layout, None, matches, core_only, reject)
    from ..session import scratch_path
    from ..streaming.ingest_stream import run_ingest_stream
    run = run_ingest_stream(spark, raw_dir, processed_dir, quarantine_dir,
                            checkpoint or scratch_path(spark, "backfill"),
                            layout, max_files_per_batch, matches, core_only=core_only, reject=reject)
    return BatchResult(files=run.files, accepted_files=run.files - run.rejected_files,
                       rejected_files=run.rejected_files, accepted_rows=run.accepted_rows)
