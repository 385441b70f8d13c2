"""Streaming ingest (T1-T3, T5): new raw files -> validate -> Parquet + quarantine.

A file-source stream over the raw folder (``*.json``, recursive, since a
prefix filter is recursive) feeds ``plans.ingest.ingest_batch`` through
``foreachBatch``; batch and stream share that one function. The
checkpoint records which files were processed (exactly-once bookkeeping),
and the sink is idempotent per match (dynamic partition overwrite), so a
retried micro-batch after an executor or driver loss rewrites the same
partitions. ``maxFilesPerTrigger`` bounds each micro-batch.

Note: a file source ignores a rewritten path; a restated match arrives as a
new file name (``match_<id>__v<n>.json``), or the folder is ingested by the
difference of its listings (``plans.ingest.ingest_changes``), which also reads
a lines folder of many files once instead of once per micro-batch.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.ingest import BatchResult, ingest_batch
from ..sources.raw_json import read_raw_files, stream_names


@dataclass
class StreamRun:
    """Counts by micro-batch; a retried one replaces its own. A lines folder
    that spans several micro-batches is stored once and counted in each."""
    batches: dict[int, BatchResult] = field(default_factory=dict)

    @property
    def files(self) -> int:
        return sum(b.files for b in self.batches.values())

    @property
    def rejected_files(self) -> int:
        return sum(b.rejected_files for b in self.batches.values())

    @property
    def accepted_rows(self) -> int:
        return sum(b.accepted_rows for b in self.batches.values())


def whole_folders(batch: DataFrame) -> DataFrame:
    """All files of every folder a micro-batch touches: in the lines layout
    the folder is one match, written and rejected as a whole, so a folder
    that spans micro-batches is read again with the files that came before.
    The folder list is bounded by the files of one trigger."""
    folder = F.regexp_extract("file_path", r"^(.*)/[^/]*$", 1).alias("folder")
    folders = [unquote(r["folder"]) for r in batch.select(folder).distinct().collect()]
    return read_raw_files(batch.sparkSession, folders, "lines") if folders else batch


def start_ingest_stream(spark: SparkSession, raw_dir: str, processed_dir: str, quarantine_dir: str,
                        checkpoint: str, layout: str = "array", max_files_per_trigger: int = 1000,
                        matches: DataFrame | None = None, available_now: bool = True,
                        processing_time: str | None = None, run: StreamRun | None = None,
                        core_only: bool = False, reject: str = "file"):
    """Start the ingest query; returns the StreamingQuery."""
    run = run if run is not None else StreamRun()
    if layout == "lines":  # each batch reads its folders whole: the stream carries names, not records
        rows = stream_names(spark, raw_dir, max_files_per_trigger)
    else:
        rows = read_raw_files(spark, raw_dir, layout, stream=True, max_files_per_trigger=max_files_per_trigger)

    stream_name = "stream-" + hashlib.sha1(checkpoint.encode()).hexdigest()[:12]

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        if layout == "lines":
            batch = whole_folders(batch)
        # same checkpoint + same batch id on a retry -> same quarantine partition
        run.batches[batch_id] = ingest_batch(batch, processed_dir, quarantine_dir, layout,
                                             f"{stream_name}-{batch_id:08d}", matches,
                                             core_only=core_only, reject=reject)

    w = rows.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def run_ingest_stream(spark: SparkSession, raw_dir: str, processed_dir: str, quarantine_dir: str,
                      checkpoint: str, layout: str = "array", max_files_per_trigger: int = 1000,
                      matches: DataFrame | None = None, timeout_s: int | None = None,
                      core_only: bool = False, reject: str = "file") -> StreamRun:
    """Process every file present now and wait for it: a real barrier in
    place of a fixed sleep (T5). ``timeout_s`` bounds the wait if given."""
    run = StreamRun()
    q = start_ingest_stream(spark, raw_dir, processed_dir, quarantine_dir, checkpoint, layout,
                            max_files_per_trigger, matches, True, None, run, core_only, reject)
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("ingest stream did not finish in time")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return run
