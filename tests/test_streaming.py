"""Stream = batch, restart picks up only new files, alarm windows."""

import json
import os

from pyspark.sql import functions as F

from conftest import SF0001
from pitchside.fixtures import match_events
from pitchside.plans.ingest import ingest_files
from pitchside.session import scratch_path
from pitchside.sinks.writers import export_events_json
from pitchside.sources.tables import read_table
from pitchside.streaming.alarm import failure_windows, run_stream_alarm
from pitchside.streaming.ingest_stream import run_ingest_stream


def _flat(i, **kw):
    e = {"id": f"e{i}", "index": i, "period": 1, "timestamp": "00:00:01.000", "type": "Pass",
         "team": "T1", "player": f"P{i}"}
    e.update(kw)
    return e


def test_stream_equals_batch(spark):
    root = scratch_path(spark, "s_eq")
    export_events_json(match_events(spark, SF0001, "dirty"), os.path.join(root, "raw"))
    ingest_files(spark, os.path.join(root, "raw"), os.path.join(root, "b"), os.path.join(root, "bq"), "lines")
    run = run_ingest_stream(spark, os.path.join(root, "raw"), os.path.join(root, "s"),
                            os.path.join(root, "sq"), os.path.join(root, "ck"), "lines")
    b = spark.read.parquet(os.path.join(root, "b"))
    s = spark.read.parquet(os.path.join(root, "s"))
    assert b.count() == s.count() == run.accepted_rows
    assert b.exceptAll(s).count() == 0
    assert run.rejected_files > 0


def test_restart_processes_only_new_files(spark):
    root = scratch_path(spark, "s_new")
    raw = os.path.join(root, "raw")
    os.makedirs(raw)
    with open(os.path.join(raw, "match_1.json"), "w") as f:
        json.dump([_flat(1), _flat(2)], f)
    args = (spark, raw, os.path.join(root, "p"), os.path.join(root, "q"), os.path.join(root, "ck"))
    first = run_ingest_stream(*args)
    again = run_ingest_stream(*args)
    with open(os.path.join(raw, "match_2.json"), "w") as f:
        json.dump([_flat(1)], f)
    third = run_ingest_stream(*args)
    assert (first.files, again.files, third.files) == (1, 0, 1)
    got = {r.match_id: r.n for r in spark.read.parquet(os.path.join(root, "p"))
           .groupBy("match_id").agg(F.count("*").alias("n")).collect()}
    assert got == {1: 2, 2: 1}


def test_lines_folder_over_several_batches_is_stored_whole(spark):
    root = scratch_path(spark, "s_straddle")
    folder = os.path.join(root, "raw", "match_id=1")
    os.makedirs(folder)
    for part in range(3):
        with open(os.path.join(folder, f"part-{part}.json"), "w") as f:
            f.writelines(json.dumps(_flat(10 * part + i)) + "\n" for i in range(4))
    run = run_ingest_stream(spark, os.path.join(root, "raw"), os.path.join(root, "p"), os.path.join(root, "q"),
                            os.path.join(root, "ck"), "lines", max_files_per_trigger=1)
    stored = spark.read.parquet(os.path.join(root, "p"))
    assert len(run.batches) == 3
    assert (stored.count(), stored.select("event_id").distinct().count()) == (12, 12)


def test_older_restatement_of_a_later_batch_is_superseded(spark):
    root = scratch_path(spark, "s_order")
    out = [os.path.join(root, n) for n in ("p", "q")]
    for name, team in (("match_1__v2", "NEW"), ("match_1", "OLD"), ("match_1__v3", "LAST")):
        raw = os.path.join(root, f"raw-{name}")
        os.makedirs(raw)
        with open(os.path.join(raw, f"{name}.json"), "w") as f:
            json.dump([_flat(1, team=team)], f)
        ingest_files(spark, raw, *out)
        expected = "NEW" if team == "OLD" else team
        assert [r.team_name for r in spark.read.parquet(out[0]).collect()] == [expected]
    late = spark.read.parquet(out[1]).collect()
    assert [(r.match_id, r.rule, r.value) for r in late] == [(1, "superseded", "0")]


def test_version_of_too_many_digits_is_rejected(spark):
    root = scratch_path(spark, "s_digits")
    raw = os.path.join(root, "raw")
    os.makedirs(raw)
    for name in ("match_1", "match_1__v" + "9" * 60, "match_" + "9" * 30):
        with open(os.path.join(raw, f"{name}.json"), "w") as f:
            json.dump([_flat(1)], f)
    res = ingest_files(spark, raw, os.path.join(root, "p"), os.path.join(root, "q"))
    assert (res.files, res.rejected_files) == (3, 2)
    assert {r.rule for r in spark.read.parquet(os.path.join(root, "q")).collect()} == {"bad_key"}


def test_stream_alarm_equals_batch(spark):
    root = scratch_path(spark, "s_alarm")
    ev = read_table(spark, SF0001, "events")
    batch = failure_windows(ev.filter(F.col("event_type") == "error"), "ts")
    stream = run_stream_alarm(spark, SF0001, "events.parquet", ev.schema, os.path.join(root, "out"),
                              os.path.join(root, "ck"), F.col("event_type") == "error")
    assert batch.count() == stream.count() > 0
    assert batch.exceptAll(stream).count() == 0
    assert stream.filter(~F.col("alarm")).count() == 0


def test_pipeline_audit_mode_keeps_failed_marts_unpublished(spark):
    from pitchside.fixtures import matches_dim
    from pitchside.plans.pipeline import PipelineConfig, run_pipeline
    ev = match_events(spark, SF0001, "dirty")
    cfg = PipelineConfig(root=scratch_path(spark, "audit"), competition_id=None, season_id=None, max_matches=None, publish="after_tests")
    row = run_pipeline(spark, ev, matches_dim(ev), cfg).first()
    assert row.ingested == 2 and row.processed + row.missing == 2
    published = os.path.exists(os.path.join(cfg.root, "warehouse", "mart_team_summary"))
    assert published == (row.transform_status == "success")
    assert spark.table("stg_events").count() == row.events_loaded


def test_quarantine_rerun_replaces_its_batch(spark):
    from pitchside.plans.ingest import ingest_batch
    from pitchside.sources.raw_json import read_raw_files
    root = scratch_path(spark, "qrerun")
    raw = os.path.join(root, "raw")
    os.makedirs(raw)
    with open(os.path.join(raw, "match_3.json"), "w") as f:
        json.dump([_flat(1, period=9)], f)
    for _ in range(2):  # a retried batch with the same key
        ingest_batch(read_raw_files(spark, raw), os.path.join(root, "p"), os.path.join(root, "q"),
                     batch_key="b-1")
    assert spark.read.parquet(os.path.join(root, "q")).count() == 1


def test_stream_alarm_append_mode_finalised_windows(spark):
    root = scratch_path(spark, "s_alarm_app")
    ev = read_table(spark, SF0001, "events")
    batch = failure_windows(ev.filter(F.col("event_type") == "error"), "ts")
    app = run_stream_alarm(spark, SF0001, "events.parquet", ev.schema, os.path.join(root, "out"),
                           os.path.join(root, "ck"), F.col("event_type") == "error", output_mode="append")
    # windows still inside the watermark delay stay open: append emits a subset, each exactly once
    assert 0 < app.count() < batch.count()
    assert app.exceptAll(batch).count() == 0


def test_pipeline_with_nothing_to_upload(spark):
    from pitchside.fixtures import matches_dim
    from pitchside.plans.pipeline import PipelineConfig, run_pipeline
    ev = match_events(spark, SF0001)
    cfg = PipelineConfig(root=scratch_path(spark, "empty_run"), competition_id=None, season_id=None, max_matches=0)
    row = run_pipeline(spark, ev, matches_dim(ev), cfg).first()
    assert (row.ingested, row.processed, row.missing, row.transform_status) == (0, 0, 0, "no_data")
