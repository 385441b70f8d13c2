"""F-RAW: raw match files through the ingest (file-level rejection, both shapes)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from pitchside.plans.ingest import ingest_files
from pitchside.sources.raw_json import explode_events, read_raw_files

NESTED = {"id": "n-0001", "index": 1, "period": 1, "timestamp": "00:00:01.000",
          "type": {"name": "Pass"}, "team": {"name": "North United"},
          "player": {"id": 5503, "name": "Avery Stone"}, "location": [52.5, 31.0]}


def flat(i, **kw):
    e = {"id": f"e{i}", "index": i, "period": 1, "timestamp": "00:00:01.000", "type": "Pass",
         "team": "T1", "player": f"P{i}", "location": [1.0, 2.0]}
    e.update(kw)
    return e


def write_raw(root):
    files = {
        "raw/match_1.json": json.dumps([NESTED]),
        "raw/match_2.json": json.dumps([flat(1), flat(2, player=None)]),
        "raw/match_3.json": json.dumps([flat(1), flat(2, period=9), flat(3)]),
        "raw/match_4.json": json.dumps([flat(1, team=None), flat(2, id=None)]),
        "raw/match_5.json": '[{"id": "x", "index": 1,',
        "raw/match_6.json": "[]",
        "raw/match_7.json": json.dumps([{k: v for k, v in flat(1).items() if k != "player"}]),
        "raw/match_8.json": json.dumps([flat(1, player=None)]),
        "raw/match_11.json": json.dumps([flat(1, type={"id": 30})]),
        "raw/sub/match_9.json": json.dumps([flat(1)]),
        "raw/notes.txt": "not json",
        "other/match_10.json": json.dumps([flat(1)]),
    }
    for rel, text in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as f:
            f.write(text)


@pytest.fixture(scope="module")
def ingested(spark, tmp_path_factory):
    from pitchside.session import scratch_path
    root = scratch_path(spark, "fraw")
    write_raw(root)
    res = ingest_files(spark, os.path.join(root, "raw"), os.path.join(root, "processed"),
                       os.path.join(root, "quarantine"))
    processed = spark.read.parquet(os.path.join(root, "processed"))
    quarantine = spark.read.parquet(os.path.join(root, "quarantine"))
    return res, processed, quarantine


def test_picks_only_json_under_prefix(spark, ingested):
    res, _, _ = ingested
    assert res.files == 10  # match_1..9 and 11; not notes.txt, not other/


def test_accepted_matches(ingested):
    _, processed, _ = ingested
    got = {r.match_id: r.n for r in processed.groupBy("match_id").agg(F.count("*").alias("n")).collect()}
    assert got == {1: 1, 2: 2, 8: 1, 9: 1}


def test_nested_shape_flattened(ingested):
    _, processed, _ = ingested
    row = processed.filter("match_id = 1").first()
    assert (row.event_type, row.team_name, row.player_name) == ("Pass", "North United", "Avery Stone")
    assert row.player_id == 5503
    assert list(row.location) == [52.5, 31.0]


def test_rejections_reported_lazily(ingested):
    _, _, quarantine = ingested
    q = {(r.match_id, r.rule, r.column_name) for r in quarantine.collect()}
    assert (3, "accepted_values_period", "period") in q
    assert (4, "not_null_team", "team") in q and (4, "not_null_id", "id") in q
    assert (5, "corrupt", None) in q
    assert (6, "empty", None) in q
    assert (7, "missing_column", "player") in q
    assert (11, "not_null_type", "type") in q
    assert not any(m in (1, 2, 8, 9) for m, _, _ in q)


def test_object_without_name_is_null_not_text(spark, ingested):
    _, _, quarantine = ingested
    rows = quarantine.filter("match_id = 11 and column_name = 'type'").collect()
    assert {r.rule for r in rows} == {"type_type", "not_null_type"}
    assert all(r.value is None for r in rows)


def test_rerun_is_idempotent(spark, tmp_path_factory):
    from pitchside.session import scratch_path
    root = scratch_path(spark, "rerun")
    write_raw(root)
    args = (os.path.join(root, "raw"), os.path.join(root, "processed"), os.path.join(root, "q"))
    ingest_files(spark, *args)
    ingest_files(spark, *args)
    assert spark.read.parquet(args[1]).count() == 5


def test_restatement_keeps_newest(spark):
    from pitchside.session import scratch_path
    root = scratch_path(spark, "restate")
    os.makedirs(os.path.join(root, "raw"))
    with open(os.path.join(root, "raw", "match_1.json"), "w") as f:
        json.dump([flat(1), flat(2)], f)
    with open(os.path.join(root, "raw", "match_1__v2.json"), "w") as f:
        json.dump([flat(1, team="NEW")], f)
    ingest_files(spark, os.path.join(root, "raw"), os.path.join(root, "p"), os.path.join(root, "q"))
    rows = spark.read.parquet(os.path.join(root, "p")).collect()
    assert [r.team_name for r in rows] == ["NEW"]


def test_explode_keeps_empty_file_row(spark):
    from pitchside.session import scratch_path
    root = scratch_path(spark, "empty")
    os.makedirs(root)
    with open(os.path.join(root, "match_6.json"), "w") as f:
        f.write("[]")
    ev = explode_events(read_raw_files(spark, root))
    rows = ev.collect()
    assert len(rows) == 1 and rows[0].value is None and rows[0].match_id == 6


def test_row_level_rejection_keeps_good_rows(spark):
    from pitchside.session import scratch_path
    root = scratch_path(spark, "rowrej")
    write_raw(root)
    ingest_files(spark, os.path.join(root, "raw"), os.path.join(root, "p"), os.path.join(root, "q"),
                 reject="row")
    got = {r.match_id: r.n for r in spark.read.parquet(os.path.join(root, "p"))
           .groupBy("match_id").agg(F.count("*").alias("n")).collect()}
    # match_3 keeps its two good rows; match_4 has none left; file-level failures stay out
    assert got == {1: 1, 2: 2, 3: 2, 8: 1, 9: 1}


def test_core_only_projection(spark):
    from pitchside.session import scratch_path
    root = scratch_path(spark, "core")
    write_raw(root)
    ingest_files(spark, os.path.join(root, "raw"), os.path.join(root, "p"), os.path.join(root, "q"),
                 core_only=True)
    df = spark.read.parquet(os.path.join(root, "p"))
    assert sorted(df.columns) == sorted(["id", "index", "period", "timestamp", "type", "team", "player",
                                         "location", "match_id"])
    assert df.count() == 5


def test_large_backfill_runs_in_bounded_batches(spark):
    from pitchside.session import scratch_path
    root = scratch_path(spark, "backfill")
    write_raw(root)
    small = ingest_files(spark, os.path.join(root, "raw"), os.path.join(root, "p1"), os.path.join(root, "q1"))
    big = ingest_files(spark, os.path.join(root, "raw"), os.path.join(root, "p2"), os.path.join(root, "q2"),
                       max_files_per_batch=3)
    assert (big.files, big.rejected_files, big.accepted_rows) == (small.files, small.rejected_files,
                                                                  small.accepted_rows)
    a = spark.read.parquet(os.path.join(root, "p1"))
    b = spark.read.parquet(os.path.join(root, "p2"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_over_raw_fixtures_equals_batch(spark):
    from pitchside.session import scratch_path
    from pitchside.streaming.ingest_stream import run_ingest_stream
    root = scratch_path(spark, "fraw_stream")
    write_raw(root)
    raw = os.path.join(root, "raw")
    batch = ingest_files(spark, raw, os.path.join(root, "pb"), os.path.join(root, "qb"))
    run = run_ingest_stream(spark, raw, os.path.join(root, "ps"), os.path.join(root, "qs"),
                            os.path.join(root, "ck"))
    assert (run.files, run.rejected_files, run.accepted_rows) == (batch.files, batch.rejected_files,
                                                                  batch.accepted_rows)
    a = spark.read.parquet(os.path.join(root, "pb"))
    b = spark.read.parquet(os.path.join(root, "ps"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    qa = spark.read.parquet(os.path.join(root, "qb")).select("match_id", "rule", "column_name")
    qb = spark.read.parquet(os.path.join(root, "qs")).select("match_id", "rule", "column_name")
    assert qa.exceptAll(qb).count() == 0 and qb.exceptAll(qa).count() == 0


def test_backfill_resumes_with_its_checkpoint(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("resume"))
    write_raw(root)
    args = [f"{root}/{n}" for n in ("raw", "processed", "quarantine")]
    first = ingest_files(spark, *args, max_files_per_batch=4, checkpoint=f"{root}/ckpt")
    quarantined = spark.read.parquet(args[2]).count()
    again = ingest_files(spark, *args, max_files_per_batch=4, checkpoint=f"{root}/ckpt")
    assert first.files > 4 and again.files == 0
    assert spark.read.parquet(args[2]).count() == quarantined
