"""Stores that change: restated and rewritten keys, generations, refresh by
change, co-located joins, mergeable counts, checks over batches."""

import datetime as dt
import glob
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from pitchside.fixtures import match_events, matches_dim
from pitchside.functions.keys import processed_key, raw_key
from pitchside.operators import distinct, marts, reports
from pitchside.operators.joins import attach_match_context
from pitchside.operators.quality import schema_of_files
from pitchside.operators.uniqueness import UniqueIndex
from pitchside.plans import listing, refresh, verify
from pitchside.plans.ingest import ingest_batch, ingest_changes, ingest_files, ingest_generation
from pitchside.plans.pipeline import PipelineConfig, build_marts, run_pipeline
from pitchside.schema import NAMED_FIELDS, REQUIRED_RAW, STAGED
from pitchside.session import LISTING_TASKS, METHOD_LIMIT, scratch_path, small_methods
from pitchside.sinks.generations import GenerationStore
from pitchside.sinks.writers import _name_by_match, export_events_json, export_match_arrays, open_bucketed, write_bucketed
from pitchside.sources.raw_json import read_raw_files, stream_names
from pitchside.sources.tables import read_table
from pitchside.streaming.alarm import alarm_states, alarm_transitions, failure_windows
from pitchside.streaming.dedup import run_dedup


def event(i, **kw):
    return {"id": f"e{i}", "index": i, "period": 1, "timestamp": "00:00:01.000", "type": "Pass",
            "team": "T1", "player": f"P{i}", **kw}


def put(root, name, events):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump(events, f)
    return path


def teams(spark, folder):
    return sorted((r.match_id, r.team_name) for r in spark.read.parquet(folder).collect())


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def fme(spark):
    return match_events(spark, SF0001).cache()


# -- one file per match wins ---------------------------------------------------

def test_equal_versions_in_one_batch_store_one_file(spark, scratch):
    raw, out = f"{scratch}/raw", [f"{scratch}/p", f"{scratch}/q"]
    old = put(raw, "b/match_1.json", [event(1, team="OLD"), event(2, team="OLD")])
    new = put(raw, "a/match_1.json", [event(1, team="NEW")])
    os.utime(old, (1_700_000_000, 1_700_000_000))
    os.utime(new, (1_700_000_100, 1_700_000_100))
    result = ingest_files(spark, raw, *out)
    assert teams(spark, out[0]) == [(1, "NEW")]
    assert (result.accepted_files, result.rejected_files) == (1, 1)
    late = spark.read.parquet(out[1]).collect()
    assert [(r.rule, r.unit.endswith("b/match_1.json")) for r in late] == [("superseded", True)]
    os.utime(new, (1_700_000_000, 1_700_000_000))  # equal times: the larger path
    ingest_files(spark, raw, f"{scratch}/p2", f"{scratch}/q2")
    assert teams(spark, f"{scratch}/p2") == [(1, "OLD"), (1, "OLD")]


def test_array_files_keep_all_columns_and_types(spark, scratch, fme):
    assert export_match_arrays(fme, f"{scratch}/raw") == 2
    texts = [open(p).read() for p in sorted(glob.glob(f"{scratch}/raw/match_*.json"))]
    assert [len(json.loads(t)) for t in texts] == [500, 500]
    assert [e["index"] for e in json.loads(texts[0])] == list(range(500))
    ingest_files(spark, f"{scratch}/raw", f"{scratch}/p", f"{scratch}/q")
    got = spark.read.parquet(f"{scratch}/p")
    types = {name: "string" if raw == "id" else kind for raw, name, kind in STAGED}
    found = dict(got.dtypes)
    assert {k: found[k] for k in types if k != "match_id"} == {k: v for k, v in types.items() if k != "match_id"}
    got = got.withColumn("event_id", F.col("event_id").cast("bigint")).select(*fme.columns)
    assert same(got.withColumn("match_id", F.col("match_id").cast("bigint")), fme)


# -- rewritten keys ------------------------------------------------------------

def test_rewritten_key_is_read_again(spark, scratch):
    raw, state = f"{scratch}/raw", f"{scratch}/state"
    store = lambda rows, key: ingest_batch(rows, f"{scratch}/p", f"{scratch}/q", batch_key=key)
    put(raw, "match_1.json", [event(1, team="A")])
    put(raw, "match_2.json", [event(1, team="B")])
    put(raw, "sub/match_3.json", [event(1, team="C")])
    first = ingest_changes(spark, raw, state, store)
    assert sorted((r.key, r.change) for r in first.collect()) == [
        ("match_1.json", "created"), ("match_2.json", "created"), ("sub/match_3.json", "created")]
    assert ingest_changes(spark, raw, state, store).count() == 0
    put(raw, "match_1.json", [event(1, team="A2"), event(2, team="A2")])
    os.remove(f"{raw}/match_2.json")
    put(raw, "match_4.json", [event(1, team="D")])
    again = ingest_changes(spark, raw, state, store)
    assert sorted((r.key, r.change) for r in again.collect()) == [
        ("match_1.json", "changed"), ("match_2.json", "gone"), ("match_4.json", "created")]
    assert teams(spark, f"{scratch}/p") == [(1, "A2"), (1, "A2"), (2, "B"), (3, "C"), (4, "D")]


def test_broken_off_changes_are_taken_up_with_the_same_keys(spark, scratch):
    raw, state, seen = f"{scratch}/raw", f"{scratch}/state", []

    def store(rows, key):
        seen.append((key, rows.count()))
        if len(seen) == 2:
            raise RuntimeError("lost")

    for k in range(3):
        put(raw, f"match_{k}.json", [event(k)])
    with pytest.raises(RuntimeError):
        ingest_changes(spark, raw, state, store, max_files=1)
    put(raw, "match_9.json", [event(9)])  # arrives meanwhile: belongs to the next difference
    ingest_changes(spark, raw, state, store, max_files=1)
    assert [k for k, _ in seen[2:]] == [f"listing-00000001-0000{n}" for n in range(3)] and seen[0] == seen[2]
    ingest_changes(spark, raw, state, store, max_files=1)
    assert seen[5:] == [("listing-00000002-00000", 1)]


def test_key_that_goes_before_the_retry_is_left_out(spark, scratch):
    raw, state, seen = f"{scratch}/raw", f"{scratch}/state", []

    def store(rows, key):
        seen.append((key, sorted(r.file_path[-6] for r in rows.collect())))
        if len(seen) == 1:
            raise RuntimeError("lost")

    for k in range(4):
        put(raw, f"match_{k}.json", [event(k)])
    with pytest.raises(RuntimeError):
        ingest_changes(spark, raw, state, store, max_files=2)
    os.remove(f"{raw}/match_1.json")
    ingest_changes(spark, raw, state, store, max_files=2)
    assert seen[1:] == [("listing-00000001-00000", ["0"]), ("listing-00000001-00001", ["2", "3"])]
    assert [(r.key, r.change) for r in ingest_changes(spark, raw, state, store).collect()] == [("match_1.json", "gone")]


def test_touched_lines_folder_is_read_whole_once(spark, scratch, fme):
    raw, seen = f"{scratch}/raw", []
    export_events_json(fme.repartition(3), raw, rebalance=False)
    ingest_changes(spark, raw, f"{scratch}/state", lambda rows, key: seen.append(rows.count()), "lines")
    folder = glob.glob(f"{raw}/match_id=0")[0]
    shutil.copy(glob.glob(f"{folder}/part-*")[0], f"{folder}/part-again.json")
    ingest_changes(spark, raw, f"{scratch}/state", lambda rows, key: seen.append(rows.count()), "lines")
    assert seen[0] == 1000 and 500 < seen[1] < 1000


def test_listing_difference_with_nulls_and_empty(spark):
    none = spark.createDataFrame([], listing.LISTING)
    now = spark.createDataFrame([("a", "f:/a", 1, None), ("b", "f:/b", None, None)], listing.LISTING)
    assert {r.change for r in listing.difference(none, now).collect()} == {"created"}
    assert {r.change for r in listing.difference(now, none).collect()} == {"gone"}
    assert listing.difference(now, now).count() == 0 and listing.difference(none, none).count() == 0


# -- generations ----------------------------------------------------------------

def statements(spark, *rows):
    return spark.createDataFrame([(m, v, f"f{m}") for m, v in rows], "match_id bigint, version int, unit string")


def test_generations_hide_older_and_unfinished_statements(spark, scratch, fme):
    staged = fme.withColumn("event_id", F.col("event_id").cast("string"))
    store = GenerationStore(scratch, buckets=4)
    assert store.read(spark).count() == 0 and store.compact(spark) == 0
    named = lambda name, *m: staged.filter(F.col("match_id").isin(*m)).withColumn("team_name", F.lit(name))
    read = lambda: {(r.match_id, r.team_name, r.n) for r in store.read(spark).groupBy("match_id", "team_name").agg(
        F.count("*").alias("n")).collect()}
    assert store.append(named("one", 0, 1), statements(spark, (0, 0), (1, 5)), "b1") == 1000
    store.write_rows(named("killed", 0, 1), store.next_generation(spark))
    assert read() == {(0, "one", 500), (1, "one", 500)}
    store.append(named("two", 0, 1), statements(spark, (0, 0), (1, 4)), "b2")  # match 1: an older version, late
    assert read() == {(0, "two", 500), (1, "one", 500)}
    assert store.append(named("three", 0), statements(spark, (0, 1)), "b2") == 0  # the key was committed
    assert read() == {(0, "two", 500), (1, "one", 500)}
    before = store.generations(spark)
    base = store.compact(spark)
    assert store.generations(spark) == [base] and base > max(before)
    assert not glob.glob(f"{scratch}/data/generation=00000001")
    assert read() == {(0, "two", 500), (1, "one", 500)}
    store.append(named("late", 1), statements(spark, (1, 4)), "b4")  # the compaction kept the version
    assert read() == {(0, "two", 500), (1, "one", 500)}
    assert len(glob.glob(f"{scratch}/data/generation=*/bucket=*")) <= 2 * 4


def test_compaction_that_breaks_off_reads_the_same(spark, scratch, fme):
    store = GenerationStore(scratch, buckets=2)
    staged = fme.withColumn("event_id", F.col("event_id").cast("string"))
    store.append(staged, statements(spark, (0, 0), (1, 0)), "b1")
    g = store.next_generation(spark)
    store.write_rows(store.read(spark), g)
    assert same(store.read(spark), staged.select(*[s for _, s, _ in STAGED]))
    store.write_commit(store.latest(spark), g, "compact")  # nothing removed yet
    assert store.read(spark).count() == 1000


def test_ingest_into_generations(spark, scratch):
    store, raw = GenerationStore(f"{scratch}/store"), f"{scratch}/raw"
    put(raw, "one/match_1__v2.json", [event(1, team="NEW")])
    put(raw, "one/match_2.json", [event(1, team=None)])
    put(raw, "two/match_1.json", [event(1, team="OLD")])
    put(raw, "two/match_2.json", [event(1, team="GOOD")])
    for name in ("one", "two", "two"):
        got = ingest_generation(read_raw_files(spark, f"{raw}/{name}"), store, f"{scratch}/q", name)
        assert (got.accepted_files, got.rejected_files) == (1, 1)
    assert sorted((r.match_id, r.team_name) for r in store.read(spark).collect()) == [(1, "NEW"), (2, "GOOD")]
    dead = {(r.batch, r.match_id, r.rule) for r in spark.read.parquet(f"{scratch}/q").collect()}
    assert dead == {("one", 2, "not_null_team"), ("two", 1, "superseded")}


# -- joins on stored buckets ------------------------------------------------------

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_co_located_joins_have_no_exchange(spark, scratch, fme):
    events = write_bucketed(fme.select("event_id", "match_id", "event_type"), "t_events", f"{scratch}/events", buckets=4)
    write_bucketed(matches_dim(fme), "t_matches", f"{scratch}/matches", buckets=4)
    spark.sql("drop table t_matches")  # another session opens the stored folder
    matches = open_bucketed(spark, "t_matches", f"{scratch}/matches",
                            "match_id bigint, home_team string, away_team string, home_score bigint, away_score bigint", buckets=4)
    joined = attach_match_context(events, matches, co_located=True)
    assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
    assert same(joined.select("event_id", "home_team"), fme.select("event_id", "home_team"))
    keys = fme.select("match_id").distinct().select(raw_key("match_id").alias("raw_key"))
    keys = keys.withColumn("processed_key", processed_key("raw_key"))
    manifest = write_bucketed(keys, "t_manifest", f"{scratch}/manifest", "processed_key", 4)
    objects = write_bucketed(keys.limit(1).select("processed_key", F.lit(7).alias("size")), "t_objects", f"{scratch}/objects",
                             "processed_key", 4)
    checked = verify.verify_stored(manifest, objects)
    assert "Exchange" not in plan_of(checked)
    assert sorted(r.status for r in checked.collect()) == ["found", "missing"]
    for name in ("t_events", "t_matches", "t_manifest", "t_objects"):
        spark.sql(f"drop table {name}")


# -- refresh by change --------------------------------------------------------------

def files_of(root):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{root}/*/bucket=*/part-*")}


def test_refresh_rewrites_touched_partitions_only(spark, scratch):
    ev = match_events(spark, "/root/testdata/sf0.01")  # 20 matches
    store, root = f"{scratch}/events", f"{scratch}/marts"
    refresh.store_events(ev.filter("match_id <> 3 or period = 1"), store, buckets=8)
    refresh.refresh_marts(spark, store, root, buckets=8)
    before = files_of(root)
    touched = refresh.replace_matches(store, ev.filter("match_id = 3"), buckets=8)
    stored = refresh.refresh_marts(spark, store, root, touched, buckets=8)
    after = files_of(root)
    assert len(touched) == 1
    changed = {p for p in before.keys() | after.keys() if before.get(p) != after.get(p)}
    assert changed and all(f"bucket={touched[0]}/" in p for p in changed)
    for name, full in build_marts(ev).items():
        assert same(stored[name].select(*full.columns), full), name
    assert refresh.replace_matches(store, ev.limit(0), buckets=8) == []


def test_refresh_empties_a_partition(spark, scratch, fme):
    store, root = f"{scratch}/events", f"{scratch}/marts"
    refresh.store_events(fme, store, buckets=64)
    refresh.refresh_marts(spark, store, root, names=["mart_shot_analysis"])
    quiet = fme.filter("match_id = 1 and event_type <> 'Shot'")
    touched = refresh.replace_matches(store, quiet)
    mart = refresh.refresh_marts(spark, store, root, touched, ["mart_shot_analysis"])["mart_shot_analysis"]
    assert [r.match_id for r in mart.select("match_id").distinct().collect()] == [0]


# -- distinct counts that merge -------------------------------------------------

def test_hubs_merge_from_stored_bitmaps(spark, scratch, fme):
    network = marts.mart_pass_networks(fme)
    ids = distinct.dense_ids(network, "recipient_name")
    n = ids.count()
    assert sorted(r.id for r in ids.collect()) == list(range(n))
    distinct.recipient_bitmaps(network, ids).write.partitionBy("match_id").parquet(scratch)
    stored = spark.read.parquet(scratch)
    hubs = distinct.hubs_from_bitmaps(stored, k=1000)
    assert "events.parquet" not in plan_of(hubs)
    assert same(hubs, reports.report_hubs(network, k=1000))
    one = reports.report_hubs(network.filter("match_id = 1"), k=1000)
    assert same(distinct.hubs_from_bitmaps(stored.filter("match_id = 1"), k=1000), one)


def test_bitmaps_of_many_ids_and_null_teams(spark):
    rows = [(m, "a", None, f"r{k}", 2, 50.0) for m in (1, 2) for k in range(m * 20_000)]
    network = spark.createDataFrame(rows, "match_id long, passer_name string, team_name string, recipient_name string, "
                                          "total_passes long, completion_pct double")
    stored = distinct.recipient_bitmaps(network, distinct.dense_ids(network, "recipient_name"))
    got = distinct.hubs_from_bitmaps(stored).collect()
    assert [tuple(r) for r in got] == [("a", None, 40_000, 120_000, 50.0)]


# -- alarm states -------------------------------------------------------------------

def test_alarm_states_and_transitions(spark):
    at = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    rows = [(at(0, 1),), (at(0, 4),), (at(0, 6),), (at(0, 20),), (at(1, 0),), (at(1, 5),)]
    failures = spark.createDataFrame(rows, "ts timestamp_ntz")
    windows = failure_windows(failures)
    got = sorted((r["at"], r.state) for r in alarm_transitions(windows).collect())
    assert got == [(at(0, 0), "ALARM"), (at(0, 10), "OK"), (at(0, 20), "ALARM"), (at(0, 25), "OK"),
                   (at(1, 0), "ALARM"), (at(1, 10), "OK")]
    busy = sorted((r["at"], r.state) for r in alarm_transitions(windows, threshold=1).collect())
    assert busy == [(at(0, 0), "ALARM"), (at(0, 5), "OK")]
    states = alarm_states(windows, "2024-01-01 00:00:00", "2024-01-01 01:15:00").orderBy("window_start").collect()
    assert [r.n_failures for r in states] == [2, 1, 0, 0, 1] + [0] * 7 + [1, 1, 0]
    assert [r.state for r in states].count("ALARM") == 5
    assert alarm_transitions(windows.limit(0)).count() == 0
    assert "Window" not in plan_of(alarm_transitions(windows))


# -- checks over files and batches -----------------------------------------------

def test_schema_of_files(spark):
    records = [("a", json.dumps(event(1))), ("a", json.dumps(event(2, period="1", player=None))),
               ("b", json.dumps(event(1, team={"name": "T"}, index=1.5))), ("b", json.dumps({"id": None})),
               ("c", json.dumps({**event(1), "team": {"id": 3}, "type": None}))]
    df = spark.createDataFrame(records, "unit string, body string").select("unit", F.parse_json("body").alias("value"))
    got = {(r.unit, r.column_name): (r.found, r.status) for r in schema_of_files(df, REQUIRED_RAW, NAMED_FIELDS).collect()}
    assert len(got) == 21
    assert got["a", "period"] == ("VARIANT", "type") and got["a", "player"] == ("STRING", "ok")
    assert got["b", "team"] == ("STRING", "ok") and got["b", "index"][1] == "type" and got["b", "id"] == ("STRING", "ok")
    assert got["c", "team"][1] == "type" and got["c", "type"] == ("VOID", "null") and got["c", "id"] == ("STRING", "ok")


def test_unique_index_over_batches(spark, scratch):
    index = UniqueIndex(scratch, "event_id", buckets=4)
    batch = lambda *ids: spark.createDataFrame([(i,) for i in ids], "event_id bigint")
    found = lambda df: sorted((r.id, r.n_records) for r in df.collect())
    assert found(index.add(batch(1, 2, None, None), "a")) == []
    assert found(index.add(batch(2, 3, 3), "b")) == [(2, 2), (3, 2)]
    assert found(index.add(batch(2, 3, 3), "b")) == [(2, 2), (3, 2)]  # a retry
    assert found(index.add(batch(9), "c")) == [] and found(index.add(batch(2), "d")) == [(2, 3)]
    all_found = index.duplicates(spark)
    assert sorted((r.event_id, r.n_records) for r in all_found.collect()) == [(2, 3), (3, 2)]
    assert "/ids" not in plan_of(all_found) and "events" not in plan_of(all_found)


def test_stream_drops_records_delivered_again(spark, scratch):
    ev = read_table(spark, SF0001, "events", ["event_id", "event_type", "ts"])
    ev.filter("event_id % 2 = 0").coalesce(1).write.parquet(f"{scratch}/in/one")
    args = (spark, f"{scratch}/in", ev.schema, f"{scratch}/out", f"{scratch}/ck", ["event_id"], "ts", "60 days")
    assert run_dedup(*args, max_files_per_trigger=1).count() == ev.count() / 2
    ev.coalesce(1).write.parquet(f"{scratch}/in/two")  # everything, half of it again
    assert same(run_dedup(*args, max_files_per_trigger=1), ev)


# -- the pipeline's parameters ------------------------------------------------------

def test_pipeline_filters_season_and_skips_tests(spark, fme):
    catalogue = matches_dim(fme).withColumns({"competition_id": F.when(F.col("match_id") == 1, 43).otherwise(11),
                                              "season_id": F.lit(106)})
    plain = fme.drop("home_team", "away_team").withColumns({"home_team": F.lit("?"), "away_team": F.lit("?")})
    cfg = PipelineConfig(root=scratch_path(spark, "season"), run_tests=False)
    assert (cfg.competition_id, cfg.season_id, cfg.max_matches, cfg.run_tests) == (43, 106, 5, False)
    row = run_pipeline(spark, plain, catalogue, cfg).first()
    assert (row.ingested, row.processed, row.events_loaded, row.failed_tests, row.transform_status) == (1, 1, 500, 0, "success")
    stored = spark.read.parquet(cfg.path("processed"))  # the teams come from the catalogue
    assert same(stored.select("home_team", "away_team").distinct(), fme.filter("match_id = 1").select("home_team", "away_team").distinct())


def test_pipeline_over_lines_folders(spark, fme):
    cfg = PipelineConfig(root=scratch_path(spark, "lines"), competition_id=None, season_id=None, layout="lines")
    row = run_pipeline(spark, fme, matches_dim(fme), cfg).first()
    assert (row.ingested, row.processed, row.events_loaded, row.transform_status) == (2, 2, 1000, "success")


def test_listing_has_real_sizes(spark, scratch):
    path = put(scratch, "a.b+c/match_1.json", [event(1)])
    put(scratch, "match_2.txt", [])
    got = verify.list_objects(spark, scratch, "*.json").collect()
    assert [(r.key, r["size"]) for r in got] == [("a.b+c/match_1.json", os.path.getsize(path))]
    assert verify.list_objects(spark, f"{scratch}/none").count() == 0


def test_listings_run_in_few_tasks(spark, scratch):
    default = "10000"
    raw = f"{scratch}/raw"
    put(raw, "match_1.json", [event(1, team="A")])
    spark.conf.set(LISTING_TASKS, default)
    read_raw_files(spark, raw)
    assert int(spark.conf.get(LISTING_TASKS)) <= 2 * max(spark.sparkContext.defaultParallelism, 4)
    spark.conf.set(LISTING_TASKS, "77")  # a session's own value stays
    read_raw_files(spark, raw)
    assert spark.conf.get(LISTING_TASKS) == "77"
    spark.conf.set(LISTING_TASKS, default)


def test_lines_stream_carries_names_alone(spark, scratch):
    put(f"{scratch}/raw", "match_id=1/part-0.json", [event(1, team="A")])
    names = stream_names(spark, f"{scratch}/raw")
    assert names.columns == ["file_path"]
    seen = []
    q = names.writeStream.foreachBatch(lambda b, _: seen.extend(r.file_path for r in b.collect())).option(
        "checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [s.rpartition("/")[2] for s in seen] == ["part-0.json"]


def test_a_match_in_two_files_is_not_renamed(spark, scratch):
    for n in range(2):
        put(f"{scratch}/_parts", f"match_id=1/part-{n}.json", [event(1, team="A")])
    with pytest.raises(ValueError, match="match 1 was written as 2 files"):
        _name_by_match(spark, f"{scratch}/_parts", lambda m: f"{scratch}/match_{m}.json")
    assert not os.path.exists(f"{scratch}/match_1.json")


# -- the work of one batch -----------------------------------------------------

def test_a_batch_runs_few_jobs(spark, scratch):
    for n in range(1, 5):
        put(f"{scratch}/raw", f"match_{n}.json", [event(1, period=9 if n == 3 else 1), event(2)])
    put(f"{scratch}/raw", "match_4__v2.json", [event(1, team="NEW")])
    sc = spark.sparkContext
    sc.setJobGroup(scratch, "one batch")
    try:
        result = ingest_files(spark, f"{scratch}/raw", f"{scratch}/p", f"{scratch}/q")
    finally:
        sc._jsc.clearJobGroup()
    assert (result.files, result.rejected_files, result.accepted_rows) == (5, 2, 5)
    assert len(sc.statusTracker().getJobIdsForGroup(scratch)) <= 18
    late = spark.read.parquet(f"{scratch}/q").select("match_id", "rule", "value").collect()
    assert sorted(map(tuple, late)) == [(3, "accepted_values_period", "9"), (4, "superseded", "0")]


def test_first_batch_without_restatements_stores_no_versions(spark, scratch):
    put(f"{scratch}/raw", "match_1.json", [event(1)])
    ingest_files(spark, f"{scratch}/raw", f"{scratch}/p", f"{scratch}/q")
    assert not os.path.exists(f"{scratch}/p_versions")
    put(f"{scratch}/raw2", "match_1__v3.json", [event(1, team="NEW")])
    ingest_files(spark, f"{scratch}/raw2", f"{scratch}/p", f"{scratch}/q")
    assert [(r.match_id, int(r.version)) for r in spark.read.parquet(f"{scratch}/p_versions").collect()] == [(1, 3)]


def test_one_bad_record_takes_out_every_file_of_its_folder(spark, scratch):
    put(f"{scratch}/raw", "match_id=1/part-0.json", event(1))
    put(f"{scratch}/raw", "match_id=1/part-1.json", event(2, period=9))
    put(f"{scratch}/raw", "match_id=2/part-0.json", event(1))
    result = ingest_files(spark, f"{scratch}/raw", f"{scratch}/p", f"{scratch}/q", "lines")
    assert (result.files, result.rejected_files, result.accepted_rows) == (2, 1, 1)
    assert teams(spark, f"{scratch}/p") == [(2, "T1")]


def test_small_methods_hold_for_the_write_alone(spark):
    before = spark.conf.get(METHOD_LIMIT)
    with pytest.raises(KeyError), small_methods(spark):
        assert spark.conf.get(METHOD_LIMIT) == "8000"
        raise KeyError
    assert spark.conf.get(METHOD_LIMIT) == before
    spark.conf.set(METHOD_LIMIT, "20000")  # a session's own value stays
    with small_methods(spark):
        assert spark.conf.get(METHOD_LIMIT) == "20000"
    spark.conf.set(METHOD_LIMIT, before)


def test_pipeline_computes_its_catalogue_once(spark, scratch, fme):
    seen = spark.sparkContext.accumulator(0)

    def counted(name):
        seen.add(1)
        return name

    matches = matches_dim(fme).withColumn("home_team", F.udf(counted, "string")("home_team"))
    n = matches_dim(fme).count()
    cfg = PipelineConfig(root=scratch, competition_id=None, season_id=None, max_matches=None, run_tests=False,
                         max_files_per_trigger=1)
    row = run_pipeline(spark, fme, matches, cfg).first()
    assert (row.ingested, row.processed, row.events_loaded) == (n, n, fme.count()) and n > 1
    assert seen.value == n
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= 1  # the fixture's own
