"""Registered queries of stores and changes: raw files as they are uploaded,
restatements and rewritten keys, generations, co-located joins, marts
refreshed by change, mergeable distinct counts, alarm states, schema and
uniqueness checks over batches, streaming de-duplication.

Imported at the end of ``registry``, which owns the two tables of keys.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle_sql as O
from .fixtures import competitions_dim, match_events, matches_dim
from .functions.keys import match_id_from_key, processed_key, raw_key
from .operators import distinct, marts, reports
from .operators import quality as Q
from .operators.joins import attach_match_context
from .operators.uniqueness import UniqueIndex
from .plans import refresh
from .plans import verify as V
from .plans.ingest import ingest_changes, ingest_files, ingest_generation
from .plans.pipeline import _match_keys
from .registry import _MATCHES_SQL, _NO_ARRAYS_SQL, _HUBS_SQL, _VIOLATIONS_SQL, _no_arrays, register
from .schema import NAMED_FIELDS, REQUIRED_RAW, STAGED_COLUMNS
from .session import scratch_path
from .sinks.generations import GenerationStore
from .sinks.writers import export_match_arrays, to_nested, write_bucketed, write_table
from .sources.raw_json import read_raw_files
from .sources.tables import read_table
from .streaming.alarm import alarm_transitions, failure_windows
from .streaming.dedup import run_dedup

_STAGED_SQL = f"select {_NO_ARRAYS_SQL} from fme"


def staged_out(df: DataFrame) -> DataFrame:
    """All 39 staged columns; raw ids are text, the fixture's are numbers."""
    return _no_arrays(df.select(*STAGED_COLUMNS).withColumn("event_id", F.col("event_id").cast("bigint")))


def _root(spark: SparkSession, name: str):
    root = scratch_path(spark, name)
    return lambda *parts: os.path.join(root, *parts)


# -- the upload format: one nested JSON array per match file -----------------

@register("ingest_array_raw", f"{O.fme_with()} {_STAGED_SQL}")
def q_ingest_array_raw(spark, sf):
    at, fme = _root(spark, "array"), match_events(spark, sf)
    export_match_arrays(fme.drop("home_team", "away_team"), at("raw"))
    write_table(matches_dim(fme), at("matches"))  # its size is known then, so the events are not shuffled for it
    ingest_files(spark, at("raw"), at("processed"), at("quarantine"), matches=spark.read.parquet(at("matches")))
    return staged_out(spark.read.parquet(at("processed")))


@register("ingest_restatement", f"""{O.fme_with()}
select match_id, count(*) as n_rows, cast(any_value(match_id % 4 in (1, 2)) as int) as n_superseded,
  cast(any_value(match_id % 4 = 0) as int) as n_rejected from fme group by match_id""")
def q_ingest_restatement(spark, sf):
    """Per match (by match_id % 4): 0, a valid file and a corrupt second
    version; 1, the second version comes before the first; 2, two files of
    equal version in one batch, the whole one later; 3, one file."""
    at, fme = _root(spark, "restatement"), match_events(spark, sf)
    kind = lambda *k: fme.filter((F.col("match_id") % 4).isin(*k))
    half = lambda df: df.filter("period = 1")
    export_match_arrays(half(kind(2)), at("raw1", "a"))
    export_match_arrays(kind(0, 3), at("raw1"))
    export_match_arrays(kind(0).withColumn("period", F.lit(9)), at("raw1"), suffix="__v2")
    export_match_arrays(kind(1), at("raw1"), suffix="__v2")
    export_match_arrays(kind(2), at("raw1", "b"))
    export_match_arrays(half(kind(1)), at("raw2"))
    for raw in ("raw1", "raw2"):
        ingest_files(spark, at(raw), at("processed"), at("quarantine"))
    dead = spark.read.parquet(at("quarantine")).select("match_id", "unit", (F.col("rule") == "superseded").alias("late")).distinct()
    dead = dead.groupBy("match_id").agg(F.count_if("late").alias("n_superseded"), F.count_if(~F.col("late")).alias("n_rejected"))
    rows = spark.read.parquet(at("processed")).groupBy("match_id").agg(F.count(F.lit(1)).alias("n_rows"))
    n = lambda c: F.coalesce(c, F.lit(0)).cast("int").alias(c)
    return rows.join(dead, "match_id", "left").select("match_id", "n_rows", n("n_superseded"), n("n_rejected"))


@register("ingest_rewritten_key", f"""{O.fme_with()}
select match_id, case match_id % 5 when 0 then 'changed' when 4 then 'created' else 'gone' end as change,
  count(*) as n_rows from fme where match_id % 5 in (0, 3, 4) group by match_id""")
def q_ingest_rewritten_key(spark, sf):
    """Keys written, rewritten with more events, added and removed between
    two calls: one row per change of the second, and what is stored."""
    at, fme = _root(spark, "rewritten"), match_events(spark, sf)
    kind = lambda *k: fme.filter((F.col("match_id") % 5).isin(*k))

    def store(rows: DataFrame, batch_key: str):
        from .plans.ingest import ingest_batch
        return ingest_batch(rows, at("processed"), at("quarantine"), batch_key=batch_key)

    export_match_arrays(kind(1, 2).unionByName(kind(0).filter("period = 1")), at("raw"))
    export_match_arrays(kind(3), at("raw", "old"))
    ingest_changes(spark, at("raw"), at("state"), store)
    export_match_arrays(kind(0, 4), at("raw"))
    path = spark._jvm.org.apache.hadoop.fs.Path(at("raw", "old"))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    changes = ingest_changes(spark, at("raw"), at("state"), store)
    rows = spark.read.parquet(at("processed")).groupBy("match_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return changes.select(match_id_from_key("key").alias("match_id"), "change").join(rows, "match_id")


@register("ingest_generations", f"{O.fme_with()} {_STAGED_SQL}")
def q_ingest_generations(spark, sf):
    """Three overlapping batches, a repeated one, one that is killed before its
    commit and a compaction between them; the store reads as the source."""
    at, fme = _root(spark, "generations"), match_events(spark, sf)
    store = GenerationStore(at("store"), buckets=8)
    batches = [fme.filter("match_id % 3 <> 2 and period = 1"), fme.filter("match_id % 3 <> 0"),
               fme.filter("match_id % 3 = 0 or match_id % 2 = 0")]
    for n, batch in enumerate(batches):
        export_match_arrays(batch, at(f"raw{n}"))
        ingest_generation(read_raw_files(spark, at(f"raw{n}")), store, at("quarantine"), f"batch-{n}")
        if n == 1:
            store.compact(spark)
            store.write_rows(fme.limit(0).unionByName(batches[0]).withColumn("team_name", F.lit("killed")),
                             store.next_generation(spark))
    ingest_generation(read_raw_files(spark, at("raw2")), store, at("quarantine"), "batch-2")
    return staged_out(store.read(spark))


def _ingested_dirty(spark, sf, name):
    at, fme = _root(spark, name), match_events(spark, sf, "dirty")
    export_match_arrays(fme, at("raw"))
    return at, ingest_files(spark, at("raw"), at("processed"), at("quarantine"))


@register("dead_letters", f"""{O.fme_with('dirty')}{_VIOLATIONS_SQL}
select match_id, case column_name when 'team_name' then 'not_null_team' else rule end as rule,
  case column_name when 'team_name' then 'team' else column_name end as column_name, value, count(*) as n
from viol group by all""")
def q_dead_letters(spark, sf):
    """The dead letters as written by an ingest of raw files."""
    at, _ = _ingested_dirty(spark, sf, "dead")
    return spark.read.parquet(at("quarantine")).groupBy("match_id", "rule", "column_name", "value").agg(
        F.count(F.lit(1)).alias("n"))


@register("verify_listing", f"""{O.fme_with('dirty')}{_VIOLATIONS_SQL}
select format('raw/match_{{}}.json', match_id) as raw_key, format('processed/match_{{}}.parquet', match_id) as processed_key,
  if(bad, 'missing', 'found') as status, not bad as has_bytes
from (select match_id, match_id in (select match_id from viol) as bad from fme group by match_id)""")
def q_verify_listing(spark, sf):
    """Uploaded keys against the processed objects, both from their stores'
    listings with real sizes."""
    at, _ = _ingested_dirty(spark, sf, "verify")
    uploaded = _match_keys(V.list_objects(spark, at("raw"), "*.json"), "raw", ".json")
    stored = _match_keys(V.list_objects(spark, at("processed"), "*.parquet"), "processed", ".parquet")
    checked = V.verify_processed(uploaded.select(F.col("key").alias("raw_key")), stored)
    return checked.select("raw_key", "processed_key", "status", (F.coalesce("size", F.lit(0)) > 0).alias("has_bytes"))


@register("load_metrics", f"""{O.fme_with('dirty')}{_VIOLATIONS_SQL}
select count(distinct match_id) as files, count(distinct match_id) filter (not bad) as accepted_files,
  count(distinct match_id) filter (bad) as rejected_files, count(*) filter (not bad) as accepted_rows
from (select match_id, match_id in (select match_id from viol) as bad from fme)""")
def q_load_metrics(spark, sf):
    """What an ingest observed of itself while it wrote."""
    _, seen = _ingested_dirty(spark, sf, "metrics")
    return spark.createDataFrame([(seen.files, seen.accepted_files, seen.rejected_files, seen.accepted_rows)],
                                 "files bigint, accepted_files bigint, rejected_files bigint, accepted_rows bigint")


@register("matches_of_season", f"""{O.fme_with()},{_MATCHES_SQL}
select match_id, home_team, away_team, home_score, away_score from matches join competitions on season_name = home_team
where competition_id = 0 and season_id = 0""")
def q_matches_of_season(spark, sf):
    return reports.list_matches(matches_dim(match_events(spark, sf), competitions_dim(spark, sf)), 0, 0)


_NULL_MATCH = O.fme_with().replace("fme as (select * from fme_base)", """fme as (
  select * replace (if(event_id % 11 = 0, null, match_id) as match_id) from fme_base)""")


@register("mart_player_null_match", f"{_NULL_MATCH},{O.mart_player_sql()} select * from mart_player")
def q_mart_player_null_match(spark, sf):
    """Events without a match: their players have a row and join nothing."""
    fme = match_events(spark, sf)
    return marts.mart_player_performance(fme.withColumn(
        "match_id", F.when(F.col("event_id") % 11 != 0, F.col("match_id"))))


# -- joins on stored buckets -------------------------------------------------------

def _table(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:10]}"


@register("context_co_located", f"""{O.fme_with()},{_MATCHES_SQL}
select f.event_id, f.match_id, f.event_type, f.team_name, m.home_team, m.away_team
from fme f join matches m on f.match_id = m.match_id""")
def q_context_co_located(spark, sf):
    at, fme = _root(spark, "buckets"), match_events(spark, sf)
    events = write_bucketed(fme.select("event_id", "match_id", "event_type", "team_name"), _table("events"), at("events"))
    matches = write_bucketed(matches_dim(fme), _table("matches"), at("matches"))
    return attach_match_context(events, matches, co_located=True).select(
        "event_id", "match_id", "event_type", "team_name", "home_team", "away_team")


@register("verify_co_located", f"""{O.fme_with()}
select format('raw/match_{{}}.json', match_id) as raw_key, format('processed/match_{{}}.parquet', match_id) as processed_key,
  if(match_id % 3 = 0, 'missing', 'found') as status, if(match_id % 3 = 0, null, count(*)) as size from fme group by match_id""")
def q_verify_co_located(spark, sf):
    at = _root(spark, "buckets")
    keys = (match_events(spark, sf).groupBy("match_id").agg(F.count(F.lit(1)).alias("size"))
            .select("match_id", "size", raw_key("match_id").alias("raw_key"))
            .withColumn("processed_key", processed_key("raw_key")))
    manifest = write_bucketed(keys.select("raw_key", "processed_key"), _table("manifest"), at("manifest"), "processed_key")
    listing = write_bucketed(keys.filter("match_id % 3 <> 0").select("processed_key", "size"), _table("listing"),
                             at("listing"), "processed_key")
    return V.verify_stored(manifest, listing)


# -- marts by change, distinct counts that merge -----------------------------

@register("mart_refresh_changed", f"{O.fme_with()},{O.mart_team_sql()} select * from mart_team")
def q_mart_refresh_changed(spark, sf):
    """Half of some matches is stored first; their whole events arrive, and
    only the buckets of these matches are computed again."""
    at, fme = _root(spark, "refresh"), match_events(spark, sf)
    refresh.store_events(fme.filter("match_id % 5 <> 0 or period = 1"), at("events"))
    refresh.refresh_marts(spark, at("events"), at("marts"), names=["mart_team_summary"])
    touched = refresh.replace_matches(at("events"), fme.filter("match_id % 5 = 0"))
    return refresh.refresh_marts(spark, at("events"), at("marts"), touched, ["mart_team_summary"])["mart_team_summary"]


@register("hubs_from_bitmaps", _HUBS_SQL)
def q_hubs_from_bitmaps(spark, sf):
    at = _root(spark, "bitmaps")
    network = marts.mart_pass_networks(match_events(spark, sf))
    ids = distinct.dense_ids(network, "recipient_name")
    distinct.recipient_bitmaps(network, ids).write.parquet(at("stored"))
    return distinct.hubs_from_bitmaps(spark.read.parquet(at("stored")))


# -- alarm states, schema and uniqueness checks, de-duplication --------------

@register("alarm_transitions", """
with w as (select distinct time_bucket(interval 5 minute, ts) s from events where event_type = 'error'),
t as (select s, lag(s) over (order by s) before, lead(s) over (order by s) after from w)
select s as at, 'ALARM' as state from t where before is null or before < s - interval 5 minute
union all select s + interval 5 minute, 'OK' from t where after is null or after > s + interval 5 minute""")
def q_alarm_transitions(spark, sf):
    ev = read_table(spark, sf, "events", ["event_type", "ts"]).filter(F.col("event_type") == "error")
    return alarm_transitions(failure_windows(ev, "ts"))


def _faulty_json(fme: DataFrame) -> DataFrame:
    """Raw records (unit, value) with a schema fault by match_id % 6: 1, half
    of the periods are text; 2, no team key; 3, all players null; 4, index is
    text; 5, team null."""
    raw = to_nested(fme.withColumn("event_id", F.col("event_id").cast("string")))
    body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns]), {"ignoreNullFields": "false"})
    fault, replace = F.col("match_id") % 6, F.regexp_replace
    body = (F.when((fault == 1) & (F.col("index") % 2 == 0), replace(body, r'"period":(\d+)', '"period":"$1"'))
            .when(fault == 2, replace(body, r'"team":(\{[^}]*\}|null),', ""))
            .when(fault == 3, replace(body, r'"player":\{[^}]*\}', '"player":null'))
            .when(fault == 4, replace(body, r'"index":(\d+)', '"index":"$1"'))
            .when(fault == 5, replace(body, r'"team":\{[^}]*\}', '"team":null')).otherwise(body))
    return raw.select(raw_key("match_id").alias("unit"), F.parse_json(body).alias("value"))


@register("dq_schema", f"""{O.fme_with()},
files as (select match_id, match_id % 6 as fault, count(player_name) as players from fme group by match_id),
columns_ as (select unnest(['id', 'index', 'period', 'timestamp', 'type', 'team', 'player']) as column_name),
found as (
  select format('raw/match_{{}}.json', match_id) as unit, column_name,
    if(column_name in ('index', 'period'), 'bigint', 'string') as declared,
    case when column_name = 'period' and fault = 1 then 'VARIANT'
      when column_name = 'team' and fault in (2, 5) or column_name = 'player' and (fault = 3 or players = 0) then 'VOID'
      when column_name = 'index' and fault = 4 then 'STRING'
      when column_name in ('index', 'period') then 'BIGINT' else 'STRING' end as found, fault
  from files, columns_)
select unit, column_name, declared, found,
  case when column_name = 'team' and fault = 2 then 'missing' when column_name = 'team' and fault = 5 then 'null'
    when column_name = 'period' and fault = 1 or column_name = 'index' and fault = 4 then 'type' else 'ok' end as status
from found""")
def q_dq_schema(spark, sf):
    return Q.schema_of_files(_faulty_json(match_events(spark, sf)), REQUIRED_RAW, NAMED_FIELDS)


_BATCHES = ["event_id % 2 = 0", "event_id % 2 = 1 or event_id % 3100 = 0", "event_id % 6200 = 0 or event_id % 4999 = 1"]


@register("dq_unique_incremental", f"""{O.fme_with()},
delivered as ({' union all '.join(f"select event_id from fme where {b}" for b in _BATCHES)})
select event_id, count(*) as n_records from delivered group by event_id having count(*) > 1""")
def q_dq_unique_incremental(spark, sf):
    at, fme = _root(spark, "unique"), match_events(spark, sf)
    index = UniqueIndex(at("index"), "event_id", buckets=8)
    for n, batch in enumerate(_BATCHES):
        index.add(fme.filter(batch).select("event_id"), f"batch-{n}")
    return index.duplicates(spark)


@register("stream_dedup", "select distinct event_id, event_type, user_id, value, ts from events")
def q_stream_dedup(spark, sf):
    """The same records under two keys: a first file without every third
    record, then a second without every other third."""
    at = _root(spark, "dedup")
    ev = read_table(spark, sf, "events", ["event_id", "event_type", "user_id", "value", "ts"])
    for n, part in enumerate(("event_id % 3 <> 0", "event_id % 3 <> 1")):
        ev.filter(part).coalesce(1).write.parquet(at("in", f"delivery-{n}"))
    return run_dedup(spark, at("in"), ev.schema, at("out"), at("checkpoint"), ["event_id"], "ts", "60 days",
                     max_files_per_trigger=1)
