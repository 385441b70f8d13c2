"""Every corpus query: columns of its contract, and its SQL where it has one."""

import os

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from conftest import SF0001
from pitchside.llm.queries import ORACLES, QUERIES
from test_oracles import TABLES, _rows

COLUMNS = {
    "op1_html_text": "page_id url text n_chars", "op2_suffix_array_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op3_mixing": "doc_id", "op4_substring_dedup": "doc_id n_words n_removed kept_sha256",
    "op5_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op6_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op7_jaccard_join": "doc_id class_id n_links", "op8_url_filter": "page_id host path rule verdict",
    "op9_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op10_license_scan": "doc_id licence", "op11_divergence_audit": "lang source part item value rank",
    "op12_phrase_mining": "lang rank phrase a l r n score", "op13_line_dedup": "doc_id n_lines n_dropped kept_sha256"}


def test_all_are_registered():
    assert set(QUERIES) == set(COLUMNS) and set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(ORACLES) <= set(E.oracle_sql()) and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, key):
    got = E.queries()[key](spark, SF0001)
    assert set(COLUMNS[key].split()) <= set(got.columns)
    if key not in ORACLES:
        rows = got.count()
        table = "pages" if key in ("op1_html_text", "op8_url_filter") else "documents"
        n = spark.read.parquet(f"{SF0001}/{table}.parquet").count()
        assert rows >= n if key == "op5_packing" else rows == n
        return
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        path = os.path.join(SF0001, f"{t}.parquet")
        con.execute(f"create view {t} as select * from read_parquet('{path}')")
    assert _rows(got.toPandas()) == _rows(con.execute(E.oracle_sql()[key]).df())
