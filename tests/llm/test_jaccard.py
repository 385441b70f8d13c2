"""Near-duplicate join: recall against all pairs, and work that stays on banded pairs."""

import collections
import re

import numpy as np
from pyspark.sql import functions as F

from pitchside.llm import jaccard

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text):
    w = WORDS.findall(text or "")
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def linked_pairs(texts):
    """All pairs of different sets at 0.8 or more, by shared n-grams."""
    having = collections.defaultdict(list)
    for k, s in texts.items():
        for g in s:
            having[g].append(k)
    common = collections.Counter()
    for ks in having.values():
        common.update((a, b) for n, a in enumerate(ks) for b in ks[n + 1:])
    return {(a, b) for (a, b), n in common.items() if 5 * n >= 4 * (len(texts[a]) + len(texts[b]) - n)}


def test_recall_against_all_pairs(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    rng = np.random.default_rng(4)
    vocab = [f"v{k}" for k in range(5000)]
    near = []
    for k in range(150):  # pairs about the threshold
        base = list(rng.choice(vocab, 120))
        other = list(base)
        for at in rng.choice(120, int(rng.integers(1, 5)), replace=False):
            other[at] = f"z{k}-{at}"
        near += [(10**6 + 2 * k, " ".join(base)), (10**6 + 2 * k + 1, " ".join(other))]
    all_rows = [(r.doc_id, r.text) for r in rows] + near
    links = linked_pairs({k: grams(t) for k, t in all_rows})
    want = collections.Counter(k for pair in links for k in pair)
    docs = spark.createDataFrame(all_rows, "doc_id long, text string")
    got = {r.doc_id: r for r in jaccard.classes(docs).collect()}
    assert len(got) == len(all_rows)
    found = sum(got[k].n_links for k, _ in all_rows)
    assert all(got[k].n_links <= want[k] for k, t in all_rows if t)
    recall = found / sum(want.values())
    print(f"links {sum(want.values()) // 2}, recall {recall:.5f}")
    assert recall >= 0.999
    for a, b in links:
        if got[a].n_links == want[a] and got[b].n_links == want[b]:
            assert got[a].class_id == got[b].class_id


def test_template_texts_meet_in_banded_pairs_only(spark, monkeypatch):
    """Texts that share a template below the threshold: their bands tie them
    in chains, but no pair without a common band is compared."""
    rng = np.random.default_rng(6)
    template = " ".join(f"t{k}" for k in range(100))
    rows = [(k, template + " " + " ".join(rng.choice([f"u{n}" for n in range(9000)], 105))) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    bands, per = jaccard.choose_bands(0.8, jaccard.RECALL, jaccard.HASHES)
    signed = [r.bands for r in docs.select("doc_id", F.lit(0).cast("long").alias("text_tag"), F.col("doc_id").alias("doc_key"), "text")
              .select("doc_key", "text_tag", "text").mapInArrow(
                  lambda b: jaccard._signatures(b, 5, bands, per),
                  "doc_key long, text_tag long, sequence long, check long, n_words long, bands array<long>").collect()]
    buckets = collections.defaultdict(set)
    for k, own in enumerate(signed):
        for band in own:
            buckets[band].add(k)
    distinct = {frozenset(b) for b in buckets.values() if len(b) > 1}
    compared = sum(len(b) * (len(b) - 1) // 2 for b in distinct)
    assert 0 < compared < 600 * 599 // 2 / 4
    got = jaccard.classes(docs).collect()
    assert all(r.n_links == 0 and r.class_id == r.doc_id for r in got)


def test_pairs_of_several_sets_count_once(spark):
    rng = np.random.default_rng(9)
    base = list(rng.choice([f"v{k}" for k in range(500)], 400))
    rows = []
    for k in range(60):
        own = list(base)
        own[int(rng.integers(400))] = f"x{k}"
        rows.append((k, " ".join(own)))
    rows += [(100, rows[0][1]), (101, None), (102, ""), (None, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    links = linked_pairs({k: grams(t) for k, t in rows if t})
    want = collections.Counter(k for pair in links for k in pair)
    for options in ({}, {"block": 7}, {"block_words": 900}):
        got = {r.doc_id: r for r in jaccard.classes(docs, **options).collect()}
        assert {k: got[k].n_links for k, t in rows if t} == {k: want[k] for k, t in rows if t}
        assert got[101].n_links == 1 and got[101].class_id == 101 == got[102].class_id
        assert {got[k].class_id for k, t in rows if t} == {0}
