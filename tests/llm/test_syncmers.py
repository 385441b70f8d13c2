"""Fingerprints: every unit counts, positions decide, likeness as in plain Python."""

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchside.llm import syncmers

RNG = np.random.default_rng(8)
VOCAB = [f"w{k}" for k in range(3000)]


def words(n):
    return list(RNG.choice(VOCAB, n))


def parsed(fingerprint):
    """(place, hash) of every anchor of a written fingerprint."""
    out, place = [], 0
    for at in range(0, len(fingerprint), 11):
        place += int(fingerprint[at], 16)
        out.append((place, fingerprint[at + 1:at + 11]))
    return out


def likeness(one, two):
    a, b = {}, {}
    for side, anchors in ((a, parsed(one)), (b, parsed(two))):
        for place, h in anchors:
            side.setdefault(h, place)
    if not a and not b:
        return 1.0
    offsets = [b[h] - a[h] for h in a if h in b]
    norms = [sum(n * n for n in collections.Counter((d + shift) >> 6 for d in offsets).values()) for shift in (0, 32)]
    return math.sqrt(max(norms)) / max(len(a), len(b))


@pytest.fixture(scope="module")
def compare(spark):
    def run(pairs):
        df = spark.createDataFrame([(k, " ".join(a), " ".join(b)) for k, (a, b) in enumerate(pairs)], "k int, a string, b string")
        arrays = df.select("k", syncmers.anchors_of(F.col("a")).alias("a"), syncmers.anchors_of(F.col("b")).alias("b"))
        arrays = arrays.select("k", syncmers.written(F.col("a")).alias("one"), syncmers.written(F.col("b")).alias("two"),
                               syncmers.likeness(syncmers.placed(F.col("a")), syncmers.placed(F.col("b"))).alias("near"))
        rows = sorted(arrays.collect())
        for r in rows:
            assert r.near == pytest.approx(likeness(r.one, r.two), abs=1e-12)
        return rows
    return run


def edited(text, n):
    out = list(text)
    for at in RNG.choice(len(out), n, replace=False):
        out[at] = "edit" + out[at]
    return out


def test_every_edit_shows_at_any_length(compare):
    pairs = []
    for n in (1, 2, 7, 8, 9, 30, 500, 5000):
        text = words(n)
        pairs += [(text, edited(text, 1)), (text, text[:-1] + ["end"]), (text, ["start"] + text[1:])]
    for r in compare(pairs):
        assert r.one != r.two and r.near < 1.0
    long = words(20_000)
    forty, same = compare([(long, edited(long, 40)), (long, list(long))])
    assert forty.one != forty.two and 0.95 < forty.near < 1.0
    assert same.near == 1.0


def test_anchors_cover_the_text(spark, compare):
    for r in compare([(words(n), ["x"] * n) for n in (1, 8, 9, 100, 3000)]):
        for fingerprint in (r.one, r.two):
            places = [p for p, _ in parsed(fingerprint)]
            assert places[0] == 0 and all(0 < b - a < syncmers.RUN for a, b in zip(places, places[1:]))


def test_positions_decide(compare):
    base = words(20_000)
    blocks = [base[k:k + 100] for k in range(0, len(base), 100)]
    shuffled = [w for k in RNG.permutation(len(blocks)) for w in blocks[k]]
    passage = words(150)
    inserted = base[:9000] + words(20) + base[9000:]
    apart = (words(9000) + passage + words(9000), words(300) + passage + words(15_000))
    order, some, near, none = compare([(base, shuffled), apart, (base, inserted), (words(5000), words(5000))])
    assert order.near < 0.2 and near.near > 0.9
    assert 0 < some.near < 0.05 and none.near < 0.001


def test_empty_repeated_and_long_units(compare):
    rows = compare([([], []), ([], ["a"]), (["a"] * 50, ["a"] * 50), (["a"] * 50, ["a"] * 9), (["x" * 5000], ["x" * 4999 + "y"]),
                    (["a", "b"], ["b", "a"])])
    assert [r.near for r in rows[:2]] == [1.0, 0.0] and rows[0].one == "" and rows[2].near == 1.0
    assert rows[3].one != rows[3].two and rows[4].near < 1.0 and rows[5].near == 0.0


def test_single_document_and_one_id_with_two_texts(spark):
    one = spark.createDataFrame([(7, "only text of the table here")], "doc_id long, text string")
    r = syncmers.fingerprints(one).collect()
    assert len(r) == 1 and r[0].near_next == 1.0
    two = spark.createDataFrame([(7, "one text"), (7, "another text"), (7, "one text"), (None, None)], "doc_id long, text string")
    rows = syncmers.fingerprints(two).collect()
    assert len(rows) == 4 and len({x.fingerprint for x in rows}) == 3


def test_likeness_of_documents_in_order(spark):
    rows = [(k, " ".join(words(40 * (k % 5)))) for k in range(12)]
    rows += [(12, rows[11][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in syncmers.fingerprints(docs).collect()}
    for k in got:
        after = got[k - 1 if k else 12]
        assert got[k].near_next == pytest.approx(likeness(got[k].fingerprint, after.fingerprint), abs=1e-12)
        assert got[k].near_edited == pytest.approx(likeness(got[k].fingerprint, got[k].edited_fingerprint), abs=1e-12)
