"""Divergence audit, phrase mining and line dedup against plain Python."""

import collections
import hashlib
import re

import numpy as np
import pytest

from pitchside.llm import divergence, lines, phrases

RNG = np.random.default_rng(11)
VOCAB = ["Alpha", "beta", "Éta", "ça", "delta-x", "eps7ilon", "zeta"]
LINE = "A Line that is Long enough to be a key, surely so É"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, term string, doc_key string"


def prose(n):
    words = RNG.choice(VOCAB, n)
    return "".join(w + RNG.choice([" ", " ", " ", "\t ", ", ", ".\n"]) for w in words)


ROWS = [(k, prose(int(RNG.integers(1, 60))), ["en", "de", None][k % 3], [f"s{k % 5}", None][k % 7 == 0]) for k in range(60)]
ROWS += [(100 + k, "x\n" + " " * k + LINE + "\t\n" + LINE.upper().replace("É", "É") * (k % 2), "en", "s1") for k in range(7)]
ROWS += [(200, None, None, None), (201, "", "en", "s9"), (202, "\n\n", "fr", "s1"), (203, "12 + 3", "xx", "s1"),
         (None, LINE, "en", "s1"), (None, "other\n" + LINE, "en", "s2"), (5, LINE.lower(), "en", "s1"),
         (100, "x\n" + LINE + "\t\n", "en", "s1"), (300, "alpha beta " * 4000, "en", "s1"), (301, LINE + "\r\n" + LINE, "en", "s1"),
         (302, "\x00 nul \x1c sep\x0bcut", "en", "")]
ROWS += [ROWS[3], ROWS[3]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([r + (len(r[1] or ""), "t", "k") for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def expected_audit(rows, least, top):
    terms = [(r[2] or "", r[3] or "", lower_terms(r[1] or "")) for r in rows]
    docs, total = collections.Counter(), collections.Counter()
    cells = collections.Counter()
    for lang, source, found in terms:
        docs.update((lang, t) for t in set(found))
        cells.update((lang, source, t) for t in found)
    groups = sorted({(a, b) for a, b, _ in terms})
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (a, t), n in docs.items() if a == lang and n >= least)
        own = [s for a, s in groups if a == lang]
        for s in own:
            for t in kept:
                total[t] += cells[lang, s, t]
        def share(count):
            n = sum(count(t) for t in kept)
            return {t: 1 + 10 ** 9 * (count(t) + 5) // (n + 5 * len(kept)) for t in kept}
        q = share(lambda t: sum(cells[lang, s, t] for s in own))
        p = {s: share(lambda t: cells[lang, s, t]) for s in own}
        for s in own:
            pair = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in own if o != s]
            term = [(q[t] - p[s][t], t) for t in kept if cells[lang, s, t] and p[s][t] > q[t]]
            for part, found in (("pair", pair), ("term", sorted(term, key=lambda x: (x[0], x[1].encode()))[:top])):
                found = sorted(found, key=lambda x: (x[0], x[1].encode()))
                out += [(lang, s, part, item, -v, k) for k, (v, item) in enumerate(found, 1)]
    return sorted(out)


def lower_terms(text):
    return [lower(t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]


@pytest.mark.parametrize("options", [{}, {"rows": 2, "columns": 3}, {"rows": 1, "columns": 1}])
def test_audit(docs, options):
    got = sorted(tuple(r) for r in divergence.audit(docs, least_documents=4, top=3, **options).collect())
    assert got == expected_audit(ROWS, 4, 3)


def test_audit_without_kept_terms(docs):
    rows = divergence.audit(docs, least_documents=10_000).collect()
    assert rows and all(r["part"] == "pair" and r["value"] == 0 for r in rows)


def test_joint_walk_of_sparse_blocks():
    for rows_a, rows_b, width, filled in ((1, 1, 1, 1.0), (3, 20, 70, 0.02), (17, 9, 130, 0.3), (40, 33, 65, 0.0)):
        def side(n):
            empty = RNG.integers(1, 50, n)
            shares = RNG.integers(50, 90, (n, width)) * (RNG.random((n, width)) < filled)
            return shares, empty, np.where(shares > 0, shares, empty[:, None])
        a, ea, full_a = side(rows_a)
        b, eb, full_b = side(rows_b)
        want = np.abs(full_a[:, None, :] - full_b[None, :, :]).sum(axis=2)
        assert (divergence.joint_distances(a, b, ea, eb, width) == want).all()


def test_counts_in_small_portions(docs, monkeypatch):
    """Tasks that send their counts in many portions give the same sums."""
    whole = sorted(tuple(r) for r in divergence.group_counts(docs).filter("term <> ''").collect())
    monkeypatch.setattr(divergence, "HELD_TERMS", 2)
    batch = docs.select("lang", "source", "text").na.fill("").toArrow().to_batches()
    sums = collections.Counter()
    for part in divergence._partial_counts(iter(batch)):
        for r in part.to_pylist():
            sums[r["lang"], r["source"], r["term"], "n"] += r["n"]
            sums[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
    assert whole == sorted((a, b, t, sums[a, b, t, "n"], sums[a, b, t, "docs"]) for a, b, t in {k[:3] for k in sums if k[2]})


def expected_phrases(rows, least, longest, top, covered=80):
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    cand = {x: a for x, a in f.items() if a >= least and len(x[1]) > 1}
    out = collections.defaultdict(list)
    gone = set()
    for (lang, w), a in cand.items():
        for k in range(2, len(w)):
            gone |= {(lang, w[i:i + k]) for i in range(len(w) - k + 1) if 100 * a >= covered * f[lang, w[i:i + k]]}
    for (lang, w), a in cand.items():
        if (lang, w) not in gone:
            score, _, l, r = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                                 for k in range(1, len(w)))
            out[lang].append((-score, -a, " ".join(w).encode(), l, r))
    return sorted((lang, k, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0])
                  for lang, found in out.items() for k, x in enumerate(sorted(found)[:top], 1))


@pytest.mark.parametrize("options", [
    {"least": 3, "longest": 4, "top": 2000}, {"least": 2, "longest": 4, "top": 5, "block": 30}])
def test_phrases(docs, options):
    got = sorted(tuple(r) for r in phrases.collocations(docs, **options).collect())
    want = expected_phrases(ROWS, options["least"], options["longest"], options["top"])
    assert got == want and want


def test_bound_prunes_growth(spark, monkeypatch):
    """Phrases whose bound lies under the floor are never grown."""
    close = "left right " * 50
    loose = ". ".join(f"w{k % 12} w{k // 12 % 12}" for k in range(144 * 35))
    rows = [(1, close + ". " + loose, "en", "s")]
    seen = []
    keyed = phrases._keyed
    monkeypatch.setattr(phrases, "_keyed", lambda df: (seen.extend(r["phrase"] for r in df.collect()), keyed(df))[1])
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = [tuple(r) for r in phrases.collocations(docs, least=30, top=1, block=14).collect()]
    assert got == expected_phrases(rows, 30, 4, 1)
    assert "left right" in seen and sum(p.startswith("w") and " " in p for p in seen) < 72


def test_score_beyond_64_bits(spark):
    df = spark.range(1).selectExpr("cast(9000000000000000000 as long) a", "cast(9100000000000000000 as decimal(20,0)) b")
    assert df.select(phrases.score(df["a"], df["b"]).alias("s")).head()["s"] == 2_000_000 * 9 * 10 ** 18 // (91 * 10 ** 17)


def expected_lines(rows, chars, least):
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    order = lambda k: (1 << 63) - 1 if k is None else k
    holders = collections.defaultdict(set)
    for doc_id, text, *_ in rows:
        for x in (text or "").split("\n"):
            if len(key(x)) >= chars:
                holders[key(x)].add(order(doc_id))
    out = []
    for doc_id, text, *_ in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if len(holders.get(key(x), ())) < least or max(holders[key(x)]) == order(doc_id)]
        out.append((doc_id, len(own), len(own) - len(kept), "\n".join(kept)))
    return sorted(out, key=lambda r: (order(r[0]), r[3]))


@pytest.mark.parametrize("limits", [(40, 5), (1, 2)])
def test_lines(docs, limits):
    rows = lines.drop_common(docs, *limits).collect()
    got = sorted(((None if r["doc_key"] == (1 << 63) - 1 else r["doc_key"], r["n_lines"], r["n_dropped"], r["kept"])
                  for r in rows), key=lambda r: ((1 << 63) - 1 if r[0] is None else r[0], r[3]))
    want = expected_lines(ROWS, *limits)
    assert got == want and any(r[2] for r in want)
    digests = {r["kept_sha256"] for r in lines.digests(lines.drop_common(docs, *limits)).collect()}
    assert digests == {hashlib.sha256(r[3].encode()).hexdigest() for r in want}


def test_line_stage_keeps_columns(docs):
    got = lines.dedup_stage(docs)
    assert got.columns == docs.columns
    want = {(r[0], r[3]) for r in expected_lines(ROWS, 40, 5)}
    rows = got.collect()
    assert {(r["doc_id"], r["text"] or "") for r in rows} == want
    assert all(r["n_chars"] == len(r["text"] or "") for r in rows)


def test_common_lines_without_python(docs):
    plan = lines.digests(lines.drop_common(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Cartesian" not in plan


def test_empty_tables(empty):
    assert divergence.audit(empty).collect() == []
    assert phrases.collocations(empty).collect() == []
    assert lines.drop_common(empty).collect() == [] and lines.dedup_stage(empty).collect() == []


def test_one_row_tables(spark):
    for text in (None, "", "word"):
        one = spark.createDataFrame([(1, text, None, None)], "doc_id long, text string, lang string, source string")
        assert divergence.audit(one).collect() == [] and phrases.collocations(one).collect() == []
        assert [tuple(r)[:2] for r in lines.digests(lines.drop_common(one)).collect()] == [(1, 1)]
