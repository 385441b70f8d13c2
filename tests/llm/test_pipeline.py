"""The pipeline stage by stage, by value, against plain Python, and the
quality verdict with its divergences."""

import collections
import math
import re
import unicodedata
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from pitchside.llm import packing, quality
from pitchside.llm.queries import ORACLES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"
RNG = np.random.default_rng(21)
LAST = 1 << 63


def vocabulary(lang, n=400):
    return ["".join(RNG.choice(list("abcdefghijklmnoprstuvz"), int(RNG.integers(3, 9)))) + lang for _ in range(n)]


VOCAB = {lang: vocabulary(lang) for lang in ("en", "de", "pl")}
COMMON = {"en": quality.COMMON_WORDS["en"], "de": quality.COMMON_WORDS["de"], "pl": ["nie", "jest", "oraz", "ale"]}


def prose(lang, n):
    words = [str(RNG.choice(COMMON[lang] if RNG.random() < 0.4 else VOCAB[lang])) for _ in range(n)]
    return " ".join(w + (".\n" if RNG.random() < 0.08 else "") for w in words)


PASSAGE = prose("en", 60)
ROWS = []
for k in range(90):
    lang = ["en", "de", "pl"][k % 3]
    text = prose(lang, int(RNG.integers(30, 200)))
    if k % 9 == 0:
        text = text[:200] + "\n" + PASSAGE + "\n" + text[200:]
    ROWS.append((k, text, lang, f"{['web', 'book'][k % 2]}{k % 4}", len(text), "x"))
ROWS += [(100, ROWS[3][1], "en", "web1", 1, "copy"), (101, ROWS[3][1] + " tail", "en", "web1", 1, "near")]
ROWS += [(102, None, "en", "web1", None, None), (103, "", None, None, 0, None), (104, "###$$$ %%% " * 30, "en", "web0", 330, "junk"),
         (105, " ".join("".join(RNG.choice(list("0123456789#*"), 9)) for _ in range(80)), "en", "web0", 1, "digits"),
         (106, "same line here\nother\nsame line here\n" + prose("en", 80), "en", "web2", 9, "lines"),
         (107, prose("en", 12_000), "en", "book1", 1, "long"), (None, prose("de", 80), "de", "book1", 1, "no id")]
ROWS += [ROWS[5], ROWS[5]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def key(row):
    return LAST if row[0] is None else row[0]


# -- quality --------------------------------------------------------------------

def classes(solid):
    lower = [c for c in solid if unicodedata.category(c) == "Ll"]
    rest = [c for c in solid if unicodedata.category(c) != "Ll"]
    upper = sum(unicodedata.category(c) == "Lu" for c in rest)
    digit = sum(unicodedata.category(c).startswith("N") for c in rest)
    mark = sum(c in ".,;:?'\"()-" for c in rest)
    return [len(lower), upper, digit, mark, len(rest) - upper - digit - mark]


def bare(word):
    return word.lower().rstrip(".,;:!?")


def divergence(p, q):
    p, q = np.array(p, float), np.array(q, float)
    if not p.sum() or not q.sum():
        return None
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    half = lambda x: sum(0.5 * a * math.log2(a / b) for a, b in zip(x, m) if a > 0)
    return half(p) + half(q)


def verdicts(rows):
    words = [WORDS.findall(r[1] or "") for r in rows]
    langs = [r[2] or "" for r in rows]
    common = dict(quality.COMMON_WORDS)
    for lang in set(langs) - set(common):
        seen = collections.Counter(b for w, own in zip(words, langs) if own == lang for x in w if (b := bare(x)))
        common[lang] = [w for w, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:quality.N_COMMON]]
    solids = ["".join(w) for w in words]

    def counts(w, names):
        seen = collections.Counter(bare(x) for x in w)
        hits = [seen[c] for c in names]
        return [*hits, len(w) - sum(hits)]

    chars = [classes(s) for s in solids]
    commons = [counts(w, common[lang]) for w, lang in zip(words, langs)]
    sums = lambda hist, lang: [sum(x) for x in zip(*[h for h, own in zip(hist, langs) if own == lang])]
    out = []
    for r, w, lang, solid, c, m in zip(rows, words, langs, solids, chars, commons):
        full = [x for x in (r[1] or "").split("\n") if WORDS.search(x)]
        five = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        cover = {j for i in range(len(w) - 4) if five[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
        failed = len(w) < 10 or 100 * len(cover) > 20 * len(w)
        by_class, by_word = divergence(c, sums(chars, lang)), divergence(m, sums(commons, lang))
        far = (len(w) >= 10 and (by_class or 0) > 0.03 + 3 / len(w)
               or len(w) >= 60 and common[lang] and (by_word or 0) > 0.02 + 5 / len(w))
        out.append((r[0], len(w), len(solid), sum(x in "#*$%&|<>" for x in solid), len(full) - len(set(full)), len(cover),
                    failed, by_class, by_word, not failed and not far))
    return out


def test_quality_verdicts(docs):
    got = sorted(rows_of(quality.judge(docs)), key=lambda r: (key(r), r[1]))
    want = sorted(verdicts(ROWS), key=lambda r: (key(r), r[1]))
    for g, w in zip(got, want, strict=True):
        assert (g[:7], g[9]) == (w[:7], w[9])
        for a, b in zip(g[7:9], w[7:9]):
            assert a == b or a == pytest.approx(b, abs=1e-9)
    kept = {w[0] for w in want if w[9]}
    assert {0, 1, 2, 106} <= kept and not kept & {102, 103, 104, 105}


# -- the stages ------------------------------------------------------------------

@pytest.fixture(scope="module")
def stages(spark, docs, tmp_path_factory):
    """The run's result and the input and output rows of every stage."""
    folder = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{folder}/documents.parquet")
    seen = {}
    rows = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, folder).checkpoint()
        seen[name] = (rows, out)
        rows = out
    return corpus_pipeline.run(spark, folder), seen


def test_stage_names_and_columns(docs, stages):
    _, seen = stages
    assert list(seen) == ["quality rules", "n-gram Jaccard join", "substring dedup", "mixing", "packing"]
    assert all(out.columns == docs.columns for _, out in list(seen.values())[:-1])


def test_quality_stage(stages):
    before, after = stages[1]["quality rules"]
    rows = rows_of(before)
    kept = {id(r) for r, v in zip(rows, verdicts(rows)) if v[9]}
    want = collections.Counter(r for r in rows if id(r) in kept)
    assert collections.Counter(rows_of(after)) == want


def test_jaccard_stage(stages):
    before, after = stages[1]["n-gram Jaccard join"]
    rows = sorted(set(rows_of(before)), key=lambda r: (key(r), str(r)))
    sets = []
    for r in rows:
        w = WORDS.findall(r[1] or "")
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))})
    label = list(range(len(rows)))
    changed = True
    links = [(i, j) for i in range(len(rows)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    want = sorted((rows[k] for k in sorted(set(label))), key=lambda r: (key(r), str(r)))
    assert sorted(rows_of(after), key=lambda r: (key(r), str(r))) == want
    assert links and len(want) < len(rows)


def test_substring_stage(stages):
    before, after = stages[1]["substring dedup"]
    seen, want = set(), []
    for r in sorted(rows_of(before), key=key):
        w = WORDS.findall(r[1] or "")
        gone = set()
        for i in range(len(w) - 19):
            if tuple(w[i:i + 20]) in seen:
                gone.update(range(i, i + 20))
            seen.add(tuple(w[i:i + 20]))
        text = " ".join(x for i, x in enumerate(w) if i not in gone) if gone else r[1]
        if not gone or text:
            want.append((r[0], text, *r[2:4], len(text) if gone else r[4], r[5]))
    got = sorted(rows_of(after), key=key)
    assert got == want and any(a[1] != b[1] for a, b in zip(got, sorted(rows_of(before), key=key)))


def test_mixing_stage(stages):
    before, after = stages[1]["mixing"]
    con = duckdb.connect()
    con.register("documents", before.toArrow())
    drawn = con.execute(ORACLES["op3_mixing"].replace("*[0-9]?')", "*')")).fetchall()  # the stage's domains
    names = [d[0] for d in con.description]
    by_id = {r[0]: r for r in rows_of(before)}
    want = []
    for row in drawn:
        d = dict(zip(names, row))
        r = by_id[d["doc_id"]]
        cut = d["taken"] < d["tokens"]
        text = " ".join(WORDS.findall(r[1])[:d["taken"]]) if cut else r[1]
        want.append((r[0], text, *r[2:4], len(text) if cut else r[4], r[5]))
    assert collections.Counter(rows_of(after)) == collections.Counter(want)


def test_packing_stage_and_run(stages):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    before, _ = stages[1]["packing"]
    want = collections.Counter()
    for r in rows_of(before):
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1]
        start = 0
        for n in packing.cuts(len(ids), packing.MAX_TOKENS):
            piece = ids[start:start + n]
            want[r[0], start, n, zlib.crc32(np.array(piece, "<u4").tobytes()), len(ids), tuple(piece)] += 1
            start += n
    for result in (stages[1]["packing"][1], stages[0]):
        rows = result.collect()
        got = collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"], tuple(r["input_ids"])) for r in rows)
        assert got == want
        assert len({r["sequence_id"] for r in rows}) == len(rows) and {r["offset"] for r in rows} == {0}


def test_empty_run(spark, docs, tmp_path):
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
