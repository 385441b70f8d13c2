"""Operators on edge cases and against plain-Python versions."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pitchside.llm import html, jaccard, licenses, mixing, packing, quality, substring, suffix, syncmers, urls

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
RNG = np.random.default_rng(3)
VOCAB = [f"w{n}é" for n in range(60)]


def prose(n):
    return " ".join(RNG.choice(VOCAB, n))


SHARED, BASE = prose(40), prose(120)
ROWS = [(1, BASE, "en", "a1"), (2, BASE, "en", "a1"), (3, prose(30) + "\n" + SHARED + "\n" + prose(30), "de", "a2"),
        (4, SHARED + "  " + prose(25), "fr", "b1"), (5, None, None, None), (6, "", "en", "b1"), (7, "one", "en", "b1"),
        (8, BASE + " tail of it", "en", "a1"), (9, "x " * 300, "es", "c"), (10, prose(2000), "en", "a1"),
        (12, SHARED, "xx", None), (13, "\x00 nul\x1c sep", "en", "a1"), (None, prose(50), "en", "a1")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([r + (len(r[1] or ""), "extra") for r in ROWS],
                                 "doc_id long, text string, lang string, source string, n_chars long, h string")


def order(row):
    return row[0] if row[0] is not None else 1 << 63


def test_word_windows(docs):
    seen, expected = set(), {}
    for doc_id, text, *_ in sorted(ROWS, key=order):
        w = WORDS.findall(text or "")
        gone = set()
        for i in range(len(w) - 19):
            if tuple(w[i:i + 20]) in seen:
                gone.update(range(i, i + 20))
            seen.add(tuple(w[i:i + 20]))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        expected[doc_id] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    for base in (10, 5):
        got = {r[0]: tuple(r)[1:] for r in substring.digests(substring.remove_repeated(docs, 20, base)).collect()}
        assert got == expected


def test_byte_strings(docs):
    texts = {r[0]: (r[1] or "").encode() for r in ROWS}
    count = collections.Counter(t[i:i + 200] for t in texts.values() for i in range(len(t) - 199))
    expected = {}
    for k, t in texts.items():
        gone = bytearray(len(t))
        for i in range(len(t) - 199):
            if count[t[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(t, gone) if not g)
        expected[k] = (len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    for split in (4096, 1):
        got = {r[0]: tuple(r)[1:] for r in suffix.digests(suffix.remove_repeated(docs, split=split)).collect()}
        assert got == expected


def test_suffix_array_and_common_prefixes():
    for n in (1, 2, 7, 60, 200):
        raw = RNG.integers(97, 99, n).astype(np.uint8)
        t = raw.tobytes()
        order_, first = suffix.suffix_array(raw)
        assert order_.tolist() == sorted(range(n), key=lambda i: t[i:])
        lcp = suffix.common_prefixes(raw, first, order_, np.array([0]), np.array([n]), 20)
        for i in range(1, n):
            a, b = t[order_[i]:order_[i] + 20], t[order_[i - 1]:order_[i - 1] + 20]
            same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert lcp[i] == same


def test_near_duplicates(docs):
    sets = {}
    for k, t, *_ in ROWS:
        w = WORDS.findall(t or "")
        sets[k] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    near = {k: [j for j in sets if j != k and sets[k] and 5 * len(sets[k] & sets[j]) >= 4 * len(sets[k] | sets[j])]
            for k in sets}
    for options in ({}, {"block": 1}):
        got = {r["doc_id"]: r for r in jaccard.classes(docs, **options).collect()}
        assert len(got) == len(ROWS)
        for k in sets:
            if sets[k]:
                assert got[k]["n_links"] == len(near[k])
                assert got[k]["class_id"] == min([k, *near[k]], key=lambda x: 1 << 63 if x is None else x)


def test_band_choice_reaches_recall():
    bands, rows = jaccard.choose_bands(0.8, 0.9999, 128)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.9999 and bands * rows <= 128


def test_quality_counts_and_guards(docs):
    got = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    for k, t, *_ in ROWS:
        w = WORDS.findall(t or "")
        c = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        cover = {j for i in range(len(w) - 4) if c[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
        assert (got[k]["n_words"], got[k]["word_chars"], got[k]["n_repeat_words"]) == (len(w), sum(map(len, w)), len(cover))
        assert got[k]["base_failed"] == (len(w) < 10 or 100 * len(cover) > 20 * len(w))
        assert not (got[k]["base_failed"] and got[k]["kept"])


def test_quality_of_further_languages(spark):
    rng = np.random.default_rng(5)
    rare = lambda n: ["".join(rng.choice(list("abcdefgh"), 7)) for _ in range(n)]
    clean = lambda common: " ".join(rng.permutation(list(rng.choice(common, 60)) + rare(60)))
    rows = [(n, clean(["nie", "jest", "oraz", "ale"]), "pl") for n in range(40)]
    rows += [(100 + n, " ".join("".join(chr(0x4E00 + c) for c in rng.integers(0, 200, 3)) for _ in range(120)), "zh") for n in range(3)]
    rows += [(200, " ".join(rare(120)), "pl")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in quality.judge(docs).filter("kept").collect()}
    assert kept == {*range(40), 100, 101, 102}


def test_packing_round_trip(docs):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    pieces = collections.defaultdict(list)
    for r in packing.pack(docs, max_tokens=64).collect():
        assert zlib.crc32(np.array(r["input_ids"], "<u4").tobytes()) == r["ids_crc32"]
        assert r["length"] == len(r["input_ids"]) and r["length"] & (r["length"] - 1) == 0
        pieces[r["doc_id"]].append(r)
    for k, t, *_ in ROWS:
        mine = sorted(pieces[k], key=lambda r: r["start"])
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        assert [i for r in mine for i in r["input_ids"]] == ids
    ids = [r["sequence_id"] for v in pieces.values() for r in v]
    assert len(ids) == len(set(ids))


def test_fingerprints(docs):
    got = {r["doc_id"]: r for r in syncmers.fingerprints(docs).collect()}
    ring = sorted(ROWS, key=lambda r: -1 if r[0] is None else r[0], reverse=True)
    for (k, t, *_), (_, after, *_) in zip(ring, ring[1:] + ring[:1]):
        n = len(t or "")
        edited = (t or "")[:n - n // 3] + (after or "")[:n // 3]
        assert (got[k]["n_chars"], got[k]["edited_sha256"]) == (n, hashlib.sha256(edited.encode()).hexdigest())
    assert got[1]["fingerprint"] == got[2]["fingerprint"] and got[2]["near_next"] == 1.0
    assert got[10]["near_edited"] > 0.3 > got[10]["near_next"]


def test_url_rules(spark):
    cases = {None: ("", "", None), "no scheme": ("", "", None), "http://A.COM": ("a.com", "", None),
             "http://a.com/x?y": ("a.com", "/x", "com/"), "x://example.com/en/1": ("example.com", "/en/1", "example.com/en/"),
             "x://m.example.com/en/1#t": ("m.example.com", "/en/1", "example.com/en/"),
             "x://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/"),
             "x://notexample.com/en/": ("notexample.com", "/en/", "com/"), "x://a.net/fr/2": ("a.net", "/fr/2", "net/fr/"),
             "x://a.net/en/2": ("a.net", "/en/2", None), "x://m.casino-win.example.net/en/2": ("m.casino-win.example.net", "/en/2", None)}
    pages = spark.createDataFrame([(n, u) for n, u in enumerate(cases)], "page_id long, url string")
    got = {r["page_id"]: r for r in urls.judge(pages).collect()}
    for n, (host, path, rule) in enumerate(cases.values()):
        assert (got[n]["host"], got[n]["path"], got[n]["rule"]) == (host, path, rule)
    assert got[9]["verdict"] == "allow" and got[10]["verdict"] == "block"


def test_html_regions():
    page = ("<body><header>Site</header><div class='cookie-notice'>We use cookies</div><article><h1>T</h1><p>A &amp; b<br>c"
            "<p>D<script>x</script></article><section id=comments><p>First!</p></section><footer>&copy;</footer>")
    assert html.main_text(page) == "T\n\nA & b c\n\nD"
    assert html.main_text(None) == "" and html.main_text("<![if x]><p>a") in ("a", "")
    plain = "<div><a href=x>Home</a></div><div><p>" + "long text " * 20 + "</p></div>"
    assert html.main_text(plain) == ("long text " * 20).strip()


def test_html_article_does_not_decide():
    story = "<p>" + "some long text " * 20 + "</p>"
    links = "<ul class=zz>" + "".join(f"<li><a href=/{n}>Other story {n}</a></li>" for n in range(5)) + "</ul>"
    kept = ("some long text " * 20).strip()
    assert html.main_text(f"<article>{story}{links}</article>") == kept
    assert html.main_text(f"<article><h1><a href=/>Top</a></h1>{story}</article>") == f"Top\n\n{kept}"
    assert kept in html.main_text(f"<article><h2>More</h2><p>Short teaser text.</p></article><div>{story * 3}</div>")


STORY = "".join(f"<p>{'A long paragraph of the article with many words in it. ' * 4}</p>" for _ in range(6))
STORY_TEXT = "\n\n".join([("A long paragraph of the article with many words in it. " * 4).strip()] * 6)
COMMENTS = f"<section class=comments><p>{'I disagree with all of this. ' * 40}</p></section>"


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title><body><article>{STORY}</article>",
    f"<head><title>T</title><div><nav><a href=x>Home</a></nav>{STORY}</div>",
    f"<body><a name=top><article>{STORY}</article>",
    f"<body><a href=#top>Top<article>{STORY}</article>",
    f"<div class='content with-sidebar'>{STORY}</div><div class='left-sidebar'><p>{'other side words ' * 10}</p></div>",
    f"<article class='post category-promo'>{STORY}</article><div class='cookie-notice'>{STORY}</div>",
    f"<article class='post comment-open'>{STORY}</article>{COMMENTS}",
    f"<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul><article>{STORY}</article><footer>Foot notes</footer>",
    f"<form action=x><nav><a href=/a>Home</a></nav><article>{STORY}</article>{COMMENTS}<footer>Foot</footer></form>",
    f"<article>{STORY}</article><footer><p>{'Notes at the foot of the page. ' * 20}</p></footer>",
    f"<article>{STORY}"])
def test_html_keeps_the_article(page):
    assert html.main_text(page) == STORY_TEXT


def test_html_short_story_beside_long_other_text():
    for other in (COMMENTS, f"<footer>{'All rights are reserved here. ' * 30}</footer>", f"<div id=cookie-banner>{'We use cookies. ' * 60}</div>",
                  f"<nav>{STORY}</nav>"):
        assert html.main_text(f"<article><h1>T</h1><p>Short.</p></article>{other}") == "T\n\nShort."
    long = "word " * 300_000
    assert html.main_text(f"<p>{long}</p>") == long.strip() and html.main_text("<" * 5000) is not None


def test_licences_and_inheritance(spark):
    files = spark.createDataFrame([
        ("p/LICENSE", "Released under the MIT License."), ("p/src/a.py", "x = 1"), ("p/src/b.py", "# Licensed under the Apache License, Version 2.0."),
        ("q/a.py", None), (None, "y"), ("COPYING.txt/x", "z")], "path string, body string")
    got = {r["path"]: (r["licence"], r["origin"]) for r in licenses.scan(files, F.col("path"), F.col("body")).collect()}
    assert got["p/LICENSE"] == ("MIT", "own") and got["p/src/a.py"] == ("MIT", "inherited")
    assert got["p/src/b.py"] == ("Apache-2.0", "own")
    assert got["q/a.py"] == (None, "none") and got[None] == (None, "none")


def test_licences_wrapped_and_whole(spark):
    code = "\n\n" + "\n".join(f"value_{n} = compute(value_{n - 1}, other)" for n in range(60))
    mpl = ("// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy of the "
           "MPL was not distributed with this\n// file, You can obtain one at https://mozilla.org/MPL/2.0/.")
    gpl = ("# helper\n# This program is free software; you can redistribute it and/or modify\n# it under the terms of the GNU "
           "General Public License as published by\n# the Free Software Foundation; either version 2 of the License, or\n"
           "# (at your option) any later version.")
    isc = dict(licenses.TEMPLATES[:13])["ISC"]
    mit = [t for name, t in licenses.TEMPLATES if name == "MIT"][-1]
    files = spark.createDataFrame([("a/x.js", mpl + code), ("b/x.py", gpl + code), ("c/x.c", isc),
                                   ("d/LICENSE", "MIT License\n\nCopyright (c) 2020 A. Person\n\n" + mit), ("d/y.py", "y = 1"),
                                   ("e/z.py", code), ("f/GPL", dict(licenses.TEMPLATES[-7:])["GPL-2.0"])], "path string, body string")
    got = {r["path"]: r["licence"] for r in licenses.scan(files, F.col("path"), F.col("body")).collect()}
    assert got == {"a/x.js": "MPL-2.0", "b/x.py": "GPL-2.0", "c/x.c": "ISC", "d/LICENSE": "MIT", "d/y.py": "MIT",
                   "e/z.py": None, "f/GPL": "GPL-2.0"}


def test_mix_shares_shortage_among_siblings(spark):
    rows = [(n, "w " * 10, "en", "a" if n < 90 else "b", 20) for n in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    taken = {r["source"]: r["t"] for r in mixing.mix(docs, total=800, max_epochs=2).groupBy("source").agg(
        F.sum("taken").alias("t")).collect()}
    assert taken == {"a": 600, "b": 200}
    assert mixing.mix_stage(docs, total=15).count() == 2 and mixing.mix_stage(docs, total=15).columns == docs.columns


def test_mix_weights_of_domains_and_sources(spark):
    rows = [(n, "w " * 10, "en", ["web1", "web2", "book1"][n % 3], 20) for n in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    options = {"total": 800, "domain_weights": {"book": 3}, "source_weights": {"web1": 4}}
    taken = {r["source"]: r["t"] for r in mixing.mix(docs, **options).groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    assert taken == {"book1": 600, "web1": 160, "web2": 40}
    by_digit = mixing.mix_stage(docs, **options, domain=F.regexp_extract("source", "[0-9]", 0))
    assert by_digit.count() == 80


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    for make in (substring.remove_repeated, suffix.remove_repeated, jaccard.classes, quality.judge, packing.pack,
                 syncmers.fingerprints, mixing.mix, licenses.scan_documents, quality.keep, jaccard.keep_one,
                 substring.dedup_stage, mixing.mix_stage):
        assert make(none).count() == 0


def test_repeated_rows_and_stage_columns(spark, docs):
    twice = docs.unionByName(docs)
    assert substring.remove_repeated(twice).count() == 2 * len(ROWS)
    assert jaccard.keep_one(twice).columns == docs.columns
    assert jaccard.keep_one(twice).filter("doc_id = 10").count() == 1
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, twice, "").columns == docs.columns


def test_clashing_columns_of_files_and_pages(spark):
    files = spark.createDataFrame([("p/LICENSE", "Released under the MIT License.", "u", 1, "own", "k"), ("p/a.py", "", "u", 2, "x", "k")],
                                  "path string, body string, Licence string, whole int, origin string, keep string")
    got = {r["path"]: r for r in licenses.scan(files, F.col("path"), F.col("body")).collect()}
    assert got["p/a.py"]["licence"] == "MIT" and got["p/a.py"]["origin"] == "inherited" and got["p/a.py"]["keep"] == "k"
    pages = spark.createDataFrame([(1, "x://a.com/b", "<p>A", "t", "h", 7), (2, None, None, None, None, None), (2, None, None, None, None, None)],
                                  "page_id long, url string, html string, text string, host string, n_chars long")
    for make in (html.extract, urls.judge):
        assert make(pages).count() == 3 and make(pages.limit(0)).count() == 0
    got = html.extract(pages).orderBy("page_id").collect()
    assert [(r["text"], r["n_chars"]) for r in got] == [("A", 1), ("", 0), ("", 0)]


def test_common_words_in_one_search(spark):
    common = ["the", "a", "a.b", "(a)", "c++", "$1", "\\x", "[", "a|b", "é–", "*"]
    texts = ["", " \t", "the", " the!! of... ,,, ; the?x THE", "\n\t The,\r\n\x0b of the, .", "a a a. a", "the\x0cthe ",
             "(a) (A)! c++ C++, $1 \\x \\X a.b. a.b [; a|b É–. é– * **", "a" + "." * 100_000 + "x the. "]
    bare = lambda w: w.lower().rstrip(".,;:!?")
    rows = quality._with_text(spark.createDataFrame([(t, "en") for t in texts], "text string, lang string"))
    names = F.array(*[F.lit(c) for c in common])
    got = rows.select("text", quality.common_counts(F.col("__text"), F.col("__words"), names).alias("n")).collect()
    for text, found in got:
        words = [bare(w) for w in WORDS.findall(text)]
        hits = [words.count(c) for c in common]
        assert found == [*hits, len(words) - sum(hits)]


def test_substring_tasks_return_memory(monkeypatch):
    calls = []
    monkeypatch.setattr(substring, "give_back", lambda: calls.append(1))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([7]), pa.array(["w " * 30])], names=["doc_key", "text_tag", "text"])
    rows = list(substring._part_rows(iter([batch]), 20, 10, 10, []))
    assert sum(r.num_rows for r in rows) > 0 and calls == [1]
