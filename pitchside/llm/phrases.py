"""Phrase collocations by best-first branch-and-bound growth.

Phrases grow word by word. The count of a phrase bounds the score of all that
it can become: a phrase that starts with ``P`` occurs at most f(P) times, and
cutting off its first word w leaves parts of at least f(w) and its own count,
so its score is at most ``2000000 * f(P) / (f(w) + f(P))``. The same holds for
a last word. Each round takes the ``block`` phrases with the largest bounds
of all that were not grown yet, scans the texts once and counts what stands
before and after them. Then the score that the ``top``-th surviving candidate
of each language has is a floor: a phrase whose bound lies below it is never
grown. The rounds end when none is left at or above the floor, so ties with
the last place are settled too.

Why the growth settles everything: a candidate at or above the floor has
bounds at least as high as its score, so its prefixes were grown (it is
found), its last two words were grown as well (the counts of all its parts are
known), and it was grown itself unless it has ``longest`` words (all longer
phrases around it are known; a longer candidate around it contains one that is
one word longer, which occurs at least as often, so only these are asked).

Scale: tasks send, for each phrase of the frontier and each word beside it, one
row of numbers (the phrase's place in the frontier, the 128-bit hash of
language and word, the count); map-side sums merge them, so a frequent word
pair is one row per task. Words that are too rare are left out by a bitmap of
fixed size (``WORD_BITS``); one that passes it by chance is dropped by its
count. The frontier is a broadcast of at most ``block`` pairs of hashes. Only
phrases at or above the least count are kept, as text.

Defined results: null text is empty, null lang is ``und``; repeated rows count
each time; a language without candidates has no rows; a phrase with a part
that is missing is impossible, as parts occur as often; ties go by phrase; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchside.session import scratch_path

from .arrays import BYTE_BASES, U, WORD_BASES, mix, prefix_hash, range_hash, ranges, slices, text_bytes

NO_LANG = "und"
LEAST_COUNT = 30
LONGEST = 4
TOP = 2000
UNIT = 2_000_000
COVERED = 80  # percent of a phrase's count that a longer one must have to replace it
BLOCK = 1 << 20
PIECE_BYTES = 2 << 20
WORD_BITS = 26  # slots of the bitmap of frequent words, as a power of two

_WORD, _BLANK, _BREAK = 0, 1, 2
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


class Pieces:
    """Words of one batch in runs without a break: hashes, the run of each
    word, and the lower-cased text with one space after every word."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        raw, offsets = text_bytes(batch.column("text"))
        raw = _LOWER[raw]
        kind = _KIND[raw]
        word = kind == _WORD
        cut = np.zeros(len(raw) + 1, dtype=bool)  # a document starts here
        cut[offsets[:-1]] = True
        begin = word.copy()
        begin[1:] &= ~word[:-1] | cut[1:-1]
        last = word.copy()
        last[:-1] &= ~word[1:] | cut[1:-1]
        start, end = np.flatnonzero(begin), np.flatnonzero(last) + 1
        doc = np.searchsorted(offsets, start, side="right") - 1
        self.run = np.cumsum(kind == _BREAK)[start] + doc if len(start) else start
        base = BYTE_BASES[0]
        values = raw.astype(U)
        hashes = [range_hash(prefix_hash(values, one), one, start, end) for one in BYTE_BASES]
        self.prefix = [prefix_hash(h, one) for h, one in zip(hashes, WORD_BASES)]
        self.raw, self.span = raw, (start, end)
        langs = batch.column("lang").dictionary_encode()
        self.langs = langs.dictionary
        self.lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[doc]
        lang_raw, at = text_bytes(self.langs)
        self.lang_hash = range_hash(prefix_hash(lang_raw.astype(U) + U(1), base), base, at[:-1], at[1:])

    def starts(self, words: int) -> np.ndarray:
        """First words of all phrases of so many words."""
        if len(self.run) < words:
            return np.zeros(0, dtype=np.int64)
        return np.flatnonzero(self.run[words - 1:] == self.run[:len(self.run) - words + 1])

    def keys(self, at: np.ndarray, words: int, which: int = 0) -> np.ndarray:
        """Hash of language and phrase."""
        return mix(range_hash(self.prefix[which], WORD_BASES[which], at, at + words) ^ self.lang_hash[self.lang[at]])

    def words(self) -> pa.RecordBatch | None:
        """lang, word and count of all words."""
        start, end = self.span
        if not len(start):
            return None
        order, first, n = _counted(self.keys(np.arange(len(start)), 1), [self.keys(np.arange(len(start)), 1, 1), self.lang])
        one = order[first]
        source, _ = ranges(start[one], end[one] - 1)
        offsets = np.zeros(len(one) + 1, dtype=np.int64)
        np.cumsum(end[one] - start[one], out=offsets[1:])
        word = pa.LargeStringArray.from_buffers(len(one), pa.py_buffer(offsets), pa.py_buffer(self.raw[source]))
        return pa.RecordBatch.from_arrays(
            [self.langs.take(pa.array(self.lang[one])).cast(pa.string()), word.cast(pa.string()),
             pa.array(n, pa.int64())], names=["lang", "phrase", "f"])


def _counted(key: np.ndarray, others: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key, first place of each run of equal rows, and its length.
    Rows that share a key by chance only split a run: sums follow."""
    order = np.argsort(key, kind="stable")
    new = np.zeros(len(key), dtype=bool)
    new[:1] = True
    for own in (key, *others):
        sorted_ = own[order]
        new[1:] |= sorted_[1:] != sorted_[:-1]
    first = np.flatnonzero(new)
    return order, first, np.diff(np.append(first, len(key)))


class Frontier:
    """Hashes of the phrases to grow, by number of words: sorted keys, their
    checks and places, and the bitmap of frequent words."""

    def __init__(self, rows, longest: int, bitmap: np.ndarray) -> None:
        self.bitmap = bitmap
        self.sizes = []
        for n in range(1, longest):
            own = rows[rows["words"] == n]
            key = own["key"].to_numpy().view(U)
            order = np.argsort(key)
            self.sizes.append((key[order], own["check"].to_numpy().view(U)[order], own["place"].to_numpy()[order]))

    def places(self, p: Pieces, size: int) -> np.ndarray:
        """Place of the frontier's phrase that starts at each word, or -1."""
        keys, checks, place = self.sizes[size - 1]
        out = np.full(len(p.run), -1, dtype=np.int64)
        at = p.starts(size)
        found = p.keys(at, size)
        where = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
        hit = np.flatnonzero(keys[where] == found)
        hit = hit[checks[where[hit]] == p.keys(at[hit], size, 1)]
        out[at[hit]] = place[where[hit]]
        return out

    def grow(self, p: Pieces) -> Iterator[pa.RecordBatch]:
        """known (twice the place, one more if the word stands before the
        phrase), word_key, word_check and count."""
        for size, (keys, _, _) in enumerate(self.sizes, 1):
            if not len(keys):
                continue
            place = self.places(p, size)
            longer = p.starts(size + 1)
            after = place[longer] >= 0
            # what is found from its front is not counted again from its end
            before = ~after & (place[longer + 1] >= 0) if size > 1 else np.zeros(len(longer), dtype=bool)
            known = np.concatenate([2 * place[longer[after]], 2 * place[longer[before] + 1] + 1])
            word = np.concatenate([longer[after] + size, longer[before]])
            key = p.keys(word, 1)
            slot = key >> U(64 - WORD_BITS)
            frequent = np.flatnonzero((self.bitmap[(slot >> U(3)).astype(np.int64)] >> (slot & U(7)).astype(np.uint8)) & 1)
            known, word, key = known[frequent], word[frequent], key[frequent]
            check = p.keys(word, 1, 1)
            order, first, n = _counted(mix(known.astype(U) * U(0x9E3779B97F4A7C15) ^ key), [known, key, check])
            one = order[first]
            yield pa.RecordBatch.from_arrays(
                [pa.array(known[one]), pa.array(key[one].view(np.int64)), pa.array(check[one].view(np.int64)),
                 pa.array(n, pa.int64())], names=["known", "word_key", "word_check", "f"])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[Pieces]:
    for batch in batches:
        for part in slices(batch, "text", PIECE_BYTES):
            yield Pieces(part)


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, phrase (one word) and f of all words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in _pieces(batches):
            rows = p.words()
            if rows is not None:
                yield rows
    counts = _texts(docs).mapInArrow(run, "lang string, phrase string, f long")
    return counts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _keyed(phrases: DataFrame) -> DataFrame:
    """Add ``key`` and ``check``, the hashes that the texts' phrases have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            size = batch.column("words").to_numpy()
            p = Pieces(pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("phrase")], names=["lang", "text"]))
            first = np.cumsum(size) - size
            hashes = np.zeros((2, len(size)), dtype=U)
            for n in np.unique(size):
                for which in (0, 1):
                    hashes[which, size == n] = p.keys(first[size == n], int(n), which)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(h.view(np.int64)) for h in hashes)], names=[*batch.schema.names, "key", "check"])
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in phrases.schema)
    return phrases.mapInArrow(run, f"{fields}, key long, check long")


def word_bitmap(words: DataFrame) -> np.ndarray:
    """Bits of the slots that keys of ``words`` fall into: at most
    2^WORD_BITS bits, gathered as bitmaps of 32,768."""
    slot = F.shiftrightunsigned("key", 64 - WORD_BITS)
    rows = (words.select((slot / 32768).cast("long").alias("part"), (slot % 32768).alias("bit"))
            .groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())
    out = np.zeros((1 << WORD_BITS) // 8, dtype=np.uint8)
    for r in rows:
        out[4096 * r["part"]:4096 * (r["part"] + 1)] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def grown(docs: DataFrame, chosen: DataFrame, words: DataFrame, bitmap: np.ndarray, least: int, longest: int) -> DataFrame:
    """lang, phrase, words and f of all phrases with a word more than one of
    ``chosen`` (lang, phrase, words, key, check, place), before or after it."""
    rows = chosen.select("words", "key", "check", "place").toPandas()  # at most a block
    frontier = docs.sparkSession.sparkContext.broadcast(Frontier(rows, longest, bitmap))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in _pieces(batches):
            yield from frontier.value.grow(p)

    counts = (_texts(docs).mapInArrow(run, "known long, word_key long, word_check long, f long")
              .groupBy("known", "word_key", "word_check").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
              .withColumn("place", F.shiftright("known", 1)))
    named = counts.join(chosen.select("place", "lang", F.col("phrase").alias("inner"), "words"), "place").join(
        words.select("lang", F.col("phrase").alias("word"), F.col("key").alias("word_key"), F.col("check").alias("word_check")),
        ["lang", "word_key", "word_check"])
    phrase = F.when(F.col("known") % 2 == 0, F.concat_ws(" ", "inner", "word")).otherwise(F.concat_ws(" ", "word", "inner"))
    return named.select("lang", phrase.alias("phrase"), (F.col("words") + 1).alias("words"), "f")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _part(first: Column, n: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, n), " ")


def score(a: Column, parts: Column) -> Column:
    """floor(UNIT * a / parts) without overflow."""
    top = a.cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(7,0)")
    bottom = parts.cast("decimal(20,0)")
    return ((top - top % bottom) / bottom).cast("long")


def bounds(phrases: DataFrame, known: DataFrame) -> DataFrame:
    """Add ``bound``: no phrase that starts with it (or, for two words, ends
    with it) scores more."""
    single = known.filter("words = 1").select("lang", F.col("phrase").alias("word"), F.col("f").alias("word_f"))
    ends = F.when(F.col("words") == 2, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = phrases.withColumn("end", F.explode(ends)).withColumn("word", F.get(F.split("phrase", " "), F.col("end") - 1))
    return (rows.join(single, ["lang", "word"]).groupBy("lang", "phrase", "words", "f")
            .agg(F.max(score(F.col("f"), F.col("word_f") + F.col("f"))).alias("bound")))


def scored(known: DataFrame, longest: int = LONGEST) -> DataFrame:
    """lang, phrase, words, a, l, r, score of all phrases of two words or
    more whose parts are all known."""
    cuts = (known.filter("words > 1").withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
            .select("lang", "phrase", "words", F.col("f").alias("a"), "k",
                    _part(F.lit(1), F.col("k")).alias("left"),
                    _part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right")))
    part = lambda name, f: known.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    lowest = cuts.groupBy("lang", "phrase", "words", "a").agg(
        F.count(F.lit(1)).alias("cuts"),
        F.min(F.struct(score(F.col("a"), F.col("l") + F.col("r")).alias("score"), "k", "l", "r")).alias("low"))
    return lowest.filter("cuts = words - 1").select("lang", "phrase", "words", "a", "low.l", "low.r", "low.score")


def survivors(known: DataFrame, done: DataFrame, longest: int = LONGEST, covered: int = COVERED) -> DataFrame:
    """The scored phrases that were grown, or have ``longest`` words, and
    that no longer phrase replaces."""
    around = (known.filter("words > 2").withColumn("inner", F.explode(F.array(
        _part(F.lit(1), F.col("words") - 1), _part(F.lit(2), F.col("words") - 1))))
        .groupBy("lang", F.col("inner").alias("phrase")).agg(F.max("f").alias("longer")))
    rows = scored(known, longest).join(done.select("lang", "phrase", F.lit(True).alias("grown")), ["lang", "phrase"], "left")
    rows = rows.filter((F.col("words") == longest) | F.col("grown")).join(around, ["lang", "phrase"], "left")
    replaced = 100 * F.col("longer") >= covered * F.col("a")
    return rows.filter(~F.coalesce(replaced, F.lit(False))).drop("grown", "longer")


def ranked(rows: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def collocations(docs: DataFrame, least: int = LEAST_COUNT, longest: int = LONGEST, top: int = TOP,
                 covered: int = COVERED, block: int = BLOCK) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases."""
    everything = _stored(word_counts(docs), "phrases-words")
    sizes = everything.groupBy("lang").agg(F.sum("f").alias("n"))
    words = _stored(_keyed(everything.filter(F.col("f") >= least).withColumn("words", F.lit(1))), "phrases-frequent")
    bitmap = word_bitmap(words)
    known = words.select("lang", "phrase", "words", "f")
    done = known.limit(0).select("lang", "phrase")
    best, at = None, 0
    while True:
        left = known.filter(F.col("words") < longest).join(done, ["lang", "phrase"], "left_anti")
        single = left.filter("words = 1").withColumn("bound", F.lit(UNIT // 2).cast("long"))
        left = single.unionByName(bounds(left.filter("words > 1"), known))
        if best is not None:
            floor = best.filter(F.col("rank") == top).select("lang", F.col("score").alias("floor"))
            left = left.join(floor, "lang", "left").filter(F.col("bound") >= F.coalesce("floor", F.lit(0))).drop("floor")
        # words first: their counts bound everything that follows
        chosen = left.orderBy(F.desc(F.col("words") == 1), F.desc("bound"), "lang", "phrase").limit(block)
        # of phrases that share a 64-bit key by chance one waits for the next round
        chosen = _keyed(chosen.select("lang", "phrase", "words")).dropDuplicates(["words", "key"])
        chosen = chosen.withColumn("place", F.row_number().over(Window.orderBy("words", "key")) - 1)
        chosen = _stored(chosen, f"phrases-block-{at}")
        if not chosen.head(1):
            break
        found = _stored(grown(docs, chosen, words, bitmap, least, longest), f"phrases-grown-{at}")
        done = _stored(done.unionByName(chosen.select("lang", "phrase")), f"phrases-done-{at}")
        known = _stored(known.unionByName(found).distinct(), f"phrases-known-{at}")
        if not chosen.filter("words = 1").head(1):
            best = _stored(ranked(survivors(known, done, longest, covered), top), f"phrases-best-{at}")
        at += 1
    if best is None:
        best = ranked(survivors(known, done, longest, covered), top)
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("int").alias("rank"), "phrase",
                                           "a", "l", "r", "n", "score")
