"""Removal of repeated word passages by level-wise doubling.

A passage is a window of ``window`` words. Windows are tested at ``base``
words first, then at twice that length, and so on up to ``window``; only
windows whose shorter part was found more than once are looked at again,
and the search ends when none survives.

Each level below ``window`` tests one part per run of windows: the part
with the smallest hash inside the window (equal windows choose equal
parts), which leaves about 2 / (window - part + 2) of all positions to
shuffle. A part found once settles its whole run, so every level returns
only the parts found *once*, taken from the aggregate itself
(``count = 1``); no hot key is ever joined back or gathered.

At the last level, runs of surviving windows with equal text collapse
first: only the earliest copy of a run compares its windows one by one,
since every window of a later copy has an earlier equal by construction.

Defined results: null text has no words; a document shorter than the window
loses nothing; for null ids and repeated rows see ``keys``; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import WORD_BASES, Words, give_back, owned_runs, prefix_hash, range_hash, ranges, slices
from .keys import KEY, by_document, doc_id_of, key_columns, keyed, with_arrays

WINDOW = 20
BASE = 10


def levels_of(window: int, base: int) -> list[int]:
    """Lengths below ``window``: base, 2 * base, ..."""
    out = []
    while base < window:
        out.append(base)
        base *= 2
    return out


class _Slice:
    """One piece of a batch with the runs that survive the earlier levels."""

    def __init__(self, piece: pa.RecordBatch, window: int, base: int) -> None:
        self.window, self.base = window, base
        self.key = piece.column("doc_key").to_numpy(zero_copy_only=False)
        self.tag = piece.column("text_tag").to_numpy(zero_copy_only=False)
        self.words = Words(piece.column("text"))
        self.prefix = prefix_hash(self.words.hashes(), WORD_BASES[0])
        size = np.maximum(self.words.count - window + 1, 0)
        first = self.words.first[:-1]
        self.alive = np.zeros(len(self.words.start) + 1, dtype=bool)
        at, _ = ranges(first[size > 0], (first + size - 1)[size > 0])
        self.alive[at] = True

    def hash(self, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
        if which:
            if not hasattr(self, "second"):
                self.second = prefix_hash(self.words.hashes(1), WORD_BASES[1])
            return range_hash(self.second, WORD_BASES[1], start, end)
        return range_hash(self.prefix, WORD_BASES[0], start, end)

    def runs(self, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Runs of one anchor each that hold a surviving window."""
        at = np.arange(max(0, len(self.words.start) - part + 1))
        doc, anchor, lo, hi = owned_runs(self.hash(at, at + part), self.words.first, self.window, part)
        if len(lo):
            live = np.add.reduceat(self.alive, lo).astype(bool)
            doc, anchor, lo, hi = doc[live], anchor[live], lo[live], hi[live]
        return doc, anchor, lo, hi

    def places(self, doc: np.ndarray, word: np.ndarray) -> np.ndarray:
        return (self.tag[doc] << 32) | (word - self.words.first[doc])

    def named(self, column: pa.Array) -> np.ndarray:
        """Word indices named by a per-document array of word positions."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        lists = column.fill_null([])
        owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
        return self.words.first[owner] + lists.flatten().to_numpy(zero_copy_only=False)

    def settle(self, piece: pa.RecordBatch, parts: list[int]) -> None:
        """Drop the windows whose part was found once at an earlier level."""
        for part in parts:
            _, _, lo, hi = self.runs(part)
            mark = np.zeros(len(self.alive), dtype=bool)
            mark[self.named(piece.column(f"once{part}"))] = True
            gone = mark[lo]
            at, _ = ranges(lo[gone], hi[gone])
            self.alive[at] = False

    def surviving(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, first and last start of each stretch of surviving
        windows, cut where the anchor of the longest level changes."""
        flags = self.alive[:-1]
        doc = np.repeat(np.arange(len(self.key)), self.words.count)
        begin = flags.copy()
        begin[1:] &= ~flags[:-1] | (doc[1:] != doc[:-1])
        parts = levels_of(self.window, self.base)
        if parts:
            _, _, lo, _ = self.runs(parts[-1])
            cut = np.zeros(len(flags), dtype=bool)
            cut[lo] = True
            begin |= cut & flags
        lo = np.flatnonzero(begin)
        last = flags.copy()
        last[:-1] &= ~flags[1:] | begin[1:]
        return doc[lo], lo, np.flatnonzero(last)


def _open(batches: Iterator[pa.RecordBatch], window: int, base: int, parts: list[int]):
    for batch in batches:
        for piece in slices(batch, "text", 1 << 20):
            s = _Slice(piece, window, base)
            s.settle(piece, parts)
            yield piece, s
            del s
    give_back()


def _part_rows(batches, window, base, part, before):
    for _, s in _open(batches, window, base, before):
        doc, anchor, lo, _ = s.runs(part)
        yield pa.RecordBatch.from_arrays(
            [pa.array(s.hash(anchor, anchor + part).view(np.int64)), pa.array(s.key[doc]),
             pa.array(s.places(doc, lo))], names=["h", "doc_key", "place"])


def _stretch_rows(batches, window, base):
    for _, s in _open(batches, window, base, levels_of(window, base)):
        doc, lo, hi = s.surviving()
        end = hi + window
        yield pa.RecordBatch.from_arrays(
            [pa.array(s.hash(lo, end).view(np.int64)), pa.array(s.hash(lo, end, 1).view(np.int64)),
             pa.array(s.key[doc]), pa.array(s.places(doc, lo))], names=["h", "h2", "doc_key", "place"])


def _earliest_stretches(piece: pa.RecordBatch, s: _Slice):
    doc, lo, hi = s.surviving()
    mark = np.zeros(len(s.alive), dtype=bool)
    mark[s.named(piece.column("stretch"))] = True
    return doc, lo, hi, mark[lo]


def _window_rows(batches, window, base):
    for piece, s in _open(batches, window, base, levels_of(window, base)):
        doc, lo, hi, earliest = _earliest_stretches(piece, s)
        at, owner = ranges(lo[earliest], hi[earliest])
        doc = doc[earliest][owner]
        yield pa.RecordBatch.from_arrays(
            [pa.array(s.hash(at, at + window).view(np.int64)),
             pa.array(s.hash(at, at + window, 1).view(np.int64)),
             pa.array(s.key[doc]), pa.array(s.places(doc, at))], names=["h", "h2", "doc_key", "place"])


def _kept_rows(batches, window, base):
    for piece, s in _open(batches, window, base, levels_of(window, base)):
        _, lo, hi, earliest = _earliest_stretches(piece, s)
        repeat = np.zeros(len(s.alive), dtype=bool)
        at, _ = ranges(lo, hi)
        repeat[at] = True
        repeat[s.named(piece.column("earliest"))] = False
        # a word goes if one of the `window` windows that cover it repeats
        starts = np.flatnonzero(repeat)
        depth = np.zeros(len(s.alive) + window + 1, dtype=np.int64)
        np.add.at(depth, starts, 1)
        np.add.at(depth, starts + window, -1)
        gone = np.cumsum(depth)[:len(s.words.start)] > 0
        raw, texts, removed = s.words.raw.tobytes(), [], []
        for d in range(len(s.key)):
            a, b = s.words.first[d], s.words.first[d + 1]
            keep = np.flatnonzero(~gone[a:b]) + a
            removed.append(int(b - a - len(keep)))
            texts.append(b" ".join([raw[i:j] for i, j in zip(s.words.start[keep].tolist(),
                                                            s.words.end[keep].tolist())]).decode())
        yield pa.RecordBatch.from_arrays(
            [pa.array(s.key), pa.array(s.tag), pa.array(s.words.count.astype(np.int64)),
             pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
            names=["doc_key", "text_tag", "n_words", "n_removed", "kept_text"])


def _digest_rows(batches):
    """The query's digest of the kept words, made where they are."""
    for batch in batches:
        sha = [hashlib.sha256(t.as_buffer()).hexdigest() for t in batch.column("kept_text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in ("doc_key", "text_tag", "n_words", "n_removed")] + [pa.array(sha, pa.string())],
            names=["doc_key", "text_tag", "n_words", "n_removed", "kept_sha256"])


def remove_repeated(docs: DataFrame, window: int = WINDOW, base: int = BASE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: doc_key, text_tag, n_words, n_removed and
    ``kept_text``, its words outside repeated windows joined by one space.

    A word is removed if it lies in a window of ``window`` words whose
    sequence also starts earlier (smaller doc_id, or earlier in the
    document); windows are judged on the input.
    """
    texts = keyed(docs, id_col, text_col)
    once: list[DataFrame] = []
    parts = levels_of(window, base)
    for n, part in enumerate(parts):
        rows = with_arrays(texts, *once).mapInArrow(
            partial(_part_rows, window=window, base=base, part=part, before=parts[:n]),
            "h long, doc_key long, place long")
        alone = (rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("doc_key").alias("doc_key"),
                                       F.min("place").alias("place")).filter("n = 1"))
        once.append(by_document(alone, f"once{part}"))

    def earliest(rows: DataFrame, name: str) -> DataFrame:
        least = rows.groupBy("h", "h2").agg(F.min(F.struct("doc_key", "place")).alias("least"))
        return by_document(least.select("least.*"), name)

    keyed_rows = "h long, h2 long, doc_key long, place long"
    arrays = list(once)
    arrays.append(earliest(with_arrays(texts, *arrays).mapInArrow(
        partial(_stretch_rows, window=window, base=base), keyed_rows), "stretch"))
    arrays.append(earliest(with_arrays(texts, *arrays).mapInArrow(
        partial(_window_rows, window=window, base=base), keyed_rows), "earliest"))
    return with_arrays(texts, *arrays).mapInArrow(
        partial(_kept_rows, window=window, base=base),
        "doc_key long, text_tag long, n_words long, n_removed long, kept_text string")


def digests(kept: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept text."""
    rows = kept.mapInArrow(_digest_rows, "doc_key long, text_tag long, n_words long, n_removed long, "
                                         "kept_sha256 string")
    return rows.select(doc_id_of(F.col("doc_key")).alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def dedup_stage(docs: DataFrame, window: int = WINDOW, base: int = BASE) -> DataFrame:
    """The documents with their repeated passages removed; a document that
    had words and lost all of them goes. The other columns stay; ``n_chars``
    is counted anew where the text changed."""
    changed = remove_repeated(docs, window, base).filter("n_removed > 0").dropDuplicates(KEY).select(
        F.col("doc_key").alias("__key"), F.col("text_tag").alias("__tag"),
        (F.col("n_removed") < F.col("n_words")).alias("__left"), F.col("kept_text").alias("__kept"))
    rows = docs.withColumns(dict(zip(("__key", "__tag"), key_columns())))
    out = (rows.join(changed.hint("shuffle_hash"), ["__key", "__tag"], "left")
           .filter("__left is null or __left")
           .withColumn("text", F.coalesce("__kept", "text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("__left").isNull(), F.col("n_chars"))
                             .otherwise(F.char_length("text").cast(kind)))
    return out.select(*docs.columns)
