"""Removal of repeated byte strings with suffix arrays.

Every byte covered by a string of ``width`` bytes that starts at two places
or more, in one document or two, is removed. Texts are UTF-8 bytes; matches
never cross documents.

1. Every string is assigned to its anchor, its leftmost part of ``PART``
   bytes with the smallest hash; equal strings have equal anchors. An anchor
   hash found once settles all strings of its run (see ``keys`` for how
   places return to the texts). What remains are regions: the bytes under
   one run of strings. Equal regions collapse to one with a weight, which
   settles them if their anchor has no other region.
2. Regions go to shards by anchor, so equal strings meet in one shard. Each
   shard (about ``SHARD`` bytes) builds its suffix array by Larsson-Sadakane
   refinement: ranks of 4-byte prefixes, then doubled, sorting only what is
   not yet told apart, until all are. Kasai's pass over
   the text gives the common prefixes, all regions side by side; runs of
   common prefixes of ``width`` and more are classes of equal strings.
3. An anchor with more than ``SPLIT`` different regions (a passage in many
   different surroundings) is dealt over several shards. Strings such a
   shard holds once are merged across shards by binary search in the sorted
   128-bit keys of all of them.

Defined results: null text is empty; a text shorter than ``width`` keeps all
its bytes; for null ids and repeated rows see ``keys`` (a repeated row is
one document, not a second copy); an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import (BYTE_BASES, U, key_groups, mix, named_positions, owned_runs, prefix_hash, range_hash, ranges,
                     slices, text_bytes)
from .keys import KEY, by_document, doc_id_of, keyed, position_of, tag_of, with_arrays

WIDTH = 200
PART = 32  # a multiple of 8
SHARD = 1 << 19
SPLIT = 4096
MERGE = 4 << 20  # bytes of keys compared at once; equal ones share a bucket


def prefixes_of_8(raw: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place as one big-endian number (0 past the end)."""
    out = np.concatenate([raw, np.zeros(8, np.uint8)]).astype(U)
    for reach in (1, 2, 4):
        out = (out[:-reach] << U(8 * reach)) | out[reach:]
    return out[:len(raw)]


def _refined(rank: np.ndarray, second: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The places ``at`` sorted by (rank, second), and where the pair is new.
    Three numbers below 2**21 fit one word, which sorts faster than an index."""
    if n < 1 << 21:
        packed = np.sort((rank.astype(U) << U(42)) | (second.astype(U) << U(21)) | at.astype(U))
        at, key = (packed & U((1 << 21) - 1)).astype(np.int64), packed >> U(21)
    else:
        key = rank * np.int64(n + 2) + second
        by = np.argsort(key)
        at, key = at[by], key[by]
    new = np.ones(len(at), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    return at, new


def suffix_array(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the 8-byte prefixes, by refinement of groups:
    a suffix whose group holds it alone is never sorted again."""
    n = len(raw)
    first = prefixes_of_8(raw)
    # two ranks of two bytes each, with a zero past the end below all bytes
    two = np.append(raw, [0, 0]).astype(np.int64) + np.append(np.ones(n, np.int64), [0, 0])
    pair = two[:n] * 257 + two[1:n + 1]
    order, begin = _refined(pair, np.append(pair[2:], [0, 0])[:n], np.arange(n), max(n, 257 * 257))
    at = np.arange(n)
    group = np.maximum.accumulate(np.where(begin, at, 0))
    rank = np.empty(n, np.int64)
    rank[order] = group
    active = order[~(begin & np.append(begin[1:], True))]
    h = 4
    while h < n and len(active):
        after = active + h
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        active, new = _refined(rank[active], second, active, n)
        old, at = rank[active], np.arange(len(active))
        new_old = np.ones(len(active), dtype=bool)
        new_old[1:] = old[1:] != old[:-1]
        start_old = np.maximum.accumulate(np.where(new_old, at, 0))
        start = np.maximum.accumulate(np.where(new, at, 0))
        order[old + at - start_old] = active
        rank[active] = old + start - start_old
        active = active[~(new & np.append(new[1:], True))]
        h *= 2
    return order, first


STEPS = np.array([1 << (8 * k) for k in range(8)], dtype=U)


def common_prefixes(raw: np.ndarray, first: np.ndarray, order: np.ndarray, starts: np.ndarray,
                    lengths: np.ndarray, depth: int) -> np.ndarray:
    """Kasai's pass: common prefix (up to ``depth``) of each suffix of the
    order with the one before it. ``order`` holds the suffixes that begin in
    the given stretches of text. All stretches are walked in step, one byte
    a step; what is left of the match of the byte before is kept, unless the
    matched suffix was the last of its stretch."""
    n = len(raw)
    place = np.full(n + 1, -1, np.int64)
    place[order] = np.arange(len(order))
    words = np.concatenate([first, np.zeros(depth + 16, U)])
    out = np.zeros(len(order), np.int32)
    by = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[by], lengths[by]
    match = np.zeros(len(starts), np.int64)
    for step in range(int(lengths[0]) if len(lengths) else 0):
        live = int(np.searchsorted(-lengths, -step, side="left"))  # lengths > step
        at = starts[:live] + step
        slot = place[at]
        other = order[np.maximum(slot - 1, 0)]
        got = np.where(slot > 0, match[:live], 0)
        todo = np.flatnonzero((slot > 0) & (got < depth))
        while len(todo):
            i, j = at[todo] + got[todo], other[todo] + got[todo]
            same = 8 - np.searchsorted(STEPS, words[i] ^ words[j], side="right")
            same = np.minimum(same, np.minimum(n - i, n - j))
            got[todo] += same
            todo = todo[(same == 8) & (got[todo] < depth)]
        got = np.minimum(got, depth)
        out[slot] = got
        match[:live] = np.where(place[other + 1] >= 0, np.maximum(got - 1, 0), 0)
    return out


def shard_classes(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Start of every ``width``-byte string inside a region, in suffix order,
    and the number of its class of equal strings."""
    order, first = suffix_array(raw)
    owned = np.zeros(len(raw), dtype=bool)
    at, _ = ranges(starts, starts + lengths - width)
    owned[at] = True
    order = order[owned[order]]
    lcp = common_prefixes(raw, first, order, starts, lengths - width + 1, width)
    return order, np.cumsum(lcp < width)


class _Slice:
    def __init__(self, piece: pa.RecordBatch, width: int, part: int) -> None:
        self.key = piece.column("doc_key").to_numpy(zero_copy_only=False)
        self.tag = piece.column("text_tag").to_numpy(zero_copy_only=False)
        self.raw, self.bounds = text_bytes(piece.column("text"))
        self.begin = self.bounds[:-1]
        # the order of parts looks at their first 8 bytes, their key at all
        eight = prefixes_of_8(self.raw)
        parts = eight[:max(0, len(self.raw) - part + 1)] * U(BYTE_BASES[1])
        self.doc, anchor, self.lo, self.hi = owned_runs(parts, self.bounds, width, part)
        key = np.zeros(len(anchor), U)
        for k in range(0, part, 8):
            key = mix(key * U(BYTE_BASES[0]) + eight[anchor + k])
        self.anchor = key.view(np.int64)

    def digests(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """128-bit hashes of byte ranges as two columns."""
        raw = memoryview(self.raw.tobytes())
        joined = b"".join([xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(start.tolist(), end.tolist())])
        return np.frombuffer(joined, np.int64).reshape(-1, 2)

    def keep(self, rows: np.ndarray) -> None:
        self.doc, self.lo, self.hi, self.anchor = self.doc[rows], self.lo[rows], self.hi[rows], self.anchor[rows]

    def settle(self, column: pa.Array) -> None:
        """Drop the runs whose anchor was found once."""
        mark = np.zeros(len(self.raw) + 1, dtype=bool)
        mark[named_positions(column, self.begin)[0]] = True
        self.keep(~mark[self.lo])

    def places(self) -> np.ndarray:
        return (self.tag[self.doc] << 32) | (self.lo - self.begin[self.doc])

    def named(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For each run: is it named by the column, and the named value."""
        at, value = named_positions(column, self.begin)
        mark = np.full(len(self.raw) + 1, -1, dtype=np.int64)
        mark[at] = value
        return mark[self.lo] >= 0, mark[self.lo]


def _open(batches, width, part):
    for batch in batches:
        for piece in slices(batch, "text", 1 << 20):
            yield piece, _Slice(piece, width, part)


def _anchor_rows(batches, width, part):
    for _, s in _open(batches, width, part):
        yield pa.RecordBatch.from_arrays([pa.array(s.anchor), pa.array(s.key[s.doc]), pa.array(s.places())],
                                         names=["h", "doc_key", "place"])


def _region_rows(batches, width, part):
    for piece, s in _open(batches, width, part):
        s.settle(piece.column("once"))
        digest = s.digests(s.lo, s.hi + width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy()), pa.array(s.anchor), pa.array(s.key[s.doc]), pa.array(s.places())],
            names=["g", "g2", "h", "doc_key", "place"])


def _region_texts(batches, width, part):
    for piece, s in _open(batches, width, part):
        s.settle(piece.column("once"))
        named, value = s.named(piece.column("region"))
        s.keep(named)
        value = value[named]
        shards = value >> 1
        # a split anchor deals its regions by a hash of their place
        salt = (s.places() * np.int64(0x9E3779B97F4A7C1 | 1) >> 20 & 0x7FFFFFFF) % np.maximum(shards, 1)
        raw = s.raw.tobytes()
        texts = [raw[a:b] for a, b in zip(s.lo.tolist(), (s.hi + width).tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(s.anchor), pa.array(salt.astype(np.int32)), pa.array(shards.astype(np.int32)),
             pa.array((value & 1).astype(np.int32) + 1, pa.int32()), pa.array(s.key[s.doc]), pa.array(s.places()),
             pa.array(texts, pa.binary())],
            names=["h", "salt", "shards", "weight", "doc_key", "place", "bytes"])


SHARD_ROWS = "doc_key long, place long, n long, h long, bucket int, keys binary"


def _shards(batches, width):
    """Suffix array of each shard: rows of repeated strings (n starts from
    place on) and, for split anchors, rows (n = 0) of packed keys of their
    strings, one key per class known to repeat and one per other string. An
    anchor dealt to s shards has its keys dealt to s buckets."""
    for table in key_groups(batches, ["h", "salt"], SHARD, "bytes"):
        table = table.combine_chunks()
        column = table.column("bytes").combine_chunks() if table.num_rows else None
        raw, bounds = _binary(column)
        starts, lengths = bounds[:-1], np.diff(bounds)
        at, number = shard_classes(raw, starts, lengths, width)
        region = np.searchsorted(bounds, at, side="right") - 1
        weight = table.column("weight").to_numpy()[region]
        shards = table.column("shards").to_numpy()
        total = np.bincount(number, weights=weight, minlength=number.max() + 1 if len(number) else 0)
        repeated = total[number] >= 2
        key, place = table.column("doc_key").to_numpy(), table.column("place").to_numpy()
        names = ["doc_key", "place", "n", "h", "bucket", "keys"]
        spot = np.sort(at[repeated])
        if len(spot):
            r = np.searchsorted(bounds, spot, side="right") - 1
            new = np.ones(len(spot), dtype=bool)
            new[1:] = (spot[1:] != spot[:-1] + 1) | (r[1:] != r[:-1])
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(spot)))
            r = r[first]
            where = place[r] + spot[first] - starts[r]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[r]), pa.array(where), pa.array(size),
                 pa.array(mix((where ^ key[r]).view(U)).view(np.int64)),
                 pa.array(np.full(len(r), -1, np.int32)), pa.array([b""] * len(r), pa.binary())], names=names)
        one = np.zeros(len(at), dtype=bool)
        one[np.unique(number, return_index=True)[1]] = True  # one of each class
        pick = np.flatnonzero((shards[region] > 1) & (one | ~repeated))
        if len(pick):
            a, r = at[pick], region[pick]
            k, k2 = (range_hash(prefix_hash(raw.astype(U), b), b, a, a + width).view(np.int64) for b in BYTE_BASES)
            anchor, bucket = table.column("h").to_numpy()[r], (k & 0x7FFFFFFF) % shards[r]
            by = np.lexsort((bucket, anchor))
            keys = np.stack([k, k2, key[r], place[r] + a - starts[r], repeated[pick].astype(np.int64)], axis=1)[by]
            anchor, bucket = anchor[by], bucket[by]
            new = np.ones(len(by), dtype=bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (bucket[1:] != bucket[:-1])
            cut = np.flatnonzero(new)
            packed = [keys[i:j].tobytes() for i, j in zip(cut, np.append(cut[1:], len(by)))]
            zero = pa.array(np.zeros(len(cut), np.int64))
            yield pa.RecordBatch.from_arrays(
                [zero, zero, zero, pa.array(anchor[cut]), pa.array(bucket[cut].astype(np.int32)),
                 pa.array(packed, pa.binary())], names=names)


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(column.buffers()[2], np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def _merge(batches):
    """Rows of repeated strings as they come, and the strings that a split
    anchor's shards hold once each but that occur in another shard: found by
    binary search in the sorted keys of all."""
    names = ["doc_key", "place", "n"]
    for table in key_groups(batches, ["h", "bucket"], MERGE, "keys"):
        known = table.filter(pa.array(table.column("n").to_numpy() > 0)).select(names)
        yield from known.to_batches()
        raw, _ = _binary(table.column("keys"))
        if not len(raw):
            continue
        k, k2, doc_key, place, repeats = np.frombuffer(raw.tobytes(), np.int64).reshape(-1, 5).T
        mine = mix(k.view(U)) + k2.view(U)
        keys = np.sort(mine)
        found = np.searchsorted(keys, mine, side="right") - np.searchsorted(keys, mine, side="left")
        hit = (found >= 2) & (repeats == 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc_key[hit]), pa.array(place[hit]), pa.array(np.ones(int(hit.sum()), np.int64))], names=names)


def _kept(batches, width, part):
    for piece, s in _open(batches, width, part):
        s.settle(piece.column("once"))
        named, _ = s.named(piece.column("region"))
        # a run equal to another region lies whole in repeated strings; of the
        # one copy that went to a shard, the shard named the repeated starts
        depth = np.zeros(len(s.raw) + 1, np.int64)
        np.add.at(depth, s.lo[~named], 1)
        np.add.at(depth, s.hi[~named] + width, -1)
        at, size = named_positions(piece.column("repeated"), s.begin)
        np.add.at(depth, at, 1)
        np.add.at(depth, at + size - 1 + width, -1)
        gone = np.cumsum(depth)[:-1] > 0
        head = gone.copy()
        head[1:] &= ~gone[:-1]
        cut = s.begin[s.begin < len(gone)]
        head[cut] = gone[cut]
        sums = np.concatenate([[0], np.cumsum(gone)])
        spans = np.concatenate([[0], np.cumsum(head)])
        removed = sums[s.bounds[1:]] - sums[s.begin]
        kept = s.raw[~gone].tobytes()
        end = np.cumsum(np.diff(s.bounds) - removed)
        texts = [kept[b - k:b] for b, k in zip(end.tolist(), (np.diff(s.bounds) - removed).tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(s.key), pa.array(s.tag), pa.array(np.diff(s.bounds)), pa.array(removed),
             pa.array(spans[s.bounds[1:]] - spans[s.begin]), pa.array(texts, pa.binary())],
            names=["doc_key", "text_tag", "n_bytes", "n_removed", "n_spans", "kept"])


def _digests(batches):
    names = ["doc_key", "n_bytes", "n_removed", "n_spans"]
    for batch in batches:
        sha = [hashlib.sha256(k.as_buffer()).hexdigest() for k in batch.column("kept")]
        yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(sha, pa.string())],
                                         names=[*names, "kept_sha256"])


def remove_repeated(docs: DataFrame, width: int = WIDTH, part: int = PART, split: int = SPLIT,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: doc_key, text_tag, n_bytes, n_removed, n_spans and
    ``kept``, the bytes outside repeated strings."""
    if part % 8 or part > width:
        raise ValueError("part must be a multiple of 8 and at most width")
    texts = keyed(docs, id_col, text_col)
    size = {"width": width, "part": part}
    anchors = texts.mapInArrow(partial(_anchor_rows, **size), "h long, doc_key long, place long")
    alone = (anchors.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("doc_key").alias("doc_key"),
                                      F.min("place").alias("place")).filter("n = 1"))
    once = by_document(alone, "once")

    regions = with_arrays(texts, once).mapInArrow(
        partial(_region_rows, **size), "g long, g2 long, h long, doc_key long, place long")
    distinct = regions.groupBy("g", "g2").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_key", "place", "h")).alias("least"))
    distinct = distinct.select("n", "least.*")
    # a region whose anchor has no other is settled by its copies
    several = distinct.groupBy("h").agg(F.count(F.lit(1)).alias("regions")).filter("regions > 1")
    dealt = distinct.join(several, "h").withColumn("shards", F.ceil(F.col("regions") / split).cast("long"))
    code = position_of(F.col("place")) + F.shiftleft(F.shiftleft("shards", 1) + (F.col("n") > 1).cast("long"), 32)
    region = _lists(dealt, code, "region")

    shards = (with_arrays(texts, once, region).mapInArrow(
        partial(_region_texts, **size),
        "h long, salt int, shards int, weight int, doc_key long, place long, bytes binary")
        .repartition("h", "salt").sortWithinPartitions("h", "salt")
        .mapInArrow(partial(_shards, width=width), SHARD_ROWS))
    found = (shards.repartition("h", "bucket").sortWithinPartitions("h", "bucket")
             .mapInArrow(_merge, "doc_key long, place long, n long"))
    repeated = _lists(found, position_of(F.col("place")) + F.shiftleft("n", 32), "repeated")
    return with_arrays(texts, once, region, repeated).mapInArrow(
        partial(_kept, **size), "doc_key long, text_tag long, n_bytes long, n_removed long, n_spans long, kept binary")


def _lists(places: DataFrame, code, name: str) -> DataFrame:
    return (places.select("doc_key", tag_of(F.col("place")).alias("text_tag"), code.alias("code"))
            .groupBy(*KEY).agg(F.collect_list("code").alias(name)))


def digests(kept: DataFrame) -> DataFrame:
    """doc_id, the counts and the SHA-256 of the kept bytes."""
    rows = kept.mapInArrow(_digests, "doc_key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return rows.withColumn("doc_id", doc_id_of(F.col("doc_key"))).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
