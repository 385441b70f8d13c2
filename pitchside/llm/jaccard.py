"""Near-duplicate join: Jaccard similarity of word n-gram sets by MinHash
banding, with every pair verified on its full sets.

1. Texts with equal word sequences collapse to one node (by a 128-bit hash
   of the sequence); all later work is on nodes.
2. Rows per band and bands follow from the target recall at the threshold
   (``choose_bands``). Nodes with an equal band hash share a bucket; buckets
   of several bands with the same members are one set.
3. The pairs within a set are compared on their full n-gram sets, as block
   products of incidence matrices. A pair that shares several sets counts in
   the smallest of them only, so each banded pair is judged once, and pairs
   that share no band never meet. A set beyond ``BLOCK`` texts (or
   ``BLOCK_WORDS`` words) is dealt to blocks, one task per pair of blocks, so
   no task holds a whole set. Tasks return the number of links of each node
   and a spanning forest, never the pairs.
4. Connected components of the forests are the classes.

The recall of a pair at the threshold is the target. Counting links exactly
costs the square of a set's distinct texts, spread over block pairs.

Defined results: a text of one to four words has one n-gram, all its words;
a text without words (null or empty) has none and links to nothing but the
others like it; for null ids and repeated rows see ``keys``; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from fractions import Fraction
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U, WORD_BASES, Words, give_back, key_groups, mix, prefix_hash, range_hash, slices
from .components import components
from .keys import KEY, doc_id_of, key_columns, keyed

SHINGLE = 5
THRESHOLD = "0.8"
RECALL = 0.9999
HASHES = 128
BLOCK = 2048
BLOCK_WORDS = 1_000_000


def choose_bands(threshold: float, recall: float, most: int) -> tuple[int, int]:
    """(bands, rows): the most rows a band for which enough bands to find a
    pair at the threshold with probability ``recall`` fit ``most`` hashes."""
    best = None
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))
        if bands * rows <= most:
            best = (bands, rows)
    if best is None:
        raise ValueError("no band layout reaches the recall")
    return best


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every run of ``size`` words; of a shorter
    document the one run of all its words."""
    prefix = prefix_hash(words.hashes(), WORD_BASES[0])
    count = np.where(words.count >= size, words.count - size + 1, np.minimum(words.count, 1))
    doc = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(doc)) - (np.cumsum(count) - count)[doc] + words.first[:-1][doc]
    return range_hash(prefix, WORD_BASES[0], at, np.minimum(at + size, words.first[1:][doc])), doc


def _signatures(batches, size: int, bands: int, rows: int):
    seeds = np.random.default_rng(20240229).integers(0, 1 << 63, (2, bands * rows), dtype=np.uint64)
    factor, shift = seeds[0] * U(2) + U(1), seeds[1]
    for batch in batches:
        for piece in slices(batch, "text", 1 << 20):
            words = Words(piece.column("text"))
            n = len(words.count)
            node, check = (range_hash(prefix_hash(words.hashes(which), WORD_BASES[1 - which]), WORD_BASES[1 - which],
                                      words.first[:-1], words.first[1:]) for which in (0, 1))
            hashes, doc = shingles(words, size)
            full = np.flatnonzero(words.count > 0)
            begin = np.searchsorted(doc, full)
            out = np.zeros((n, bands), U)
            for b in range(bands):
                joint = np.full(len(full), b, U)
                for r in range(b * rows, (b + 1) * rows):
                    least = np.minimum.reduceat(hashes * factor[r] + shift[r], begin) if len(full) else joint
                    joint = mix(joint * U(0x9E3779B97F4A7C15) + least)
                out[full, b] = joint
            ends = np.cumsum(np.where(words.count > 0, bands, 0))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()),
                                             pa.array(out[full].reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_key"), piece.column("text_tag"), pa.array(node.view(np.int64)),
                 pa.array(check.view(np.int64)), pa.array(words.count.astype(np.int64)), lists],
                names=["doc_key", "text_tag", "sequence", "check", "n_words", "bands"])
    give_back()


def _intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of left and right sets."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, feature, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = seen > 1
    number = np.cumsum(shared) - 1
    use = shared[feature]
    owner, feature = owner[use], number[feature[use]]
    by = np.argsort(feature, kind="stable")
    owner, feature = owner[by], feature[by]
    out = np.zeros((len(left), len(right)), np.float32)
    step = max(256, (4 << 20) // max(1, len(sets)))
    total = int(shared.sum())
    for c in range(0, total, step):
        a, b = np.searchsorted(feature, [c, c + step])
        there = np.zeros((len(sets), min(step, total - c)), np.float32)
        there[owner[a:b], feature[a:b] - c] = 1
        out += there[left] @ there[right].T
    return out


def _forest(linked: np.ndarray) -> np.ndarray:
    """Smallest index of each row's component in a symmetric matrix."""
    label = np.full(len(linked), -1)
    for i in range(len(linked)):
        if label[i] >= 0:
            continue
        label[i] = i
        edge = np.array([i])
        while len(edge):
            edge = np.flatnonzero(linked[edge].any(axis=0) & (label < 0))
            label[edge] = i
    return label


def _met_before(sets: pa.ListArray, here: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Pairs that share a set smaller than this one."""
    row = np.repeat(np.arange(len(sets)), sets.value_lengths().to_numpy(zero_copy_only=False))
    value = sets.flatten().to_numpy(zero_copy_only=False)
    row, value = row[value < here], value[value < here]
    names, column, seen = np.unique(value, return_inverse=True, return_counts=True)
    out = np.zeros((len(left), len(right)), dtype=bool)
    column, row = column[seen[column] > 1], row[seen[column] > 1]
    for at in range(0, len(names), 2048):
        part = (column >= at) & (column < at + 2048)
        there = np.zeros((len(sets), min(2048, len(names) - at)), np.float32)
        there[row[part], column[part] - at] = 1
        out |= there[left] @ there[right].T > 0
    return out


VERIFIED = "node long, other long, text_links long, doc_links long"


def _verify(batches, size: int, threshold: str):
    """Per node of each pair of blocks: its links there and the smallest
    node it is connected to there."""
    limit = Fraction(threshold)
    for table in key_groups(batches, ["set", "low", "high"]):
        table = table.combine_chunks().sort_by("node")
        block = table.column("block").to_numpy()
        here, low, high = (table.column(c)[0].as_py() for c in ("set", "low", "high"))
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        if not len(left) or not len(right):
            continue
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        words = Words(table.column("text"))
        hashes, doc = shingles(words, size)
        cuts = np.searchsorted(doc, np.arange(len(node) + 1))
        sets = [np.unique(hashes[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
        sizes = np.array([len(s) for s in sets])
        both = _intersections(sets, left, right)
        # |a & b| / |a | b| >= p / q, in whole numbers
        p, q = limit.numerator, limit.denominator
        linked = both * (p + q) >= p * (sizes[left][:, None] + sizes[right][None, :])
        linked &= ~_met_before(table.column("sets").combine_chunks(), here, left, right)
        whole = np.zeros((len(node), len(node)), dtype=bool)
        whole[np.ix_(left, right)] = linked
        if low == high:
            np.fill_diagonal(whole, False)
        else:
            whole[np.ix_(right, left)] = linked.T
        links, docs = whole.sum(axis=1), whole @ copies
        label, found = _forest(whole), links > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[found]), pa.array(node[label][found]), pa.array(links[found].astype(np.int64)),
             pa.array(docs[found].astype(np.int64))], names=["node", "other", "text_links", "doc_links"])
        give_back()


def link(docs: DataFrame, size: int = SHINGLE, threshold: str = THRESHOLD, recall: float = RECALL,
         hashes: int = HASHES, block: int = BLOCK, block_words: int = BLOCK_WORDS,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: doc_key, text_tag, class_key and class_tag
    (smallest document of its class), ``n_links`` (other documents it is
    near to, copies included) and ``n_text_links`` (different word
    sequences among them)."""
    bands, rows = choose_bands(float(Fraction(threshold)), recall, hashes)
    texts = keyed(docs, id_col, text_col)
    signed = texts.mapInArrow(
        partial(_signatures, size=size, bands=bands, rows=rows),
        "doc_key long, text_tag long, sequence long, check long, n_words long, bands array<long>").checkpoint()
    same = ["sequence", "check"]
    nodes = signed.groupBy(*same).agg(
        F.count(F.lit(1)).alias("copies"), F.max("n_words").alias("n_words"), F.any_value("bands").alias("bands"),
        F.min(F.struct(*KEY)).alias("first")).select(
        *same, "copies", "n_words", "bands", "first.*", F.monotonically_increasing_id().alias("node")).checkpoint()

    banded = nodes.select("node", "n_words", F.explode("bands").alias("band"))
    members = [F.bit_xor(F.xxhash64(F.lit(k), F.col("node"))).alias(f"m{k}") for k in (0, 1)]
    buckets = banded.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("words"), *members).filter("n > 1")
    sets = buckets.groupBy("n", "words", "m0", "m1").agg(F.min("band").alias("band"))
    sets = sets.select("band", F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("words") / block_words))
                       .cast("int").alias("blocks"))
    placed = banded.join(sets, "band").select("node", F.col("band").alias("set"), "blocks").checkpoint()
    mine = placed.groupBy("node").agg(F.sort_array(F.collect_list("set")).alias("sets"))  # one per band at most
    dealt = (placed.join(mine, "node").join(nodes.select("node", "copies", *KEY), "node")
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int")))
    dealt = (texts.join(dealt.hint("shuffle_hash"), KEY).dropDuplicates([*KEY, "set"])
             .withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("node", "set", "sets", "block", "copies", "text",
                     F.least("block", "partner").alias("low"), F.greatest("block", "partner").alias("high"))
             .repartition("set", "low", "high").sortWithinPartitions("set", "low", "high"))
    checked = dealt.mapInArrow(partial(_verify, size=size, threshold=threshold), VERIFIED).checkpoint()

    links = checked.groupBy("node").agg(F.sum("text_links").alias("text_links"), F.sum("doc_links").alias("doc_links"))
    joined = components(checked.filter("node <> other").select("node", "other"), "node", "other")
    labels = nodes.drop("bands").join(links, "node", "left").join(joined, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    classes = labels.groupBy("label").agg(F.min(F.struct(*KEY)).alias("c")).select(
        "label", F.col("c.doc_key").alias("class_key"), F.col("c.text_tag").alias("class_tag"))
    result = labels.join(classes, "label").select(
        *same, "class_key", "class_tag", F.coalesce("text_links", F.lit(0)).alias("n_text_links"),
        (F.coalesce("doc_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return signed.select(*KEY, *same).join(result, same).select(
        *KEY, "class_key", "class_tag", "n_links", "n_text_links")


def classes(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class) and both link counts."""
    rows = link(docs, **options)
    return rows.select(doc_id_of(F.col("doc_key")).alias("doc_id"), doc_id_of(F.col("class_key")).alias("class_id"),
                       "n_links", "n_text_links")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The smallest document of every class, with its own columns; of rows
    that repeat id and text one stays, and so does one text without words."""
    kept = link(docs, **options).filter("doc_key = class_key and text_tag = class_tag").select(
        F.col("doc_key").alias("__key"), F.col("text_tag").alias("__tag")).distinct()
    rows = docs.withColumns(dict(zip(("__key", "__tag"), key_columns())))
    return rows.join(kept.hint("shuffle_hash"), ["__key", "__tag"]).dropDuplicates(
        ["__key", "__tag"]).select(*docs.columns)
