"""Document fingerprints from closed syncmers.

Native: array expressions in one projection per text. A text is cut into
units (words; longer runs without white space into pieces of 16 code
points). A run of ``RUN`` units is an anchor if the minimal pair of
neighbouring units in it, by hash, is its first or its last pair: whether it
is one depends on nothing outside it, so equal passages give equal anchors
wherever they stand. The first and the last run of a text are anchors too.
Anchors follow each other by at most ``RUN`` - 1 units, so every unit lies in
one and texts of different units have different fingerprints, whatever their
length (but for collisions of 40-bit hashes).

The fingerprint holds all anchors in text order: one hex digit for the
distance from the anchor before and ten for the hash. Two fingerprints are
compared by position: each hash that both have gives an offset (of its first
places), offsets are counted in bands of ``BAND`` units (the better of two
alignments), and likeness is the root of the sum of squared counts over the
larger number of different hashes. A text in another order has many offsets
and a low likeness, a common passage counts wherever it stands, and a few
words put in move what follows by less than a band.

Defined results: null text is empty; an empty text (no units) has the empty
fingerprint, whose likeness is 1 to itself and 0 to all others; a text of at
most ``RUN`` units has one anchor, the whole; of a run that repeats in a text
only the first place is compared; places count modulo 2^23 units; rows that
repeat id and text count as one document in the order of ids and get equal
results, rows that share an id with different texts are neighbours in the
order of text hashes; null ids come last; a single document is its own
successor; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .exprs import let

RUN = 8
BAND_BITS = 6  # offsets within 64 units agree
PLACE_BITS = 23
FIRST = -(1 << 63)


def units_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("[^ \\t-\\r]{1,16}"), F.lit(0))


_LOW = (1 << (PLACE_BITS + 1)) - 1  # place and one spare bit; 40 bits of hash above
_PLACE = (1 << PLACE_BITS) - 1


def hash_of(anchor: Column) -> Column:
    return F.shiftrightunsigned(anchor, PLACE_BITS + 1)


def place_of(anchor: Column) -> Column:
    return anchor.bitwiseAND(_PLACE)


def _indices(array: Column) -> Column:
    return F.when(F.size(array) > 0, F.sequence(F.lit(0), F.size(array) - 1)).otherwise(F.array().cast("array<int>"))


def anchors_of(text: Column) -> Column:
    """The closed syncmers of a text, in its order, each packed into a long:
    40 bits of hash above its place (in units)."""
    def chosen(h: Column, pairs: Column) -> Column:
        last = F.greatest(F.lit(0), F.size(h) - RUN)
        pair = lambda i: F.get(pairs, i)
        inner = lambda i: F.least(*[pair(i + k) for k in range(1, RUN - 2)])
        edge = lambda i: (i == 0) | (i == last) | (F.least(pair(i), pair(i + RUN - 2)) <= inner(i))
        packed = lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(RUN)]).bitwiseAND(
            ~_LOW).bitwiseOR(i.cast("long").bitwiseAND(_PLACE))
        return F.when(F.size(h) == 0, F.array().cast("array<long>")).otherwise(
            F.transform(F.filter(F.sequence(F.lit(0), last), edge), packed))

    def with_pairs(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1)))
        return let(pairs, lambda p: chosen(h, p))

    return let(F.transform(units_of(text), lambda u: F.xxhash64(u)), with_pairs)


def placed(anchors: Column) -> Column:
    """Different hashes in order, each with its first place."""
    return let(F.sort_array(anchors), lambda s: F.filter(
        s, lambda x, i: F.coalesce(hash_of(x) != hash_of(F.get(s, i - 1)), F.lit(True))))


def written(anchors: Column) -> Column:
    """The fingerprint as text."""
    def steps(a: Column) -> Column:
        gap = lambda x, i: (place_of(x) - place_of(F.coalesce(F.get(a, i - 1), x))).bitwiseAND(15)
        return F.transform(a, lambda x, i: F.concat(F.hex(gap(x, i)), F.lpad(F.hex(hash_of(x)), 10, "0")))
    return F.lower(F.array_join(let(anchors, steps), ""))


def _band_norm(offsets: Column, shift: int) -> Column:
    """Sum of squared counts of the offsets' bands."""
    def runs(b: Column) -> Column:
        starts = F.filter(_indices(b), lambda j: F.coalesce(F.get(b, j) != F.get(b, j - 1), F.lit(True)))
        return let(starts, lambda s: F.aggregate(
            F.transform(s, lambda x, j: F.coalesce(F.get(s, j + 1), F.size(b)) - x),
            F.lit(0.0), lambda t, n: t + n.cast("double") * n))
    return let(F.sort_array(F.transform(offsets, lambda d: F.shiftright(d + shift, BAND_BITS))), runs)


def likeness(a: Column, b: Column) -> Column:
    """Agreement of two ``placed`` arrays, 0 to 1."""
    side = 1 << PLACE_BITS
    def offsets(m: Column) -> Column:
        both = lambda j: ((F.get(m, j).bitwiseAND(side) == 0) & (F.get(m, j + 1).bitwiseAND(side) != 0)
                          & (hash_of(F.get(m, j)) == hash_of(F.get(m, j + 1))))
        return F.transform(F.filter(_indices(m), lambda j: F.coalesce(both(j), F.lit(False))),
                           lambda j: place_of(F.get(m, j + 1)) - place_of(F.get(m, j)))
    merged = F.sort_array(F.concat(a, F.transform(b, lambda x: x.bitwiseOR(side))))
    norm = let(let(merged, offsets), lambda d: F.greatest(_band_norm(d, 0), _band_norm(d, 1 << (BAND_BITS - 1))))
    most = F.greatest(F.size(a), F.size(b))
    return F.when(most == 0, 1.0).otherwise(F.sqrt(norm) / most)


def anchors(docs: DataFrame) -> DataFrame:
    """One row per anchor: doc_id, position (in units) and hash."""
    rows = docs.select("doc_id", F.explode(anchors_of(F.coalesce("text", F.lit("")))).alias("anchor"))
    return rows.select("doc_id", place_of(F.col("anchor")).alias("position"), hash_of(F.col("anchor")).alias("hash"))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("key"),
                       F.xxhash64(text).alias("tag"), text.alias("text"))


def successors(docs: DataFrame) -> DataFrame:
    """For every document (key, tag), in descending order: the one before it
    (to_key, to_tag, to_chars). The first follows the last.

    Only ids travel: they are range-partitioned, neighbours are found within
    a partition, and a table of one row per partition links the edges. The
    partition numbers are data, so they are fixed by a checkpoint first.
    """
    ids = (_keyed(docs).select("key", "tag", F.char_length("text").cast("long").alias("chars")).distinct()
           .repartitionByRange(F.desc("key"), F.desc("tag"))
           .withColumn("part", F.spark_partition_id()).checkpoint())
    me = F.struct("key", "tag", "chars")
    edges = ids.groupBy("part").agg(F.min(me).alias("last"))
    ring = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = edges.select("part", F.coalesce(F.lag("last").over(Window.orderBy("part")),
                                            F.last("last").over(ring)).alias("edge"))
    inner = Window.partitionBy("part").orderBy(F.desc("key"), F.desc("tag"))
    return (ids.withColumn("before", F.lag(me).over(inner)).join(edges, "part")
            .withColumn("to", F.coalesce("before", "edge"))
            .select("key", "tag", F.col("to.key").alias("to_key"), F.col("to.tag").alias("to_tag"),
                    F.col("to.chars").alias("to_chars")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text, of its edited text, and both likenesses.

    The edited text ends with the head of the next document in place of its
    own last third; only such heads and the placed anchors are shuffled
    besides the texts.
    """
    texts = _keyed(docs)
    sketched = texts.join(successors(docs), ["key", "tag"]).dropDuplicates(["key", "tag"])
    sent = sketched.select(
        F.col("to_key").alias("key"), F.col("to_tag").alias("tag"),
        F.substring(F.col("text"), F.lit(1), F.floor(F.col("to_chars") / 3).cast("int")).alias("head"),
        placed(anchors_of(F.col("text"))).alias("next_placed"))
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    joined = texts.join(sent, ["key", "tag"]).select(
        "key", F.col("text"), n.cast("long").alias("n_chars"), "next_placed",
        F.concat(F.substring(F.col("text"), F.lit(1), n - cut), "head").alias("edited"))
    both = joined.select(
        "key", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "next_placed",
        F.struct(anchors_of(F.col("text")).alias("own"), anchors_of(F.col("edited")).alias("edited")).alias("anchors"))
    # both arrays once per text, then everything that reads them
    read = lambda t: F.struct(
        written(t["own"]).alias("fingerprint"), written(t["edited"]).alias("edited_fingerprint"),
        let(placed(t["own"]), lambda p: F.struct(
            likeness(p, placed(t["edited"])).alias("edited"),
            likeness(p, F.col("next_placed")).alias("next"))).alias("near"))
    out = both.select("key", "n_chars", "edited_sha256", let(F.col("anchors"), read).alias("r"))
    return out.select(
        F.when(F.col("key") != FIRST, F.col("key")).alias("doc_id"), "n_chars", "edited_sha256",
        "r.fingerprint", "r.edited_fingerprint",
        F.col("r.near.edited").alias("near_edited"), F.col("r.near.next").alias("near_next"))
