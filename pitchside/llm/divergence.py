"""Source divergence audit over a quadtree of the group-term count matrix.

Per language, the rows of a matrix are its sources and the columns its kept
terms; the cells are counts. A source uses few of a language's terms, so most
of the matrix is empty, and an empty cell still has a smoothed share: the
same for the whole row. The matrix is cut into blocks of rows and columns,
and each block into a K-squared tree (K = 2). Two row blocks are walked
jointly down the tree of one column block: where a quadrant is empty in both
rows, the sum of differences over its columns is the difference of the two
empty shares times the number of columns; only leaves with a cell in either
row are compared cell by cell.

Counting: each task counts the terms of its documents per group in plain
dictionaries of bounded size and sends partial counts; Spark adds them up. No
text is shuffled. All shares are integers, products are decimals.

Scale: the unit of work is (language, column block, pair of row blocks), at
most ``ROWS`` rows by about ``COLUMNS`` columns twice, whatever the size of a
source. Pairs of all sources of a language are the asked result; their number
is bounded by sources, not documents.

Defined results: null text, lang and source are ''; every row of the table is
a document (repeated rows count each time); a group without terms has equal
shares for all terms; a language without kept terms has value 0 for each
pair and no term rows; a language with one source has no pair rows; ties are
ranked by the item's UTF-8 bytes; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchside.session import scratch_path

LEAST_DOCUMENTS = 30
TOP_TERMS = 50
UNIT = 1_000_000_000
ADD = 5
ROWS, COLUMNS, LEAF = 128, 4096, 8
HELD_TERMS = 300_000  # distinct (group, term) entries a task holds before it sends them

# Letters stay (A-Z lower-cased), bytes of other characters stay, the rest separates.
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
                    for b in range(256))


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def out() -> pa.RecordBatch:
        langs, sources, terms, n, docs = [], [], [], [], []
        for (lang, source), (times, rows) in held.items():
            langs += [lang] * len(times)
            sources += [source] * len(times)
            terms += times
            n += times.values()
            docs += map(rows.__getitem__, times)
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(sources, pa.string()),
             pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
            names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
        for group, text in zip(groups, batch.column("text").cast(pa.large_binary())):
            times, rows = held.setdefault(group, (Counter(), Counter()))
            size -= len(times)
            found = text.as_py().translate(_TERM_BYTES).split()
            times.update(found)
            rows.update(set(found))
            if not times:  # a group without terms must still occur
                times[b""] = 0
            size += len(times)
            if size >= HELD_TERMS:
                yield out()
                size = 0
    if held:
        yield out()


def group_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents); each group
    also has the term '' with no occurrence if a document of it has none."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    partial = docs.select(text("lang"), text("source"), text("text")).mapInArrow(
        _partial_counts, "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, width: Column) -> Column:
    """1 + floor(UNIT * (count + ADD) / (total + ADD * width)), exactly."""
    wide = lambda c: c.cast("decimal(20,0)")
    top = F.lit(UNIT).cast("decimal(10,0)") * wide(count + F.lit(ADD))
    bottom = wide(total) + wide(width) * F.lit(ADD).cast("decimal(2,0)")
    rest = top % bottom
    return (F.lit(1) + ((top - rest) / bottom).cast("decimal(20,0)")).cast("long")


# -- the joint walk of one block ------------------------------------------------

def occupied(table: np.ndarray) -> list[np.ndarray]:
    """Occupancy of the tree's squares, from the leaves (side ``LEAF``) up to
    one square: level l has a flag per square of side LEAF * 2**l."""
    rows, columns = (-(-s // LEAF) * LEAF for s in table.shape)
    padded = np.zeros((rows, columns), dtype=bool)
    padded[:table.shape[0], :table.shape[1]] = table
    levels = [padded.reshape(rows // LEAF, LEAF, columns // LEAF, LEAF).any(axis=(1, 3))]
    while levels[-1].size > 1:
        below = levels[-1]
        grown = np.zeros([s + s % 2 for s in below.shape], dtype=bool)
        grown[:below.shape[0], :below.shape[1]] = below
        levels.append(grown.reshape(grown.shape[0] // 2, 2, grown.shape[1] // 2, 2).any(axis=(1, 3)))
    return levels


def joint_distances(left: np.ndarray, right: np.ndarray, left_empty: np.ndarray, right_empty: np.ndarray,
                    width: int) -> np.ndarray:
    """Sums over ``width`` columns of the differences of every left row and
    every right row. Cells hold shares, 0 where there is no count; a row's
    empty cells all have its ``empty`` share."""
    a, b = occupied(left > 0), occupied(right > 0)
    depth = max(len(a), len(b))
    a += [a[-1]] * (depth - len(a))
    b += [b[-1]] * (depth - len(b))
    bands = (len(a[0]), len(b[0]))
    free = np.zeros(bands, dtype=np.int64)  # columns priced without a visit, by leaf band
    out = np.zeros((bands[0], bands[1], LEAF, LEAF), dtype=np.int64)

    def cells(table: np.ndarray, empty: np.ndarray) -> np.ndarray:
        rows, columns = (-(-s // LEAF) * LEAF for s in table.shape)
        full = np.zeros((rows, columns), dtype=np.int64)
        full[:table.shape[0], :width] = np.where(table[:, :width] > 0, table[:, :width], empty[:, None])
        return full.reshape(rows // LEAF, LEAF, columns // LEAF, LEAF).swapaxes(1, 2)

    grid_a, grid_b = cells(left, left_empty), cells(right, right_empty)
    squares = np.zeros((1, 3), dtype=np.int64)  # band of the left, band of the right, square of columns
    for level in reversed(range(depth)):
        side = LEAF << level
        i, j, c = squares.T
        has = lambda occ, r: occ[level][np.minimum(r, occ[level].shape[0] - 1), np.minimum(c, occ[level].shape[1] - 1)]
        met = has(a, i) | has(b, j)
        for x, y, z in squares[~met]:
            columns = max(0, min(width, (z + 1) * side) - z * side)
            free[x << level:(x + 1) << level, y << level:(y + 1) << level] += columns
        squares = squares[met]
        if level:
            child = np.stack(np.meshgrid([0, 1], [0, 1], [0, 1], indexing="ij"), -1).reshape(-1, 3)
            squares = (squares[:, None, :] * 2 + child).reshape(-1, 3)
            inside = ((squares[:, 0] << (level - 1)) < bands[0]) & ((squares[:, 1] << (level - 1)) < bands[1])
            squares = squares[inside & (squares[:, 2] * (side // 2) < width)]
    for at in range(0, len(squares), 2048):
        i, j, c = squares[at:at + 2048].T
        gap = np.abs(grid_a[i, c][:, :, None, :] - grid_b[j, c][:, None, :, :]).sum(axis=3)
        np.add.at(out, (i, j), gap)
    whole = lambda x: x.swapaxes(1, 2).reshape(bands[0] * LEAF, bands[1] * LEAF)
    shape = (len(left_empty), len(right_empty))
    columns = np.repeat(np.repeat(free, LEAF, 0), LEAF, 1)[:shape[0], :shape[1]]
    return whole(out)[:shape[0], :shape[1]] + columns * np.abs(left_empty[:, None] - right_empty[None, :])


def _block_pairs(key: tuple, table: pa.Table) -> pa.Table:
    """Distances of one (lang, column block, pair of row blocks)."""
    first, second = key[2].as_py(), key[3].as_py()
    get = lambda name: table.column(name).to_numpy()
    column, block = get("column"), get("row_block")
    heads = column < 0
    width = int(get("width")[heads][0])

    def side(which: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = heads & (block == which)
        rows, place = np.unique(get("row")[own], return_index=True)
        empty = get("share")[own][place]
        cells = ~heads & (block == which)
        shares = np.zeros((len(rows), max(width, 1)), dtype=np.int64)
        shares[np.searchsorted(rows, get("row")[cells]), column[cells]] = get("share")[cells]
        return rows, empty, shares

    rows_a, empty_a, shares_a = side(first)
    rows_b, empty_b, shares_b = (rows_a, empty_a, shares_a) if first == second else side(second)
    if width:
        value = joint_distances(shares_a, shares_b, empty_a, empty_b, width)
    else:
        value = np.zeros((len(rows_a), len(rows_b)), dtype=np.int64)
    a, b = np.repeat(rows_a, len(rows_b)), np.tile(rows_b, len(rows_a))
    keep = a < b if first == second else np.ones(len(a), dtype=bool)
    return pa.table({"lang": pa.array([key[0].as_py()] * int(keep.sum()), pa.string()),
                     "a": a[keep], "b": b[keep], "value": value.reshape(-1)[keep]})


# -- the audit -------------------------------------------------------------------

def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _dense(df: DataFrame, by: str, item: str, block: int) -> DataFrame:
    """Add ``place`` (0, 1, ... per value of ``by`` in hash order of the
    item), counted inside hash slices so that no language is one task."""
    slices = 1 << 12
    rows = df.withColumns({"__h": F.xxhash64(item), "__slice": F.pmod(F.xxhash64(item), F.lit(slices))})
    sizes = rows.groupBy(by, "__slice").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.partitionBy(by).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__offset", F.coalesce(F.sum("__size").over(before), F.lit(0))).drop("__size")
    inside = Window.partitionBy(by, "__slice").orderBy("__h", item)
    return (rows.join(sizes, [by, "__slice"])
            .withColumn("place", F.col("__offset") + F.row_number().over(inside) - 1)
            .withColumns({f"{item}_block": F.expr(f"place div {block}"), f"{item}_place": F.expr(f"place % {block}").cast("int")})
            .drop("__h", "__slice", "__offset", "place"))


def pair_values(groups: DataFrame, cells: DataFrame, rows: int = ROWS, columns: int = COLUMNS) -> DataFrame:
    """lang, source, item, value of every ordered pair of sources.

    ``groups``: lang, source, empty (share of an unused term), width (kept
    terms of the language); ``cells``: lang, source, term, share of used
    kept terms.
    """
    groups = _stored(_dense(groups, "lang", "source", rows), "audit-groups").withColumn(
        "row", F.col("source_block") * rows + F.col("source_place"))
    terms = _dense(cells.select("lang", "term").distinct(), "lang", "term", columns)
    blocks = groups.groupBy("lang").agg(F.max("source_block").alias("last"))
    cells = (cells.join(terms, ["lang", "term"])
             .join(groups.select("lang", "source", "row", "source_block"), ["lang", "source"])
             .select("lang", F.col("term_block").alias("column_block"), F.col("source_block").alias("row_block"),
                     "row", F.col("term_place").alias("column"), "share", F.lit(0).cast("long").alias("width")))
    wide = F.least(F.lit(columns).cast("long"), F.col("width") - F.col("column_block") * columns)
    heads = (groups.withColumn("column_block", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.expr(f"(width - 1) div {columns}")))))
        .select("lang", "column_block", F.col("source_block").alias("row_block"), "row",
                F.lit(-1).alias("column"), F.col("empty").alias("share"), wide.alias("width")))
    both = heads.unionByName(cells).join(blocks, "lang").withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
    both = both.withColumns({"first": F.least("row_block", "other"), "second": F.greatest("row_block", "other")})
    found = (both.select("lang", "column_block", "first", "second", "row_block", "row", "column", "share", "width")
             .groupBy("lang", "column_block", "first", "second")
             .applyInArrow(_block_pairs, "lang string, a long, b long, value long"))
    sums = found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    names = groups.select("lang", "row", "source")
    named = (sums.join(names.select("lang", F.col("row").alias("a"), F.col("source").alias("one")), ["lang", "a"])
             .join(names.select("lang", F.col("row").alias("b"), F.col("source").alias("two")), ["lang", "b"]))
    both_ways = F.array(F.struct(F.col("one").alias("source"), F.col("two").alias("item")),
                        F.struct(F.col("two").alias("source"), F.col("one").alias("item")))
    return named.select("lang", "value", F.explode(both_ways).alias("p")).select("lang", "p.source", "p.item", "value")


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP_TERMS,
          rows: int = ROWS, columns: int = COLUMNS) -> DataFrame:
    """lang, source, part, item, value, rank of all pairs and the top terms."""
    counts = _stored(group_counts(docs), "audit-counts")
    terms = (counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("lang_docs"))
             .filter((F.col("lang_docs") >= least_documents) & (F.col("term") != "")).drop("lang_docs"))
    terms = _stored(terms, "audit-terms")
    langs = terms.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count(F.lit(1)).alias("width"))
    used = counts.filter("n > 0").join(terms, ["lang", "term"])
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = (counts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
              .join(langs, "lang", "left")
              .withColumns({c: F.coalesce(c, zero) for c in ("total", "lang_total", "width")}))
    groups = _stored(groups.withColumn("empty", F.when(F.col("width") > 0, share(
        zero, F.col("total"), F.col("width"))).otherwise(zero)), "audit-totals")
    cells = (used.join(groups.drop("empty"), ["lang", "source"])
             .select("lang", "source", "term", share(F.col("n"), F.col("total"), F.col("width")).alias("share"),
                     share(F.col("lang_n"), F.col("lang_total"), F.col("width")).alias("lang_share")))
    cells = _stored(cells, "audit-cells")
    pairs = pair_values(groups.select("lang", "source", "empty", "width"), cells.drop("lang_share"), rows, columns)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    ranked = lambda df, part: df.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    above = cells.filter("share > lang_share").select(
        "lang", "source", F.col("term").alias("item"), (F.col("share") - F.col("lang_share")).alias("value"))
    return ranked(pairs, "pair").unionByName(ranked(above, "term").filter(F.col("rank") <= top))
