"""Row keys shared by the operators that send positions back to texts.

A document is known by ``doc_key`` (its doc_id; null ids sort last) and
``text_tag`` (31 hash bits of its text). Rows that repeat both id and text
are one document for matching purposes and all get the same result; rows
that share an id with different texts stay apart through the tag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAST = (1 << 63) - 1
KEY = ["doc_key", "text_tag"]
LOW = (1 << 32) - 1


def key_columns(id_col: str = "doc_id", text_col: str = "text") -> tuple[Column, Column]:
    """The two key columns as expressions."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)),
            F.xxhash64(text).bitwiseAND((1 << 31) - 1))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_key``, ``text_tag`` and the text (null: empty) of every row."""
    key, tag = key_columns(id_col, text_col)
    return docs.select(key.alias("doc_key"), tag.alias("text_tag"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def tag_of(place: Column) -> Column:
    """The text tag in a place (tag in the high half, position in the low)."""
    return F.shiftright(place, 32)


def position_of(place: Column) -> Column:
    return place.bitwiseAND(LOW)


def doc_id_of(key: Column) -> Column:
    return F.when(key != LAST, key)


def by_document(places: DataFrame, name: str) -> DataFrame:
    """Gather (doc_key, place) rows to one sorted array per document; its
    length is bounded by the document's own."""
    return (places.select("doc_key", tag_of(F.col("place")).alias("text_tag"),
                          position_of(F.col("place")).alias("position"))
            .groupBy(*KEY).agg(F.collect_list("position").alias(name)))


def with_arrays(docs: DataFrame, *arrays: DataFrame) -> DataFrame:
    """Left-join per-document arrays to the texts. The arrays are the build
    side, so the texts are hashed to partitions once and never sorted; the
    exchange of the texts is the same in every use and Spark reuses it."""
    for extra in arrays:
        docs = docs.join(extra.hint("shuffle_hash"), KEY, "left")
    return docs
