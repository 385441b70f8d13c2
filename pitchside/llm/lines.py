"""Line dedup: drop the lines that many documents share.

Native. Every line is reduced to a key (white space stripped at both ends,
A-Z lower-cased); the long keys are exploded, hashed to 128 bits and counted
by distinct document. The keys over the threshold, with the largest document
that holds each, are written once, so that their real size decides whether
the join back broadcasts them or shuffles (where adaptive execution splits a
hot line). The dropped positions are gathered per document and the rest of
its lines reassembled by position.

A line that a third of all documents hold is a third of the rows of the
first shuffle, which is dealt by line and document; the count by line alone
adds partial sums only.

Defined results: null or empty text is one empty line; a document is a
``doc_id``, so rows that share one count once for a key and all keep it if
theirs is the largest id; null ids are one document that sorts last; a key
that repeats inside a document counts once and all its lines share one fate;
a text that loses all its lines becomes empty; an empty table gives no rows;
extra columns are kept by ``dedup_stage`` and ignored by ``drop_common``.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchside.session import scratch_path

from .exprs import let
from .keys import KEY, by_document, doc_id_of, key_columns, keyed, with_arrays

LEAST_CHARS = 40
LEAST_DOCUMENTS = 5
BLANKS = " \t\n\x0b\x0c\r"
HASHES = ["line_hash", "line_check"]


def line_key(line: Column) -> Column:
    """The line without white space at its ends and with A-Z lower-cased."""
    solid = F.trim(line, F.lit(BLANKS))
    ascii_only = F.char_length(solid) == F.octet_length(solid)
    return F.when(ascii_only, F.lower(solid)).otherwise(
        F.translate(solid, string.ascii_uppercase, string.ascii_lowercase))


def long_lines(docs: DataFrame, least_chars: int) -> DataFrame:
    """doc_key, text_tag, position and hashes of every line whose key is long
    enough."""
    lines = keyed(docs).select(*KEY, F.posexplode(F.split("text", "\n")).alias("position", "line"))
    lines = lines.filter(F.octet_length("line") >= least_chars).withColumn("line", line_key(F.col("line")))
    return lines.filter(F.char_length("line") >= least_chars).select(
        *KEY, "position", *[F.xxhash64(F.lit(seed), F.col("line")).alias(name) for seed, name in enumerate(HASHES)])


def drop_common(docs: DataFrame, least_chars: int = LEAST_CHARS,
                least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """doc_key, text_tag, n_lines, n_dropped and kept (the text that stays)
    of every row."""
    spark = docs.sparkSession
    lines = long_lines(docs, least_chars)
    common = (lines.select(*HASHES, "doc_key").distinct().groupBy(*HASHES)
              .agg(F.count(F.lit(1)).alias("documents"), F.max("doc_key").alias("last"))
              .filter(F.col("documents") >= least_documents).drop("documents"))
    path = scratch_path(spark, "common-lines")
    common.write.parquet(path)
    common = spark.read.schema(common.schema).parquet(path)
    gone = by_document(
        lines.join(common, HASHES).filter("doc_key <> last").select(
            "doc_key", F.shiftleft("text_tag", 32).bitwiseOR(F.col("position")).alias("place")), "gone")
    rows = with_arrays(keyed(docs), gone)
    def rest(all_lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0).cast("long"), (F.size(all_lines) - 1).cast("long")), F.col("gone"))
        return F.array_join(F.transform(stay, lambda i: F.get(all_lines, i.cast("int"))), "\n")
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(let(F.split("text", "\n"), rest))
    return rows.select(
        *KEY, (F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size(F.array_distinct("gone")), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))


def digests(rows: DataFrame) -> DataFrame:
    return rows.select(doc_id_of(F.col("doc_key")).alias("doc_id"), "n_lines", "n_dropped",
                       F.sha2("kept", 256).alias("kept_sha256"))


def dedup_stage(docs: DataFrame, **limits) -> DataFrame:
    """The documents with the text that stays, one row per key; ``n_chars``
    follows. Null texts stay null."""
    key, tag = key_columns()
    own = docs.withColumns({"__doc_key": key, "__text_tag": tag}).dropDuplicates(["__doc_key", "__text_tag"])
    kept = drop_common(docs, **limits).dropDuplicates(KEY).select(
        F.col("doc_key").alias("__doc_key"), F.col("text_tag").alias("__text_tag"), F.col("kept").alias("__kept"),
        F.col("n_dropped").alias("__n_dropped"))
    out = own.join(kept, ["__doc_key", "__text_tag"])
    changed = F.col("__n_dropped") > 0
    out = out.withColumn("text", F.when(changed, F.col("__kept")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.char_length("__kept")).otherwise(F.col("n_chars"))
                             .cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
