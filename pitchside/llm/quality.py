"""Quality rules: base counts and divergence from language references.

Native: one DataFrame projection per document, no Python on the executors.
A document passes if its base counts pass and its histogram of character
classes and of common words stays close (Jensen-Shannon divergence) to that
of all documents of its language. The references are sums over the whole
table, one row per value of ``lang``, which bounds their broadcast; the
common words of a language without an entry in ``COMMON_WORDS`` are its most
frequent words. Short documents are guarded:
a histogram is judged from a minimum number of words on, and its limit grows
with the sampling spread of few words.

Defined results: null text has no words and fails the base rules; documents
with a null language are compared with each other, whatever they hold; a
language of few documents is judged mildly, as they make its reference;
repeated rows are judged alike; extra columns
are kept by ``keep`` and ignored by ``judge``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .exprs import SPACE, jsd, let, words_of

# Frequent function words by language (fixed values).
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "was", "for", "with", "it", "be", "on", "as", "by", "this"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "ein"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "sur"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por", "con", "para", "una", "no"],
}
N_COMMON = max(len(v) for v in COMMON_WORDS.values())
NO_LANG = ""
MARKS = ".,;:!?"
NO_SPACE = "[^ \\t-\\r]"
WINDOW = 5
BASE_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# A verdict needs more than ``limit + spread / n_words``: a sample of n words
# of a clean text diverges by about the number of cells over n.
CLASS_LIMIT, CLASS_SPREAD, CLASS_MIN_WORDS = 0.03, 3.0, 10
WORD_LIMIT, WORD_SPREAD, WORD_MIN_WORDS = 0.02, 5.0, 60


def length(text: Column) -> Column:
    return F.char_length(text).cast("long")


def class_counts(solid: Column) -> Column:
    """Counts of lower-case letters, upper-case letters, digits, sentence
    marks and everything else in a text without white space."""
    def rest(r: Column) -> Column:
        part = lambda x, pattern: length(x) - length(F.regexp_replace(x, pattern, ""))
        upper, digit, mark = part(r, "\\p{Lu}+"), part(r, "\\p{N}+"), part(r, "[.,;:?'\"()-]+")
        return let(F.struct(upper.alias("u"), digit.alias("d"), mark.alias("m")),
                   lambda c: F.array(length(solid) - length(r), c["u"], c["d"], c["m"],
                                     length(r) - c["u"] - c["d"] - c["m"]))
    return let(F.regexp_replace(solid, "\\p{Ll}+", ""), rest)


def bare(word: Column) -> Column:
    return F.rtrim(F.lower(word), F.lit(MARKS))


def common_words(text: Column, common: Column) -> Column:
    """Every occurrence of a common word in a text, as found by ``bare``: one
    search for the words and the marks behind them, none is cut out."""
    quoted = F.transform(common, lambda c: F.regexp_replace(c, "([\\x21-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7E])", "\\\\$1"))
    search = F.concat(F.lit(SPACE + "("), F.array_join(quoted, "|"), F.lit(f")[{MARKS}]*+(?!{NO_SPACE})"))
    found = F.regexp_extract_all(F.concat(F.lit(" "), F.lower(text)), search, F.lit(1))
    return F.when(F.size(common) > 0, found).otherwise(F.array().cast("array<string>"))


def common_counts(text: Column, words: Column, common: Column) -> Column:
    """How often each common word occurs, and last all other words."""
    return let(common_words(text, common), lambda h: F.concat(
        F.transform(common, lambda c: (F.size(h) - F.size(F.array_remove(h, c))).cast("long")),
        F.array((F.size(words) - F.size(h)).cast("long"))))


def repeated_window_words(words: Column, window: int = WINDOW) -> Column:
    """Words covered by windows whose word sequence occurs twice or more.

    Windows are compared by a 64-bit hash of their word hashes. Only texts
    that repeat a window pay for the sort that finds where; the covered
    words follow from the distances of the flagged starts.
    """
    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        def starts(s: Column) -> Column:
            same = lambda x, at: F.coalesce(F.get(s, at)["h"] == x["h"], F.lit(False))
            flagged = F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1))
            return F.sort_array(F.transform(flagged, lambda x: x["i"]))
        def cover(at: Column) -> Column:
            step = F.transform(at, lambda x, i: F.least(
                F.lit(window), F.coalesce(F.get(at, i + 1) - x, F.lit(window))))
            return F.aggregate(step, F.lit(0).cast("long"), lambda s, x: s + x)
        return let(let(placed, starts), cover)

    hashes = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - window),
        lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)])))
    return F.when(F.size(words) < window, F.lit(0).cast("long")).otherwise(let(
        hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
        .otherwise(covered(h))))


def _with_text(docs: DataFrame) -> DataFrame:
    """Add the language, words and solid text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns({"__lang": F.coalesce(F.col("lang"), F.lit(NO_LANG)), "__text": text}).withColumns({
        "__words": words_of(F.col("__text")),
        "__solid": F.regexp_replace("__text", SPACE + "+", "")})


def _languages(docs: DataFrame) -> DataFrame:
    """Common words of every language: the fixed ones, or the most frequent
    words of its documents."""
    known = docs.sparkSession.createDataFrame(list(COMMON_WORDS.items()), "__lang string, __common array<string>")
    counted = (_with_text(docs).filter(~F.col("__lang").isin(list(COMMON_WORDS)))
               .select("__lang", F.explode("__words").alias("word")).withColumn("word", bare(F.col("word")))
               .filter("word != ''").groupBy("__lang", "word").agg(F.count(F.lit(1)).alias("n")))
    order = Window.partitionBy("__lang").orderBy(F.desc("n"), "word")
    top = counted.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= N_COMMON)
    found = top.groupBy("__lang").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("rank", "word"))), lambda x: x["word"]).alias("__common"))
    return known.unionByName(found)


def _histograms(docs: DataFrame, languages: DataFrame) -> DataFrame:
    return (_with_text(docs).join(F.broadcast(languages), "__lang", "left")
            .withColumn("__common", F.coalesce("__common", F.array().cast("array<string>")))
            .withColumns({"__classes": class_counts(F.col("__solid")),
                          "__commons": common_counts(F.col("__text"), F.col("__words"), F.col("__common"))}))


def references(docs: DataFrame) -> DataFrame:
    """Summed histograms of all documents, one row per language."""
    total = lambda name, n: F.array(*[
        F.coalesce(F.sum(F.get(F.col(name), F.lit(i))), F.lit(0)) for i in range(n)])
    sums = (_histograms(docs, _languages(docs)).groupBy("__lang", "__common")
            .agg(total("__classes", 5).alias("__ref_classes"), total("__commons", N_COMMON + 1).alias("__ref_commons")))
    return sums.select("__lang", "__common", "__ref_classes",
                       F.slice("__ref_commons", 1, F.size("__common") + 1).alias("__ref_commons"))


def judged(docs: DataFrame, class_limit: float = CLASS_LIMIT, class_spread: float = CLASS_SPREAD,
           class_min_words: int = CLASS_MIN_WORDS, word_limit: float = WORD_LIMIT,
           word_spread: float = WORD_SPREAD, word_min_words: int = WORD_MIN_WORDS) -> DataFrame:
    """The documents with base counts, both divergences and the verdict, all
    under names that start with ``__``."""
    refs = references(docs)
    text, words, solid = F.col("__text"), F.col("__words"), F.col("__solid")
    full_lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_replace(x, SPACE + "+", "") != "")
    counted = (_with_text(docs).join(F.broadcast(refs), "__lang", "left")
               .withColumns({
                   "__n_words": F.size(words).cast("long"),
                   "__word_chars": length(solid),
                   "__n_symbols": length(solid) - length(F.regexp_replace(solid, "[#*$%&|<>]+", "")),
                   "__n_dup_lines": let(full_lines, lambda x: (
                       F.size(x) - F.size(F.array_distinct(x))).cast("long")),
                   "__n_repeat_words": repeated_window_words(words),
                   "__classes": class_counts(solid),
                   "__commons": common_counts(text, words, F.col("__common"))}))
    counted = counted.withColumns({
        "__class_jsd": jsd(F.col("__classes"), F.col("__ref_classes")),
        "__word_jsd": jsd(F.col("__commons"), F.col("__ref_commons")),
        "__base_failed": (F.col("__n_words") < 10) | (100 * F.col("__n_repeat_words") > 20 * F.col("__n_words"))})
    n = F.col("__n_words")
    above = lambda name, limit, spread: F.coalesce(F.col(name), F.lit(0.0)) > limit + spread / n
    far = (((n >= class_min_words) & above("__class_jsd", class_limit, class_spread))
           | ((n >= word_min_words) & (F.size("__common") > 0)
              & above("__word_jsd", word_limit, word_spread)))
    return counted.withColumn("__kept", ~F.col("__base_failed") & ~far)


def judge(docs: DataFrame, **limits) -> DataFrame:
    """Counts, divergences and verdict of every document."""
    names = [*BASE_COUNTS, "base_failed", "class_jsd", "word_jsd", "kept"]
    return judged(docs, **limits).select("doc_id", *[F.col(f"__{n}").alias(n) for n in names])


def keep(docs: DataFrame, **limits) -> DataFrame:
    """The documents that pass, with their own columns."""
    return judged(docs, **limits).filter("__kept").select(*docs.columns)
