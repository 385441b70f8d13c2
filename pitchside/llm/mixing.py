"""Mixing of sources to target weights by hierarchical budgeting.

The token budget flows down a tree of domains, languages and sources in
proportion to integer weights. A node can take at most ``max_epochs`` times
its tokens; what it cannot take goes to its siblings by their weights, and
only what no sibling can take goes back up to the siblings of its parent.
Both follow from sharing a budget among children by water-filling, with the
capacity of the whole subtree as each child's limit: children are ordered
by capacity per weight and window sums tell which are full. The tree has one
row per source and is never gathered.

A leaf then takes whole epochs of its documents while its budget lasts and,
of the next epoch, the documents in seeded order up to the last token of its
budget (the last document may be cut). The prefix sums are two-level, over
``BUCKETS`` slices of the hash order and within one slice, so a source with
a third of all rows is never one task.

Integers throughout: budgets are floored, so fewer tokens than there are
children may stay unassigned at each node. Defined results: null domain,
language or source form their own node named ''; null text has no tokens;
documents without tokens are never drawn; null ids sort last and ties of
the seeded order go by id, then text hash; rows that repeat id, text and
leaf are one document of the mix, and ``mix_stage`` returns one row of it
per epoch; an empty table gives an empty mix; extra columns are kept by the
stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .exprs import words_of
from .keys import KEY, doc_id_of, key_columns, with_arrays

LEVELS = ["domain", "lang", "source"]
# Targets of the query: weights of languages; nodes without a given weight weigh 1.
LANG_WEIGHTS = {"en": 4, "de": 2, "fr": 2, "es": 2}
MAX_EPOCHS = 4
SEED = 7
BUCKET_DIGITS = 3  # hex digits of the hash order: 4096 slices a leaf


def domain_of(source: Column) -> Column:
    """The letters a source name starts with."""
    return F.regexp_extract(F.coalesce(source, F.lit("")), "^[A-Za-z]*", 0)


def family_of(source: Column) -> Column:
    """The letters a source name starts with and the digit after them: the
    domain of a name like ``web12`` among web1, web10, web11, ..."""
    return F.regexp_extract(F.coalesce(source, F.lit("")), "^[A-Za-z]*[0-9]?", 0)


def word_tokens(text: Column) -> Column:
    return F.size(words_of(F.coalesce(text, F.lit("")))).cast("long")


def weighted(nodes: DataFrame, key: str, weights: dict[str, int] | None) -> DataFrame:
    """Add ``weight`` from a joined table of node names; others weigh 1."""
    if any(w < 1 for w in (weights or {}).values()):
        raise ValueError(f"weights of {key} must be 1 or more")
    table = nodes.sparkSession.createDataFrame(list((weights or {}).items()), f"{key} string, weight long")
    return nodes.join(F.broadcast(table), key, "left").withColumn("weight", F.coalesce("weight", F.lit(1).cast("long")))


def share(nodes: DataFrame, parent: list[str], key: str) -> DataFrame:
    """Split the column ``budget`` of each parent among its children, with
    ``weight`` and ``capacity``; gives ``granted``."""
    big = lambda c: F.col(c).cast("decimal(19,0)")
    order = Window.partitionBy(*parent).orderBy(F.col("capacity") / F.col("weight"), key)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = nodes.withColumns({
        "__full_before": F.coalesce(F.sum("capacity").over(before), F.lit(0)),
        "__weight_from": F.sum("weight").over(after)})
    rows = rows.withColumn("__full", big("capacity") * big("__weight_from")
                           <= (big("budget") - big("__full_before")) * big("weight"))
    whole = Window.partitionBy(*parent)
    rows = rows.withColumns({
        "__taken": F.sum(F.when(F.col("__full"), F.col("capacity")).otherwise(0)).over(whole),
        "__weights": F.sum(F.when(F.col("__full"), 0).otherwise(F.col("weight"))).over(whole)})
    part = F.expr("(cast(budget - __taken as decimal(19,0)) * cast(weight as decimal(19,0))) div __weights")
    return rows.withColumn("granted", F.when(F.col("__full"), F.col("capacity")).otherwise(part.cast("long")))


def budgets(leaves: DataFrame, lang_weights: dict[str, int], max_epochs: int, total: int | None,
            domain_weights: dict[str, int] | None = None, source_weights: dict[str, int] | None = None) -> DataFrame:
    """domain, lang, source, tokens, budget of every leaf."""
    leaves = leaves.filter("tokens > 0").withColumn("capacity", F.col("tokens") * max_epochs)
    langs = leaves.groupBy("domain", "lang").agg(F.sum("capacity").alias("capacity"))
    domains = langs.groupBy("domain").agg(F.sum("capacity").alias("capacity"))
    if total is None:  # one row
        domains = domains.join(F.broadcast(leaves.agg(F.sum("tokens").alias("budget"))))
    else:
        domains = domains.withColumn("budget", F.lit(total).cast("long"))
    domains = share(weighted(domains, "domain", domain_weights).withColumn("root", F.lit(0)), ["root"], "domain")
    langs = langs.join(domains.select("domain", F.col("granted").alias("budget")), "domain")
    langs = share(weighted(langs, "lang", lang_weights), ["domain"], "lang")
    leaves = leaves.join(langs.select("domain", "lang", F.col("granted").alias("budget")), ["domain", "lang"])
    leaves = share(weighted(leaves, "source", source_weights), ["domain", "lang"], "source")
    return leaves.select(*LEVELS, "tokens", F.col("granted").alias("budget"))


def mix(docs: DataFrame, total: int | None = None, lang_weights: dict[str, int] | None = None,
        max_epochs: int = MAX_EPOCHS, seed: int = SEED, domain: Column | None = None,
        tokens: Column | None = None, domain_weights: dict[str, int] | None = None,
        source_weights: dict[str, int] | None = None) -> DataFrame:
    """One row per drawn document and epoch: doc_key, text_tag, domain, lang,
    source, epoch, tokens (of the document) and taken (its first tokens).

    ``total`` is the budget in tokens, by default as many as there are.
    """
    key, tag = key_columns()
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(
        key.alias("doc_key"), tag.alias("text_tag"),
        (domain if domain is not None else domain_of(F.col("source"))).alias("domain"),
        text("lang").alias("lang"), text("source").alias("source"),
        (tokens if tokens is not None else word_tokens(F.col("text"))).alias("tokens"))
    # counted once: three aggregates read these light rows, none the texts
    rows = rows.dropDuplicates([*KEY, *LEVELS]).checkpoint()
    leaves = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    plan = budgets(leaves, LANG_WEIGHTS if lang_weights is None else lang_weights, max_epochs, total,
                   domain_weights, source_weights)
    plan = plan.select(*LEVELS, F.expr("budget div tokens").alias("whole"), F.expr("budget % tokens").alias("rest"))
    # the order only matters in the epoch that is cut
    placed = rows.filter("tokens > 0").join(plan, LEVELS).withColumn("place", F.md5(F.concat_ws(
        ":", F.lit(str(seed)), F.col("whole"), F.coalesce(doc_id_of(F.col("doc_key")).cast("string"), F.lit("null"))
    ).cast("binary"))).withColumn("slice", F.substring("place", 1, BUCKET_DIGITS))
    sums = placed.groupBy(*LEVELS, "slice").agg(F.sum("tokens").alias("slice_tokens"))
    offsets = sums.withColumn("offset", F.coalesce(F.sum("slice_tokens").over(
        Window.partitionBy(*LEVELS).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = Window.partitionBy(*LEVELS, "slice").orderBy("place", *KEY).rowsBetween(Window.unboundedPreceding, -1)
    drawn = (placed.join(offsets.drop("slice_tokens"), [*LEVELS, "slice"])
             .withColumn("start", F.col("offset") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
             .withColumn("part", F.greatest(F.lit(0), F.least("tokens", F.col("rest") - F.col("start")))))
    epochs = F.filter(F.transform(F.sequence(F.lit(0).cast("long"), F.col("whole")), lambda e: F.struct(
        e.cast("int").alias("epoch"), F.when(e < F.col("whole"), F.col("tokens")).otherwise(F.col("part")).alias("taken"))),
        lambda x: x["taken"] > 0)
    return drawn.select(*KEY, *LEVELS, "tokens", F.explode(epochs).alias("e")).select(
        *KEY, *LEVELS, "e.epoch", "tokens", "e.taken")


def mix_stage(docs: DataFrame, **options) -> DataFrame:
    """The drawn documents with their own columns, one row per epoch; a cut
    document keeps its first words, joined by one space, and ``n_chars``
    follows."""
    drawn = mix(docs, **options)
    key, tag = key_columns()
    domain = options.get("domain")
    leaf = {f"__{n}": c for n, c in zip(LEVELS, (domain if domain is not None else domain_of(F.col("source")), F.coalesce("lang", F.lit("")),
                                                 F.coalesce("source", F.lit(""))))}
    rows = docs.withColumns({"__doc_key": key, "__text_tag": tag, **leaf}).dropDuplicates(
        ["__doc_key", "__text_tag", *leaf])
    drawn = drawn.select(*[F.col(c).alias(f"__{c}") for c in drawn.columns])
    out = rows.join(drawn.hint("shuffle_hash"), ["__doc_key", "__text_tag", *leaf])
    cut = F.array_join(F.slice(words_of(F.col("text")), F.lit(1), F.col("__taken").cast("int")), " ")
    short = F.col("__taken") < F.col("__tokens")
    out = out.withColumn("text", F.when(short, cut).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(short, F.char_length("text")).otherwise(F.col("n_chars"))
                             .cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
