"""Column expressions shared by the native operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = "[ \\t-\\r]"  # ASCII space and control characters 9 to 13


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def jsd(p: Column, q: Column) -> Column:
    """Jensen-Shannon divergence (base 2) of two count arrays of one length;
    null if either is all zero."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    half = lambda x, m: F.when(x > 0, 0.5 * x * F.log2(x / m)).otherwise(0.0)
    def term(a: Column, b: Column) -> Column:
        return let((a + b) / 2, lambda m: half(a, m) + half(b, m))
    return F.when((total(p) > 0) & (total(q) > 0), F.aggregate(
        let(F.struct(total(p).alias("p"), total(q).alias("q")),
            lambda n: F.zip_with(p, q, lambda a, b: term(a / n["p"], b / n["q"]))),
        F.lit(0.0), lambda s, x: s + x))
