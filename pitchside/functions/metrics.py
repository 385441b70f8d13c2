"""Aggregate and arithmetic building blocks used by every mart.

All of these are plain Column expressions, so they stay inside whole-stage
codegen and take part in partial (map-side) aggregation.

Exactness: a double ``sum``/``avg`` depends on the order rows arrive in,
which differs between partitions, runs and engines; the last bit then
flips ``round`` at ties (x.xx5). ``exact_sum`` adds without any rounding:
every double is cut into integer limbs of ``LIMB_BITS`` bits on a fixed grid
of exponents, the limbs are added as int64 (order independent, partial sums
merge), and the total is rounded to a double once. The grid reaches from
2^-128 to 2^63: all doubles from about 3e-23 to 9e18 are on it bit for bit.
A group with a value outside (or NaN, infinity) gets Spark's own sum.
A limb of a row is at most 2^23, so a group may have 2^40 rows; beyond that
its sum is Spark's own as well.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMB_BITS = 24
LIMB_EXPONENTS = [40 - LIMB_BITS * k for k in range(8)]  # 2^40 ... 2^-128
LIMBS = [f"l{k}" for k in range(len(LIMB_EXPONENTS))]


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def count_when(cond: Column) -> Column:
    """count(CASE WHEN cond THEN 1 END): a null condition counts as false."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def is_true(col: Column | str) -> Column:
    """``col = true`` for true-or-missing flags; null stays null (not counted)."""
    return _c(col) == F.lit(True)


def _limbs(x: Column) -> list[Column]:
    """Integers whose sum over 2^exponent is x: differences of x rounded to
    the grid of each exponent (scaling by powers of two and the differences
    are exact in binary). Off the grid they mean nothing and may be null."""
    at = [F.rint(x * F.lit(2.0 ** -e)) for e in LIMB_EXPONENTS]
    parts = at[:1] + [low - high * F.lit(2.0 ** LIMB_BITS) for high, low in zip(at, at[1:])]
    return [p.try_cast("bigint") for p in parts]


def _off_grid(x: Column) -> Column:
    finest = x * F.lit(2.0 ** -LIMB_EXPONENTS[-1])
    return ~((F.abs(x) < F.lit(2.0 ** 63)) & (F.rint(finest) == finest))


def sum_state(col: Column | str) -> Column:
    """Aggregate: the exact sum of a double column as a struct of integers
    that merges with others (``merge_states``) and is read by ``state_sum``
    and ``state_mean``. Nulls are ignored; ``n`` counts the values, ``off``
    those that are not on the grid and ``plain`` is the engine's own sum."""
    x = _c(col).cast("double")
    return F.struct(
        F.count(x).alias("n"), *[F.try_sum(p).alias(name) for name, p in zip(LIMBS, _limbs(x))],
        F.count_if(_off_grid(x)).alias("off"), F.sum(x).alias("plain"))


def merge_states(state: Column | str) -> Column:
    """Aggregate: the state of the union of the rows of several states."""
    s = _c(state)
    return F.struct(F.sum(s["n"]).alias("n"), *[F.try_sum(s[name]).alias(name) for name in LIMBS],
                    F.sum(s["off"]).alias("off"), F.sum(s["plain"]).alias("plain"))


def _two(k: int) -> Column:
    return F.lit(Decimal(1 << k))


def _rounded(s: Column) -> Column:
    """The double nearest to the total of the limbs.

    The limbs are put together to three decimals of whole numbers and
    carried, so that the total is a * 2^-8 + b * 2^-80 + c * 2^-128 with
    0 <= b < 2^72 and 0 <= c < 2^48. Of these at least 70 leading bits make
    one decimal, with a last bit that tells whether anything lies below; its
    cast to double is the one rounding.
    """
    limb = lambda k: s[LIMBS[k]].cast("decimal(38,0)")
    join = lambda k: limb(k) * _two(2 * LIMB_BITS) + limb(k + 1) * _two(LIMB_BITS) + limb(k + 2)
    whole = lambda c: c.cast("decimal(38,0)")
    let = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))

    def carry_low(t: Column) -> Column:
        c = whole(F.pmod(t["lo"], _two(48)))
        return F.struct(t["hi"].alias("hi"), (t["mid"] + whole((t["lo"] - c) / _two(48))).alias("mid"), c.alias("c"))

    def carry_mid(t: Column) -> Column:
        b = whole(F.pmod(t["mid"], _two(72)))
        return F.struct((t["hi"] + whole((t["mid"] - b) / _two(72))).alias("a"), b.alias("b"), t["c"].alias("c"))

    def value(t: Column) -> Column:
        a, b, c = t["a"], t["b"], t["c"]
        scaled = lambda n, e: n.cast("double") * F.lit(2.0 ** e)
        below = lambda rest: F.when(rest > 0, F.lit(Decimal(1))).otherwise(F.lit(Decimal(0)))
        rest = whole(F.pmod(b, _two(60)))
        far = a * _two(13) + whole((b - rest) / _two(60)) * _two(1) + below(rest + c)
        near = a * _two(73) + b * _two(1) + below(c)
        last = (b + F.when(a < 0, -_two(72)).otherwise(_two(0) - _two(0))) * _two(48) + c
        return (F.when(F.abs(a) >= _two(50), scaled(far, -21))
                .when((a == 0) | (a == -1), scaled(last, -128)).otherwise(scaled(near, -81)))

    parts = F.struct(join(0).alias("hi"), join(3).alias("mid"),
                     (limb(6) * _two(LIMB_BITS) + limb(7)).alias("lo"))
    return let(let(let(parts, carry_low), carry_mid), value)


def state_sum(state: Column | str) -> Column:
    """The sum of a state, rounded once (null on no values); with a value off
    the grid, or limbs beyond int64, the engine's own sum."""
    s = _c(state)
    exact = (s["off"] == 0) & s[LIMBS[0]].isNotNull()
    for name in LIMBS[1:]:
        exact = exact & s[name].isNotNull()
    return F.when(s["n"] > 0, F.when(exact, _rounded(s)).otherwise(s["plain"]))


def state_mean(state: Column | str) -> Column:
    s = _c(state)
    return state_sum(s) / F.when(s["n"] > 0, s["n"])


def exact_sum(col: Column | str) -> Column:
    """Order-independent sum of a double column, rounded once."""
    return state_sum(sum_state(col))


def exact_mean(col: Column | str) -> Column:
    """avg(col) with nulls ignored, from the exact sum (null on no values)."""
    return state_mean(sum_state(col))


def round_half(col: Column | str, digits: int) -> Column:
    """round(x, n) as x * 10^n rounded to an integer, divided back.

    ``F.round`` rounds the decimal text of a double (0.285 -> 0.29) while
    binary scaling gives 0.28; this form is the binary one and the same
    formula any SQL engine applies to a double.
    """
    p = F.lit(10.0 ** digits)
    return F.round(_c(col) * p, 0) / p


def safe_pct(part: Column | str, total: Column | str, digits: int = 1) -> Column:
    """CASE WHEN total > 0 THEN round(part * 100.0 / total, n) ELSE 0 END."""
    t = F.coalesce(_c(total), F.lit(0))
    return (F.when(t > 0, round_half(F.coalesce(_c(part), F.lit(0)) * F.lit(100.0) / t, digits))
             .otherwise(F.lit(0.0)))


def zero_if_null(col: Column | str, dtype: str = "bigint") -> Column:
    """coalesce(col, 0) keeping the column type."""
    return F.coalesce(_c(col), F.lit(0).cast(dtype))


def false_if_null(col: Column | str) -> Column:
    return F.coalesce(_c(col), F.lit(False))
