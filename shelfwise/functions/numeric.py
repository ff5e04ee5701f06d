"""Exact decimal arithmetic matching PostgreSQL ``numeric`` where results depend on it.

Spark decimals are capped at 38 digits and shrink the scale of products and
quotients that would exceed it.  The casts below pick operand precisions so
that every product used by the insights build stays exact for all values of
the declared columns (``inventory`` is a 32-bit integer, prices have 8 whole
digits).

Means have the places that PostgreSQL's ``avg`` of integers gives: at least 16
significant digits, counted in base-10000 digits.  That is 16 places for most
means in [1, 10^4), 20 where sum and count have as many base-10000 digits and
the sum's first one is not the larger, and 4 fewer for each further factor of
10^4.  Estimated units are kept in two columns, their whole part and their
fraction, so that neither's range costs the other places.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# PostgreSQL's numerics have digits of base 10000, and a quotient 16 significant decimal digits.
_BASE_DIGITS, _SIGNIFICANT, _MOST_PLACES = 4, 16, 20

MEAN_TYPE = f"decimal(30,{_MOST_PLACES})"      # mean drop: 10 whole digits hold any 32-bit integer
WHOLE_TYPE = "decimal(28,0)"                   # whole part of summed estimated units
FRACTION_TYPE = f"decimal(37,{_MOST_PLACES})"  # sum of their fractions; one digit more would cost sums a place


def _power(places: Column, most: int) -> Column:
    """10 to the power of ``places`` (0 to ``most``), exact."""
    return F.get(F.array(*[F.lit(10 ** i).cast("decimal(21,0)") for i in range(most + 1)]), places)


def _base_digits(x: Column) -> tuple[Column, Column]:
    """Number of base-10000 digits after the first one of a positive 64-bit integer, and that first one."""
    after = sum(((x >= F.lit(10 ** (_BASE_DIGITS * i))).cast("int") for i in range(1, 5)), F.lit(0))
    return after, _div(x.cast("decimal(19,0)"), _power(after * _BASE_DIGITS, 16))


def _div(a: Column, b: Column) -> Column:
    """Whole quotient of two non-negative whole decimals, below 2^63."""
    return F.call_function("div", a, b)


def mean_places(total: Column, count: Column) -> Column:
    """Places of PostgreSQL's quotient of two positive 64-bit integers: 20, 16, 12, ... 0."""
    (w1, d1), (w2, d2) = _base_digits(total), _base_digits(count)
    places = _SIGNIFICANT - _BASE_DIGITS * (w1 - w2 - F.when(d1 <= d2, 1).otherwise(0))
    return F.greatest(places, F.lit(0))


def pg_mean(total: Column, count: Column) -> Column:
    """``total / count`` of integers (a total of at least ``count``) rounded half up to ``mean_places``.

    Long division in two steps, so that every product stays below 38 digits:
    ten places exactly, then what is left of them, rounded.  NULL when
    ``count`` is 0 or NULL.
    """
    n = F.when(count > 0, count).cast("decimal(19,0)")
    t, places = total.cast("decimal(19,0)"), mean_places(total, F.when(count > 0, count))
    first = F.least(places, F.lit(10))
    scaled = (t % n).cast("decimal(19,0)") * _power(first, 10)
    rest = F.when(places > 10, (scaled % n).cast("decimal(19,0)")).otherwise(F.lit(0))
    # up to ten places: the first step is rounded itself
    half = F.when(places > 10, F.lit(0).cast("decimal(19,0)")).otherwise(n)
    head = _div(scaled.cast("decimal(36,0)") * 2 + half, n * 2)
    tail = _div(rest.cast("decimal(19,0)") * _power(F.greatest(places - 10, F.lit(0)), 10).cast("decimal(11,0)") * 2 + n,
                n * 2)
    tail = F.when(places > 10, tail).otherwise(F.lit(0).cast("long"))
    whole = _div(t, n).cast("decimal(10,0)").cast(MEAN_TYPE)
    return (whole + _shift(head, first) + _shift(tail, places)).cast(MEAN_TYPE)


def _shift(x: Column, places: Column) -> Column:
    """x / 10^places for a whole x of at most 11 digits and 0 to 20 places, exact."""
    steps = F.array(*[F.lit("1" if i == 0 else "0." + "0" * (i - 1) + "1").cast("decimal(21,20)")
                      for i in range(_MOST_PLACES + 1)])
    return (x.cast("decimal(11,0)") * F.get(steps, places)).cast(MEAN_TYPE)


def units_contribution(n: Column, direct_sum: Column, rise_count: Column, mean: Column) -> tuple[Column, Column]:
    """n * (sum of direct drops + rise_count * mean), exact, as (whole part, rest).

    This is the sum of the per-record estimate over a set of records that share
    a fan-out factor ``n`` and a (store, sku) mean.  The mean is multiplied in
    its own two parts: (17,0) x (20,20) is the widest product that keeps 20 places.
    """
    k = (n.cast("decimal(19,0)") * rise_count.cast("decimal(19,0)")).cast("decimal(17,0)")
    m = F.coalesce(mean, F.lit(0).cast(MEAN_TYPE))
    whole = F.floor(m).cast("decimal(10,0)")
    frac = (m - whole).cast("decimal(20,20)")
    drops = (n.cast("decimal(19,0)") * direct_sum.cast("decimal(19,0)")).cast("decimal(27,0)")
    return (drops + k * whole).cast(WHOLE_TYPE), (k * frac).cast(FRACTION_TYPE)


def carried(whole: Column, rest: Column) -> tuple[Column, Column]:
    """The same number with its fraction below 1: decimal(28,0) and decimal(20,20)."""
    more = F.floor(rest).cast("decimal(17,0)")
    return (whole + more).cast(WHOLE_TYPE), (rest - more.cast(FRACTION_TYPE)).cast("decimal(20,20)")


def money(whole: Column, frac: Column, price: Column) -> Column:
    """ROUND((whole + frac) * price, 2) exactly, for ``carried`` units.

    whole * price has exactly 2 places, so the rounding only touches
    frac * price: decimal(28,0) x (10,2) and (20,20) x (10,2) -> (31,22) keep all places.
    """
    p = price.cast("decimal(10,2)")
    return (whole.cast("decimal(21,0)") * p + F.round(frac * p, 2)).cast("decimal(33,2)")


def ratio2(num: Column, den: Column) -> Column:
    """ROUND(num::float / den, 2) as PostgreSQL computes it (double ratio, then numeric round)."""
    return F.round(num.cast("double") / den.cast("double"), 2).cast("decimal(10,2)")


def div_round(num: Column, den: Column, places: int = 2) -> Column:
    """ROUND(num / den, places) for exact numerics; quotient carried at 18 places first."""
    q = num.cast("decimal(22,2)") / den.cast("decimal(16,0)")
    return F.round(q, places)


def avg_round(x: Column, places: int = 2) -> Column:
    """ROUND(AVG(x), places) for a narrow decimal: widen first so the mean keeps 16 places."""
    return F.round(F.avg(x.cast("decimal(24,12)")), places)
