"""Hours of a timestamp difference, the way the reference's attendance queries count them.

``EXTRACT(HOUR|MINUTE|SECOND FROM out - in)`` keeps only the time-of-day part
of the interval (whole days are dropped, the sign is kept).  The reference
then adds ``hour + minute / 60.0 + second / 3600.0`` in PostgreSQL numeric,
where each quotient is rounded half-up to a scale that depends on the size of
the dividend.  Reproducing those scales makes sums that land on x.xx5 round
the same way the reference does (see FIXTURES.md, E005).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# PostgreSQL numeric division scales for the dividends here.
# minute / 60.0 -> 20 places.  second / 3600.0 -> 20 places, except for
# |second| < 1 whose first base-10000 digit is <= 3600 (24 places) and
# |second| < 0.0001 whose next digit is <= 3600 (28 places).
_TERM = "decimal(29,28)"


def _extract(field: str, iv: Column) -> Column:
    return F.extract(F.lit(field), iv)


def interval_hours(iv: Column) -> Column:
    """hour + minute/60.0 + second/3600.0 of a day-time interval, decimal(31,28)."""
    h = _extract("HOUR", iv).cast("decimal(2,0)")
    m = _extract("MINUTE", iv).cast("decimal(22,20)")
    s = _extract("SECOND", iv)                         # decimal(8,6), signed
    m_term = (m / F.lit(60).cast("decimal(2,0)")).cast("decimal(21,20)")
    q = s.cast("decimal(30,28)") / F.lit(3600).cast("decimal(4,0)")
    a = F.abs(s)
    first = F.floor(a * 10000)                         # first base-10000 fractional digit
    second = F.floor(a * 100000000) - first * 10000    # the next one
    s_term = (F.when((a >= 1) | (first > 3600), q.cast("decimal(21,20)"))
               .when(first > 0, q.cast("decimal(25,24)"))
               .when(second > 3600, q.cast("decimal(25,24)"))
               .otherwise(q.cast(_TERM)))
    return h + m_term + s_term


def clipped(out_col: Column, in_col: Column, start: Column, end: Column) -> Column:
    """Interval of [in, out] clipped to [start, end] (may be negative, as in the reference)."""
    return F.least(out_col, end) - F.greatest(in_col, start)
