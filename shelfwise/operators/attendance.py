"""Hours worked from In/Out swipes.

The nth In of an employee is paired with their nth Out, as in the reference:
a stray Out shifts every later pair (and can make a negative stay), unpaired
swipes drop out, and a stay's whole days are not counted.  Swipes without a
time come last (NULLS LAST); as nothing but their number tells them apart,
they are counted per employee and action instead of being sorted.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.intervals import clipped, interval_hours
from ..functions.joins import DEFAULT_BROADCAST_ROWS
from ..functions.ordering import pg_asc
from .sequence import DEFAULT_SEGMENT_ROWS, number_in_sequence, split_sequences

KEYS = ["employee_id", "action"]
IN, OUT = "In", "Out"
# numbers of swipes without a time that one task makes rows of at once
_CHUNK = 100_000


def _ts(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def _pairing(log: DataFrame) -> DataFrame:
    """In and Out swipes of known employees; others never pair."""
    return log.select("employee_id", "action", "created_at").filter(
        F.col("employee_id").isNotNull() & F.col("action").isin(IN, OUT))


def _numbered(log: DataFrame, max_rows: int | None, broadcast_rows: int) -> tuple[DataFrame, bool]:
    """Swipes numbered (``rn``) per (employee, action) in time order, and whether those without a time
    were left out.

    One shuffle by employee serves the numbering and the pairing.  A log of
    more than ``max_rows`` swipes has its long sequences split instead, and
    swipes without a time, which no split can order, are left to be counted.
    """
    rows = _pairing(log)
    total = log.count() if max_rows else 0
    if max_rows and total > max_rows:
        timed = rows.filter(F.col("created_at").isNotNull())
        segments = split_sequences(timed, KEYS, "created_at", (), max_rows, broadcast_rows, row_bound=total)
        return number_in_sequence(timed, KEYS, "created_at", segments).select(*KEYS, "rn", "created_at"), True
    return number_in_sequence(rows.repartition("employee_id"), KEYS, "created_at"), False


def number_swipes(log: DataFrame, *, max_rows_per_segment: int | None = DEFAULT_SEGMENT_ROWS,
                  broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """In and Out swipes numbered per (employee, action) in time order, NULL times last."""
    numbered, split = _numbered(log, max_rows_per_segment, broadcast_rows)
    if not split:
        return numbered.select(*KEYS, "rn", "created_at")
    counts = _pairing(log).groupBy(*KEYS).agg(F.count("created_at").alias("_timed"),
                                              F.count(F.lit(1)).alias("_all"))
    chunks = (counts.filter("_all > _timed")
              .select(*KEYS, "_timed", "_all", F.explode(F.sequence(
                  F.col("_timed"), F.col("_all") - 1, F.lit(_CHUNK).cast("long"))).alias("_from"))
              .repartition(*KEYS, "_from"))
    untimed = chunks.select(*KEYS, F.explode(F.sequence(
        F.col("_from") + 1, F.least(F.col("_from") + _CHUNK, F.col("_all")))).alias("rn"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"))
    return numbered.unionByName(untimed)


def _met(numbered: DataFrame) -> DataFrame:
    """(employee_id, rn, swipe_in, swipe_out) of the numbers that both an In and an Out have.

    A conditional aggregation, so the numbering runs once.
    """
    is_in = F.col("action") == IN
    return (numbered.groupBy("employee_id", "rn")
            .agg(F.max(F.when(is_in, F.col("created_at"))).alias("swipe_in"),
                 F.max(F.when(~is_in, F.col("created_at"))).alias("swipe_out"),
                 F.count(F.lit(1)).alias("_sides"))
            .filter("_sides = 2").drop("_sides"))


def pair_swipes(log: DataFrame, **kw) -> DataFrame:
    """(employee_id, rn, in_action, swipe_in, out_action, swipe_out): nth In with nth Out."""
    return _met(number_swipes(log, **kw)).select(
        "employee_id", "rn", F.lit(IN).alias("in_action"), "swipe_in", F.lit(OUT).alias("out_action"), "swipe_out")


def _total_hours(log: DataFrame, hours: Column, untimed: Column, name: str, *,
                 max_rows_per_segment: int | None = DEFAULT_SEGMENT_ROWS,
                 broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Rounded sum of ``hours`` over the pairs of each employee that has any.

    ``untimed`` is what pairs with a missing time add up to.  Where swipes
    without a time were not numbered, they can only decide whether an employee
    has a pair at all, which having both actions tells.
    """
    numbered, split = _numbered(log, max_rows_per_segment, broadcast_rows)
    total = _met(numbered).groupBy("employee_id").agg(F.sum(hours).alias("_hours"))
    if split:
        some = _pairing(log).groupBy("employee_id").agg(
            F.max((F.col("action") == IN).cast("int")).alias("_in"),
            F.max((F.col("action") == OUT).cast("int")).alias("_out"),
            F.max(F.col("created_at").isNull().cast("int")).alias("_untimed"))
        rest = some.filter("_in = 1 and _out = 1 and _untimed = 1").select("employee_id", untimed.alias("_hours"))
        total = total.unionByName(rest).groupBy("employee_id").agg(F.sum("_hours").alias("_hours"))
    return total.select("employee_id", F.round("_hours", 2).alias(name)).orderBy(pg_asc("employee_id"))


def hours_worked(log: DataFrame, **kw) -> DataFrame:
    """Hours between paired swipes, summed per employee, rounded to 2 places."""
    h = interval_hours(F.col("swipe_out") - F.col("swipe_in"))
    return _total_hours(log, h, F.lit(None).cast("decimal(38,28)"), "total_hours", **kw)


def hours_in_window(log: DataFrame, start, end, **kw) -> DataFrame:
    """Hours of each pair inside [start, end], summed per employee; pairs outside count 0."""
    s, e = _ts(start), _ts(end)
    inside = (F.col("swipe_out") > s) & (F.col("swipe_in") < e)
    h = F.when(inside, interval_hours(clipped(F.col("swipe_out"), F.col("swipe_in"), s, e))) \
         .otherwise(F.lit(0))
    return _total_hours(log, h, F.lit(0).cast("decimal(38,28)"), "hours_in_window", **kw)


def attendance_log(log: DataFrame) -> DataFrame:
    """All swipes by employee and time."""
    return log.select("employee_id", "action", "created_at") \
              .orderBy(pg_asc("employee_id"), pg_asc("created_at"))
