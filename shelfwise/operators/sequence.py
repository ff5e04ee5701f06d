"""LEAD and ROW_NUMBER over long ordered sequences, split so no task holds a hot key.

A plain ``lead(x).over(Window.partitionBy(keys).orderBy(t))`` puts every row
of a key into one task.  That is right for ordinary keys.  Where a key holds
many rows, its sequence is cut into *segments* at *boundary rows*:

* boundaries come from a sample: every so many sampled rows of a key, in time
  order, one is a boundary, so that a segment holds about the row threshold.
  Keys with fewer rows have none.  No pass counts keys, and which rows are
  sampled changes where sequences are cut, never a result;
* a row's segment is the number of its key's boundaries at or before its time,
  found by binary search in the key's list of them, which is joined (by
  broadcast if its size allows);
* the window runs per (key, segment): one shuffle of the rows;
* LEAD: a boundary row is the first of its segment, so it is what the last row
  of the segment before it needs.  The list of boundaries carries its values,
  and no further pass, shuffle or join is needed;
* ROW_NUMBER: the rows of earlier segments are added, from prefix sums over
  the counts of the segments, which are counted per task first.

Results are identical to the single-window form.  Keys and order columns must
be non-NULL.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import DEFAULT_BROADCAST_ROWS, sized_broadcast
from ..functions.ordering import pg_asc
from ..session import staging_dir

SEGMENT, CUTS = "__segment", "__cuts"
# Rows one key may have before it is split.
DEFAULT_SEGMENT_ROWS = 2_000_000
# Sampled rows per segment: its size is off by about an eighth.
SAMPLED_PER_SEGMENT = 64
SAMPLE_SEED = 17


@dataclass(frozen=True)
class Segments:
    """Rows with ``SEGMENT`` and ``CUTS`` (their key's boundaries; NULL for keys that are not split)."""
    rows: DataFrame


def boundaries(df: DataFrame, keys: list[str], order_col: str, values: Sequence[str], max_rows: int) -> DataFrame:
    """(keys, cuts): the boundary rows (order column, values) of each key with more than about ``max_rows`` rows,
    in order.

    One scan of these columns and one shuffle of the sampled rows: at most
    SAMPLED_PER_SEGMENT for every ``max_rows``.
    """
    rate = min(1.0, SAMPLED_PER_SEGMENT / max_rows)
    step = max(1, round(max_rows * rate))
    sample = df.select(*keys, order_col, *values)
    sample = sample.sample(rate, SAMPLE_SEED) if rate < 1 else sample
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(order_col)) - 1
    chosen = sample.withColumn("_nth", nth).filter((F.col("_nth") > 0) & (F.col("_nth") % step == 0))
    # rows of one time belong to one segment: the first stands for all
    per_time = F.struct(F.col(order_col).alias("at"), *[F.col(v) for v in values])
    return chosen.groupBy(*keys).agg(F.array_sort(F.collect_list(per_time)).alias(CUTS))


def _segment_of(at: Column, cuts: Column) -> Column:
    """Number of boundaries at or before ``at``, by binary search: halving steps over the sorted list."""
    size = F.size(cuts)
    steps = F.sequence(F.floor(F.log2(size.cast("double"))).cast("int"), F.lit(0), F.lit(-1))

    def step(found, power):
        reach = found + F.call_function("shiftleft", F.lit(1), power)
        return F.when((reach <= size) & (F.get(cuts, reach - 1)["at"] <= at), reach).otherwise(found)

    return F.when(cuts.isNull() | (size == 0), 0).otherwise(F.aggregate(steps, F.lit(0), step))


def split_sequences(df: DataFrame, keys: list[str], order_col: str, values: Sequence[str] = (),
                    max_rows: int | None = DEFAULT_SEGMENT_ROWS, broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                    row_bound: int | None = None, source: DataFrame | None = None) -> Segments | None:
    """``df`` with its long sequences cut into segments of about ``max_rows`` rows; None if the whole input is
    not larger than that.

    ``row_bound`` is an upper bound on the rows of ``df`` (e.g. the unfiltered
    source table's count, which Parquet answers from footers); without it they
    are counted.  ``values`` are the columns LEAD will need.  ``source`` has
    all rows of each key of ``df`` too, and is cheaper to sample.  The
    boundaries are written to the staging folder: sampled once, however often
    the rows are read or a task is run again.
    """
    if not max_rows or (row_bound if row_bound is not None else df.count()) <= max_rows:
        return None
    path = f"{staging_dir(df.sparkSession)}/boundaries/{uuid.uuid4().hex}"
    boundaries(df if source is None else source, keys, order_col, values, max_rows).write.parquet(path)
    cuts = sized_broadcast(df.sparkSession.read.parquet(path), broadcast_rows)
    return Segments(df.join(cuts, keys, "left").withColumn(SEGMENT, _segment_of(F.col(order_col), F.col(CUTS))))


def lead_in_sequence(df: DataFrame, keys: list[str], order_col: str, values: list[str],
                     segments: Segments | None = None, prefix: str = "next_") -> DataFrame:
    """Add ``{prefix}{order_col}`` and ``{prefix}{v}`` = LEAD over (keys ORDER BY order_col).

    ``order_col`` must be non-NULL and unique within a key (it is the table's
    key together with ``keys``).  With ``segments`` (of ``df``, made for these
    values) the result keeps ``SEGMENT``.
    """
    part = keys if segments is None else [*keys, SEGMENT]
    out = df if segments is None else segments.rows
    w = Window.partitionBy(*part).orderBy(order_col)
    if segments is None:
        for c in (order_col, *values):
            out = out.withColumn(f"{prefix}{c}", F.lead(c).over(w))
        return out
    # the segment's last row: its successor is the boundary row that begins the next segment
    following = F.lead(F.struct(F.col(order_col).alias("at"), *[F.col(v) for v in values])).over(w)
    out = out.withColumn("_next", F.coalesce(following, F.get(F.col(CUTS), F.col(SEGMENT)))).drop(CUTS)
    for c, field in ((order_col, "at"), *((v, v) for v in values)):
        out = out.withColumn(f"{prefix}{c}", F.col(f"_next.{field}"))
    return out.drop("_next")


def number_in_sequence(df: DataFrame, keys: list[str], order_col: str, segments: Segments | None = None,
                       name: str = "rn") -> DataFrame:
    """Add ``name`` = ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order_col ASC NULLS LAST).

    NULLs are allowed without segments only.  With them the number is the
    row's place in its segment plus the rows of all earlier segments of its key.
    """
    if segments is None:
        return df.withColumn(name, F.row_number().over(
            Window.partitionBy(*keys).orderBy(pg_asc(order_col))).cast("long"))
    part = [*keys, SEGMENT]
    # only rows of split keys have something before their segment
    sizes = segments.rows.filter(F.col(CUTS).isNotNull()).groupBy(*part).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    earlier = sizes.select(*part, F.sum("_n").over(before).alias("_earlier"))
    place = F.row_number().over(Window.partitionBy(*part).orderBy(order_col))
    return (segments.rows.drop(CUTS).withColumn("_place", place).join(earlier, part, "left")
            .withColumn(name, (F.coalesce("_earlier", F.lit(0)) + F.col("_place")).cast("long"))
            .drop("_earlier", "_place", SEGMENT))
