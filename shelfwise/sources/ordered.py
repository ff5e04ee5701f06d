"""Tables stored in order: sorted once when written, read in that order without a sort.

The rows are range-partitioned by their sort columns, and every task writes
its range sorted; Spark numbers the files by range.  A reader takes the files
one after another, as a union: a scan of many files would deal them to tasks
by size.  So ``collect``, ``toLocalIterator``, ``limit`` and exports give the
order, and no reader shuffles or sorts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ordering import pg_asc
from ..session import list_names
from .tables import create_table_if_absent

# Most files of a table: a reader plans one scan for each.
MAX_FILES = 256


def write_ordered(df: DataFrame, path: str, by: Sequence[str], *, files: int | None = None) -> bool:
    """Write ``df`` sorted by the columns ``by`` (NULLs last) at ``path`` if nothing is there; whether it wrote.

    ``files``: the number of ranges, the session's shuffle partitions by
    default and at most MAX_FILES.  A range holds all rows of equal sort
    columns; rows that are equal there are in no set order.
    """
    spark = df.sparkSession
    ranges = min(files or int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_FILES)
    keys = [pg_asc(F.col(f"`{c}`")) for c in by]
    return create_table_if_absent(
        spark, lambda: df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys), path=path)


def read_ordered(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a table written by ``write_ordered``, in its order.

    A file that Spark splits is read in the order of its splits.
    """
    names = sorted(n for n in list_names(spark, path) if n.startswith("part-"))
    if not names:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionAll, [spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{n}") for n in names])


def with_position(df: DataFrame, name: str = "position") -> DataFrame:
    """Add each row's place (from 1) in the order of ``df``, which must be the same at every run (files are).

    Rows are counted per partition, so the only thing that meets in one task
    is a count for each partition; no row is shuffled.
    """
    tagged = df.withColumns({"__part": F.spark_partition_id(), "__id": F.monotonically_increasing_id()})
    counts = tagged.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    earlier = F.sum("__rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("__part", F.coalesce(earlier, F.lit(0)).alias("__earlier"))
    place = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("__earlier") + 1
    return tagged.join(F.broadcast(offsets), "__part").withColumn(name, place).drop("__part", "__id", "__earlier")
