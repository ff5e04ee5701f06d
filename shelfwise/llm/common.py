"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import release, ship_package, staging_dir

# Fixed value: the word pattern of the license, toxicity and benchmark operators.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# str.translate table that lower-cases A-Z and nothing else
LOWER_TABLE = str.maketrans(UPPER, LOWER)


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_scratch: list[list[str]] = []     # tables written inside each open scratch_tables


def write_table(df: DataFrame, name: str, *, keep: bool = False) -> str:
    """Write ``df`` as Parquet to the shared folder; returns its path.  ``keep``: scratch_tables leaves it."""
    path = f"{staging_dir(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _scratch and not keep:
        _scratch[-1].append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the
    lineage, so a lost executor never sends a job back behind this point."""
    return df.sparkSession.read.schema(df.schema).parquet(write_table(df, name))


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted at the end, when what was made of them must be written too."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            release(spark, path)


# rows per Arrow batch: texts are long, and a batch is held several times on its way to Python and back
ARROW_ROWS = 1000


def short_batches(df: DataFrame) -> DataFrame:
    """Get the session ready for operators that hand texts to Python: Arrow batches of at most ARROW_ROWS
    rows, and this package on the workers."""
    ship_package(df.sparkSession)
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= ARROW_ROWS:
        conf.set(key, str(ARROW_ROWS))
    return df


def few_rows(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut down, so that what a task makes of one at a time stays small."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)
