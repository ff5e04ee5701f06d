"""Materialising derived tables (CREATE TABLE IF NOT EXISTS ... AS)."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..session import commit_folder, list_names, private_name, release, remove_if_empty

# What a write that died before its commit may leave in a folder.
_UNCOMMITTED = {"_temporary"}


def create_table_if_absent(spark: SparkSession, build: Callable[[], DataFrame], *, table: str | None = None,
                           path: str | None = None, partition_by: list[str] | None = None) -> bool:
    """Build and write a table once; a later call leaves the first rows in place and builds nothing.

    Exactly one of ``table`` (metastore table, Parquet) or ``path`` (Parquet
    directory, e.g. under the cluster's shared warehouse).

    A path is written whole into a folder of its own beside it, which gets the
    name by one rename.  So the path never shows a part of the table, and of
    callers that all found it absent one wins; the others delete what they
    made.  A path counts as present if a write was committed there (Spark's
    ``_SUCCESS`` marker).  One that holds nothing, or only what an uncommitted
    write left, is absent; any other folder without the marker may be
    someone's data and is an error, never overwritten.  The rename is atomic
    on file systems that rename folders (HDFS, local), not on object stores.

    No global sort on write: readers sort.  Returns True if it wrote.
    """
    if (table is None) == (path is None):
        raise ValueError("give exactly one of table= or path=")
    if table is not None:
        if spark.catalog.tableExists(table):
            return False
        try:
            _writer(build(), partition_by, "ignore").saveAsTable(table)
        except (AnalysisException, Py4JJavaError):
            if spark.catalog.tableExists(table):         # another caller's, made meanwhile
                return False
            raise
        return True
    if _present(spark, path):
        return False
    made = private_name(path)
    try:
        _writer(build(), partition_by, "errorifexists").save(made)
        if not _present(spark, path):
            remove_if_empty(spark, path, _UNCOMMITTED)
        return commit_folder(spark, made, path)
    finally:
        release(spark, made)


def _writer(df: DataFrame, partition_by: list[str] | None, mode: str):
    w = df.write.mode(mode).format("parquet")
    return w.partitionBy(*partition_by) if partition_by else w


def _present(spark: SparkSession, path: str) -> bool:
    names = set(list_names(spark, path))
    if "_SUCCESS" in names:
        return True
    if names - _UNCOMMITTED:
        raise FileExistsError(f"{path} holds files but no committed table; remove them or choose another path")
    return False
