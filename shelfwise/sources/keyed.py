"""Loads that keep the declared keys of a table.

A database refuses rows whose key is NULL or already there.  Files cannot, so
a load checks them: accepted rows are committed to the table, the others to a
side table of rejects, with the rule they break.  The table's key stays unique
over all its loads.

A table is a folder with one sub-folder per load (``batch=<id>``), which gets
its name by one rename once all its rows are written: readers see a load whole
or not at all, and a load that is run again after a failure finds its folder
there and does nothing.  One process loads a table at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.joins import DEFAULT_BROADCAST_ROWS, sized_broadcast
from ..session import commit_folder, list_names, private_name, release, staging_dir
from . import schemas

BATCH, REASON, COPIES, SOURCE = "batch", "reason", "copies", "source_file"
NULL_KEY, IN_TABLE, IN_BATCH = "null in key", "key is in the table", "key repeats in the load"
# Distinct partition values of a load up to which the table's scan is restricted to them.
MAX_PRUNED_VALUES = 10_000


class KeyViolation(ValueError):
    """A strict load met rows that break a rule; nothing of it was committed."""


@dataclass(frozen=True)
class Rules:
    """Declared columns, key and NOT NULL columns of a table, and the column its loads are partitioned by."""
    schema: T.StructType
    key: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    partition: T.StructField | None = None

    def table_schema(self) -> T.StructType:
        part = [self.partition] if self.partition else []
        return T.StructType([*self.schema.fields, T.StructField(BATCH, T.StringType()), *part])

    def reject_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(SOURCE, T.StringType()),
                             T.StructField(REASON, T.StringType()), T.StructField(COPIES, T.LongType()),
                             T.StructField(BATCH, T.StringType())])


SNAPSHOTS = Rules(schemas.SNAPSHOT_SCHEMA, tuple(schemas.SNAPSHOT_KEY), tuple(schemas.SNAPSHOT_NOT_NULL),
                  T.StructField("snapshot_date", T.DateType()))
CATEGORIES = Rules(schemas.CATEGORY_SCHEMA, tuple(schemas.CATEGORY_KEY))
STORE_CITY = Rules(schemas.STORE_CITY_SCHEMA, tuple(schemas.STORE_CITY_KEY))


def with_partition(rows: DataFrame, rules: Rules) -> DataFrame:
    """Snapshots get the date they are stored under; other tables have none."""
    return rows.withColumn(rules.partition.name, F.to_date("created_at")) if rules.partition else rows


def rejects_path(path: str) -> str:
    return f"{path.rstrip('/')}-rejects"


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not any(n.startswith(f"{BATCH}=") for n in list_names(spark, path)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_table(spark: SparkSession, path: str, rules: Rules) -> DataFrame:
    """All committed rows, with the load they came in; empty if there is no load yet."""
    return _read(spark, path, rules.table_schema())


def read_rejects(spark: SparkSession, path: str, rules: Rules) -> DataFrame:
    """The refused rows of the table at ``path``: each distinct row once, with its number of copies, the rule
    it breaks, (one of) the file(s) it came in and its load."""
    return _read(spark, rejects_path(path), rules.reject_schema())


def _complete(columns) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull()
    return out


def _known_keys(rows: DataFrame, path: str, rules: Rules) -> DataFrame | None:
    """Keys of the table in the partitions that the rows belong to; None if the table has no rows there."""
    table = read_table(rows.sparkSession, path, rules)
    if rules.partition:
        name = rules.partition.name
        values = [r[0] for r in rows.select(name).distinct().limit(MAX_PRUNED_VALUES + 1).collect()]
        if len(values) <= MAX_PRUNED_VALUES:
            table = table.filter(F.col(name).isin([v for v in values if v is not None]))
    return None if table.isEmpty() else table.select(*rules.key)


def load(rows: DataFrame, path: str, rules: Rules, batch: str, *, source: Column | None = None,
         strict: bool = False, broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> dict[str, int] | None:
    """Commit ``rows`` as load ``batch`` of the table at ``path``; returns accepted and rejected row counts, or
    None if that load is there already.

    ``rows`` has the declared columns, and the partition column if there is
    one.  Of rows that share a key which is new to the table, the one that
    sorts first by its other columns (NULL first) is accepted.  ``source``
    tells where a row came from.  ``strict``: any violation is a KeyViolation
    and nothing is committed, as one COPY of all rows would end.

    The rows are written to the staging folder first, so that files are parsed
    once.  A load without violations shuffles its keys (counted per task
    first) and, against the table's keys of the same partitions, once more;
    whole rows are only shuffled where their key is violated.
    """
    spark = rows.sparkSession
    if f"{BATCH}={batch}" in list_names(spark, path):
        return None
    names, key = rules.schema.fieldNames(), list(rules.key)
    part = [rules.partition.name] if rules.partition else []
    stage = f"{staging_dir(spark)}/keyed/{uuid.uuid4().hex}"
    made, made_rejects = private_name(f"{path.rstrip('/')}/load"), private_name(f"{rejects_path(path)}/load")
    try:
        rows.select(*names, *part, (F.lit(None).cast("string") if source is None else source).alias(SOURCE)) \
            .write.parquet(f"{stage}/rows")
        rows = spark.read.parquet(f"{stage}/rows")
        complete = _complete(dict.fromkeys([*key, *rules.not_null]))
        ok = rows.filter(complete)

        counted = ok.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
        there = _known_keys(ok, path, rules)
        known = F.lit(False)
        if there is not None:
            counted = counted.join(there.withColumn("_there", F.lit(True)), key, "left")
            known = F.coalesce("_there", F.lit(False))
        counted.select(*key, known.alias("_known"), "_n").filter("_known or _n > 1").write.parquet(f"{stage}/offenders")
        offenders = spark.read.parquet(f"{stage}/offenders")

        others = [c for c in [*names, *part] if c not in key]
        at_fault = sized_broadcast(offenders, broadcast_rows)
        clean = ok.drop(SOURCE).join(at_fault.select(*key), key, "left_anti")
        # equal rows are counted, not kept apart; NULLs are values here
        suspects = ok.join(at_fault, key).groupBy(*names, *part, "_known").agg(
            F.count(F.lit(1)).alias(COPIES), F.min(SOURCE).alias(SOURCE))
        firsts = suspects.filter("not _known").groupBy(*key).agg(F.min(F.struct(*others)).alias("_first"))
        admitted = clean.select(*names, *part).unionByName(firsts.select(*key, "_first.*").select(*names, *part))
        # as in the build: evenly sized tasks per partition value, not a file of every value from every task
        (admitted.hint("rebalance", *part).write.partitionBy(*part) if part else admitted.write).parquet(made)

        judged = suspects.join(firsts, key, "left").withColumn(
            COPIES, F.col(COPIES) - F.when(F.col("_first").isNotNull() & (F.struct(*others).eqNullSafe(F.col("_first"))),
                                           1).otherwise(0)).filter(F.col(COPIES) > 0)
        nulls = rows.filter(~complete).groupBy(*names).agg(F.count(F.lit(1)).alias(COPIES), F.min(SOURCE).alias(SOURCE))
        rejected = judged.select(*names, SOURCE, F.when(F.col("_known"), IN_TABLE).otherwise(IN_BATCH).alias(REASON),
                                 COPIES).unionByName(nulls.select(*names, SOURCE, F.lit(NULL_KEY).alias(REASON), COPIES))
        rejected.write.parquet(made_rejects)
        refused = spark.read.parquet(made_rejects).agg(F.coalesce(F.sum(COPIES), F.lit(0))).first()[0]
        total = rows.count()
        if strict and refused:
            raise KeyViolation(f"{refused} of {total} rows break a rule of {path}; nothing was loaded")
        # rejects first: a load that is there has its rejects there too
        commit_folder(spark, made_rejects, f"{rejects_path(path)}/{BATCH}={batch}")
        if not commit_folder(spark, made, f"{path.rstrip('/')}/{BATCH}={batch}"):
            return None
        return {"accepted": total - refused, "rejected": refused}
    finally:
        for folder in (stage, made, made_rejects):
            release(spark, folder)
