"""NOT NULL and primary-key rules of the declared tables, as a data check.

Parquet and CSV do not enforce keys; this job reports what a database would
have rejected, with one scan and one shuffle of the counted keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_violations(df: DataFrame, table: str, key: list[str], not_null: list[str]) -> DataFrame:
    """One row per rule: (table_name, rule, violating_rows).

    ``not_null:<col>`` counts NULLs (key columns are NOT NULL too);
    ``unique:<cols>`` counts rows whose non-NULL key occurs more than once.
    """
    cols = list(dict.fromkeys([*not_null, *key]))
    others = [c for c in cols if c not in key]
    per_key = duplicate_counts(df, key, others)
    complete = F.lit(True)
    for c in key:
        complete = complete & F.col(c).isNotNull()

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0)).cast("long")

    rules = [(f"not_null:{c}", total(F.when(F.col(c).isNull(), F.col("rows"))) if c in key else total(f"_null_{c}"))
             for c in cols]
    rules.append(("unique:" + ",".join(key), total(F.when(complete & (F.col("rows") > 1), F.col("rows")))))
    sums = per_key.agg(*[c.alias(f"r{i}") for i, (_, c) in enumerate(rules)])
    return sums.select(F.explode(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), F.col(f"r{i}").alias("violating_rows"))
        for i, (rule, _) in enumerate(rules)])).alias("r")).select("r.*")


def duplicate_counts(df: DataFrame, key: list[str], others: list[str]) -> DataFrame:
    """Rows per key value (NULLs are values here), and NULLs of the other columns."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"),
                                *[F.sum(F.col(c).isNull().cast("long")).alias(f"_null_{c}") for c in others])


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return duplicate_counts(df, key, []).filter(F.col("rows") > 1)
