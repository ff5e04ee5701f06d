"""PostgreSQL sort semantics on Spark columns.

PostgreSQL sorts NULL as the largest value: last under ASC, first under DESC.
Spark's defaults are the opposite, and the difference changes which rows a
LIMIT keeps, so every sort in this package goes through these helpers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pg_asc(c) -> Column:
    return _col(c).asc_nulls_last()


def pg_desc(c) -> Column:
    return _col(c).desc_nulls_first()
