"""Join helpers with an explicit size check before broadcasting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows and bytes a dimension may have and still be shipped to every executor.
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 128 << 20
# bytes counted for a column, and for each element of a list
_FIXED_WIDTH, _ELEMENT_WIDTH = 16, 48


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                    max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows and ``max_bytes`` bytes.

    Both are counted by one distributed job on that side (partial sums per
    task): 16 bytes a column, with the UTF-8 length of texts and 48 bytes an
    element of lists.  If the side is larger, it is returned unhinted: the
    join becomes a shuffle join, and AQE may still convert it from runtime
    statistics.
    """
    if max_rows <= 0:
        return df
    varying = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema.fields
               if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    varying += [F.coalesce(F.size(F.col(f"`{f.name}`")), F.lit(0)) * _ELEMENT_WIDTH for f in df.schema.fields
                if isinstance(f.dataType, (T.ArrayType, T.MapType))]
    width = sum(varying, F.lit(_FIXED_WIDTH * len(df.columns))).cast("long")
    size = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if size.rows <= max_rows and size.bytes <= max_bytes else df
