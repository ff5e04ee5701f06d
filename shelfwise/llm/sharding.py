"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns ``virtual_nodes`` points of the ring.  A document belongs to
the next virtual node clockwise of its key's point (the key is its text, so
equal texts start together); where that shard is full it continues clockwise
to the next one that is not.  The bound on a shard's load is its share of the
rows: ``n // shards``, one more for the first ``n % shards`` shards.  The
bounds add up to n, so every shard ends exactly full and row counts are at
most one apart; only overflow moves away from its place on the ring.

Native: the ring, the loads and the placement are DataFrame aggregations and
joins.  Rows are counted per *cell* of the ring (a point, or a slice of a
point by doc_id hash where the point holds more than ``n / cells`` rows), so
no cell is larger than about ``n / cells`` rows even if one text is a third of
the input.  Those counts, at most ``points + cells`` of them whatever the
input, are all that the driver sees: walking them clockwise gives each cell's
shard intervals, and a row finds its shard and slot by its rank in its cell.

Cases: null text counts as empty and has size 8; null doc_ids are placed like
others; repeated rows each get a slot of their own; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

POINTS = 1 << 14
VIRTUAL_NODES = 128
CELLS = 4096
ROW_OVERHEAD = 8      # bytes a row takes besides its text


def _point(c: Column, points: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(points)).cast("int")


def ring(spark: SparkSession, shards: int, virtual_nodes: int = VIRTUAL_NODES,
         points: int = POINTS) -> list[tuple[int, int]]:
    """(point, shard) of every virtual node in ring order: shards * virtual_nodes rows."""
    nodes = spark.range(shards * virtual_nodes).select(
        (F.col("id") % shards).cast("int").alias("shard"),
        _point(F.concat_ws(":", F.lit("node"), F.col("id") % shards,
                           F.floor(F.col("id") / shards)), points).alias("point"))
    return sorted((r.point, r.shard) for r in nodes.collect())


def place(cells: list[tuple[int, int, int]], nodes: list[tuple[int, int]], capacity: list[int]
          ) -> list[tuple[int, int, int, int, int, int]]:
    """Walk the cells (point, slice, rows) clockwise and fill the shards up to their capacity.

    Returns (point, slice, from_rank, to_rank, shard, first_slot); ranks from 0,
    ``to_rank`` exclusive.  A full shard's virtual nodes are skipped from then on.
    """
    after = list(range(1, len(nodes))) + [0]
    free, used = list(capacity), [0] * len(capacity)

    def open_node(i: int) -> int:
        path = []
        while not free[nodes[i][1]]:
            path.append(i)
            i = after[i]
        for j in path:
            after[j] = i
        return i

    out, at = [], 0
    for point, slice_, rows in sorted(cells):
        while at < len(nodes) and nodes[at][0] < point:
            at += 1
        node, rank = at % len(nodes), 0
        while rank < rows:
            node = open_node(node)
            shard = nodes[node][1]
            take = min(rows - rank, free[shard])
            out.append((point, slice_, rank, rank + take, shard, used[shard]))
            free[shard] -= take
            used[shard] += take
            rank += take
    return out


def shard_documents(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", *,
                    virtual_nodes: int = VIRTUAL_NODES, points: int = POINTS, max_cells: int = CELLS
                    ) -> DataFrame:
    """(id, size, text_crc32, shard, slot): size in UTF-8 bytes plus 8, slots gapless from 0."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = written(docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        _point(text, points).alias("point")), "shard-rows")
    per_point = rows.groupBy("point").agg(F.count(F.lit(1)).alias("rows")).collect()   # <= points
    n = sum(r.rows for r in per_point)
    most = max(1, -(-n // max_cells))
    slices = spark.createDataFrame(
        [(r.point, -(-r.rows // most)) for r in per_point if r.rows > most], "point int, slices int")
    # at most max_cells rows: a point in this table holds more than n / max_cells rows
    celled = (rows.join(F.broadcast(slices), "point", "left")
              .withColumn("slice", F.pmod(F.xxhash64("id", "size", "crc", F.lit(1)),
                                          F.coalesce("slices", F.lit(1))).cast("int"))
              .drop("slices"))
    cells = celled.groupBy("point", "slice").agg(F.count(F.lit(1)).alias("rows")).collect()
    capacity = [n // shards + (s < n % shards) for s in range(shards)]
    plan = place([tuple(c) for c in cells], ring(spark, shards, virtual_nodes, points), capacity)
    # at most points + 2 * max_cells + shards rows
    intervals = spark.createDataFrame(
        plan, "point int, slice int, from_rank long, to_rank long, shard int, first_slot long")
    w = Window.partitionBy("point", "slice").orderBy("id", "crc", "size")
    ranked = celled.withColumn("rank", F.row_number().over(w) - 1)
    return (ranked.join(F.broadcast(intervals), ["point", "slice"])
            .filter("rank >= from_rank and rank < to_rank")
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
                    (F.col("first_slot") + F.col("rank") - F.col("from_rank")).cast("long").alias("slot")))
