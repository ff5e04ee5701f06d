"""Connected components of a link table, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after merging the components that ``links`` (a, b) connect.

    ``labels`` (node, comp) has every linked node once, its comp being the
    smallest node of its component so far.  Each pass contracts the links to
    components, hooks every component to its smallest neighbour and follows
    the hook of that one too, so long chains shrink geometrically; nodes far from the
    smallest one never pass through a single task.
    """
    while True:
        la = labels.select(F.col("node").alias("a"), F.col("comp").alias("x"))
        lb = labels.select(F.col("node").alias("b"), F.col("comp").alias("y"))
        cross = written(links.join(la, "a").join(lb, "b").filter("x != y").select("x", "y").distinct(), "cross")
        if cross.isEmpty():
            return labels
        both = cross.unionByName(cross.select(F.col("y").alias("x"), F.col("x").alias("y")))
        hook = written(both.groupBy("x").agg(F.min("y").alias("y"))
                       .select("x", F.least("x", "y").alias("to")), "hooks")
        nxt = hook.select(F.col("x").alias("to"), F.col("to").alias("further"))
        hook = hook.join(nxt, "to", "left").select("x", F.coalesce("further", "to").alias("to"))
        labels = written(labels.join(hook.withColumnRenamed("x", "comp"), "comp", "left")
                         .select("node", F.coalesce("to", "comp").alias("comp")), "labels")
