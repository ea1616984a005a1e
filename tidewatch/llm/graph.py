"""Connected components of a graph kept as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import cut
from tidewatch.sizes import broadcast_if

# Rows of a graph worth a task of their own.
TASK_ROWS = 250_000


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that is reached, for all nodes of `edges` (a, b).

    Large-star and small-star in turn (Kiveris et al., 2014), each a grouped
    minimum and a join, until the graph is a set of stars. The number of rounds
    grows with the logarithm of a component's size; every round is written. A
    graph of few rows is kept in few tasks, and its minima are broadcast.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = _mark(e)
    while True:
        n = mark[0]
        tasks = -(-n // TASK_ROWS) or 1
        e = e.coalesce(tasks)
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(broadcast_if(least, 2 * n), "u")
        large = cut(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct().coalesce(tasks))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(broadcast_if(least, 2 * n), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct().coalesce(tasks))
        new = _mark(e)
        if new == mark:
            break
        mark = new
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _mark(e: DataFrame) -> tuple:
    """Rows and a sum of hashes: equal for equal sets of edges."""
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
