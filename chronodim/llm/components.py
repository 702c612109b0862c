"""Connected components of a graph too large for one machine: rounds of large-star and
small-star over written edge tables, until a round changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _both(e: DataFrame) -> DataFrame:
    return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(neighbours: DataFrame, larger: bool) -> DataFrame:
    """Every node's neighbours (the larger ones, or the smaller ones and itself) go to its minimum."""
    low = neighbours.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    e = neighbours.join(low, "a")
    if larger:
        out = e.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = e.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _mark(e: DataFrame) -> tuple:
    row = e.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
    return row[0], row[1]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(a, b) links between longs -> (node, root): each linked node with the smallest node
    that it can reach.  Nodes without a link aren't returned."""
    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                "edges")
    mark = _mark(e)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        e = _star(_both(e), larger=True)
        e = written(_star(e.where("b < a"), larger=False), "edges")
        before, mark = mark, _mark(e)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components: no end after {max_rounds} rounds")
    roots = e.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
