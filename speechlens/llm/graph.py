"""Connected components of a graph of links, as joins and aggregations.

Alternating large-star and small-star steps: every step links neighbours to the
smallest one known, so chains shrink by a constant factor and stars stay stars.
No group is gathered: a step is a partially aggregated minimum and a join, which
Spark's adaptive execution splits where a node has very many links. Steps run in as
many tasks as their links need, so a small graph leaves few shuffle files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import durable


#: links that one task takes in a step
TASK_LINKS = 250_000


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.where("b > a").join(least, "a").select(
        F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").coalesce(tasks)


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a").coalesce(tasks)
    ends = F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))
    return joined.select(F.inline(ends)).where("a != b").distinct().coalesce(tasks)


def _counted(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The links, written once, with their number and a sum of hashes seen on the way."""
    seen = Observation()
    out = durable(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")))
    return out, (seen.get["n"], seen.get["s"])


def connected_components(edges: DataFrame, *, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of `edges` (columns a, b of one ordered
    type): the component is the smallest node reachable. Self links and repeated
    or reversed links do no harm; null ends are ignored."""
    now, (n, _) = _counted(edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a != b").distinct())
    tasks = 1 + n // TASK_LINKS
    now = now.coalesce(tasks)
    nodes = now.select(F.col("a").alias("node")).union(now.select(F.col("b").alias("node"))).distinct()
    seen = None
    for _ in range(max_rounds):
        now, mark = _counted(_small_star(_large_star(now, tasks), tasks))
        if mark == seen:
            return nodes.join(now.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").select(
                "node", F.coalesce("component", "node").alias("component"))
        seen = mark
    raise RuntimeError("connected components did not settle")
