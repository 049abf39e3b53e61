"""Connected components of links between words or other keys, as joins and minima.

Every node points to the smallest node it knows; a round lets each node take the
smallest pointer among its neighbours and then follow that pointer once, so chains
halve. A round is a partially aggregated minimum and two joins on a table of nodes;
no component is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable


def components(links: DataFrame, *, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every end of the links (a, b): the smallest node
    reachable. Repeated, reversed and self links do no harm; null ends are ignored."""
    both = links.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    both = durable(both.union(both.select("b", "a")).distinct())
    now = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("component"))
    now = durable(now)
    for _ in range(max_rounds):
        heard = both.join(now, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("heard"))
        least = now.join(heard, F.col("node") == F.col("a")).select("node", "component", F.least("component", "heard").alias("to"))
        hop = now.select(F.col("node").alias("to"), F.col("component").alias("beyond"))
        moved = durable(least.join(hop, "to").select("node", "component", F.least("to", "beyond").alias("next")))
        settled = moved.where("next <> component").isEmpty()
        now = moved.select("node", F.col("next").alias("component"))
        if settled:
            return now
    raise RuntimeError("components did not settle")
