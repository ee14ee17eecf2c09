"""Connected components of a graph that no single machine could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costalloc.llm.common import materialize


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and a sum that changes with any of them."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of an edge, the smallest node it is connected to.

    edges: a, b (bigint). Alternates large-star and small-star steps, which link neighbours to
    the smallest one, until nothing changes: about log(n) rounds of aggregates and joins, each
    written to the shared folder. No neighbour list is collected.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = materialize(edges.where("a <> b").select(high.alias("a"), low.alias("b")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        linked = large.join(least, "a")
        small = linked.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
        now = materialize(small.unionByName(least.select("a", F.col("least").alias("b"))).distinct(), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
