"""Connected components of an edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import written

MAX_ROUNDS = 40


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a long, b long); the root is the least node.

    A round is two aggregations and two joins, whatever the degrees: a node's
    neighbours are never collected.  Self-loops and repeated edges are fine.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = written(e, "edges")
    seen = _state(e)
    for _ in range(MAX_ROUNDS):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # the least neighbours are written, so that Spark can split a hub's edges in the join
        least = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m")), "least")
        large = written(both.join(least, F.col("a") == F.col("u")).where(F.col("b") > F.col("a"))
                        .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large-stars")
        least = written(large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u"), "least")
        joined = large.join(least, F.col("a") == F.col("u"))
        small = (joined.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))).distinct()
        e = written(small, "edges")
        now = _state(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
