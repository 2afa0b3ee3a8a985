"""Connected components by alternating large-star and small-star steps.

Each step is a min-aggregate (combined before the shuffle) and a join that adaptive execution
splits where a node has very many edges; no node's neighbours are gathered in one place. The
number of steps grows with the logarithm of the number of nodes. Each step's edges are cut off by
a checkpoint in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import cut


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, max_steps: int = 60) -> DataFrame:
    """From ``edges`` (a, b) of one ordered type: (node, root) for each node that has an edge to another; root is the least of its component.

    Rows with a null and edges from a node to itself don't count; repeated and opposite edges count once.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = mark(now)
    for _ in range(max_steps):
        if before[0] == 0:
            break
        now = cut(_small(_large(now)))
        after = mark(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"no fixed point within {max_steps} steps")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
