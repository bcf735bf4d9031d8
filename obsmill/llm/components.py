"""Connected components of an edge table by alternating star contractions, one written table a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsmill.llm import common


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(least, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()


def connected_components(edges: DataFrame, scratch: common.Scratch, most_rounds: int = 60) -> DataFrame:
    """(node, root): every node that has an edge, with the least node that it reaches.

    edges has comparable non-null columns u and v, in any order, with repeats. Rounds end when the edges are
    stars about the least node of each component; their number grows with the logarithm of the longest path.
    No group is collected: both steps are minima (combined before the shuffle) and joins on the node.
    """
    now = scratch.table(edges.where("u <> v").distinct(), "edges")
    before = None
    for k in range(most_rounds):
        now = scratch.table(_small_star(_large_star(now)), f"stars{k}")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        before = state
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
