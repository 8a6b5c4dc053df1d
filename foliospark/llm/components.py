"""Connected components of a graph too large for one machine, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import compact, discard, materialise


def connected_components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, component), as a table, of every node of edges (a, b): component is the least node that can be reached.

    Each round groups edges by node with sums that begin before the shuffle; it ends when a round changes
    nothing, after about log(nodes) rounds.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, before = materialise(compact(e), "edges"), None
    for _ in range(most):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v").where("u <> v").distinct()
        last, e = e, materialise(compact(small), "edges")
        discard(last)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    out = nodes.join(e.select(F.col("u").alias("node"), F.col("v").alias("c")), "node", "left").select("node", F.coalesce("c", "node").alias("component"))
    out = materialise(compact(out), "components")
    discard(e)
    return out
