"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.scratch import Scratch

MAX_ROUNDS = 200


def components(edges: DataFrame, scratch: Scratch, prefix: str = "cc") -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; the component is its smallest node.

    Each round points every node at its neighbour (or itself) of least hash,
    follows the pointer once more, and replaces the nodes of the remaining
    edges by what they point at.  The hash changes with the round, so chains
    shrink by a constant factor on average whatever their order.  A hub's
    edges collapse in the partial aggregation; the joins read written tables
    on both sides, so AQE can split a hub's partition.  Rows with a null end
    or equal ends are ignored; an empty edge table gives an empty result.
    """

    def named(step: str) -> str:
        return f"{prefix}-{step}"

    live = scratch.table(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        named("edges-0"),
    )
    ends = live.select(F.col("a").alias("node")).union(live.select(F.col("b").alias("node"))).distinct()
    roots = scratch.table(ends.select("node", F.col("node").alias("root")), named("roots-0"))
    for k in range(MAX_ROUNDS):
        if live.isEmpty():
            break
        both = live.union(live.select("b", "a"))
        rank = lambda c: F.struct(F.xxhash64(F.lit(k), F.col(c)).alias("h"), F.col(c).alias("id"))
        best = both.groupBy(F.col("a").alias("node")).agg(F.min(rank("b")).alias("nb"))
        first = scratch.table(
            best.select("node", F.least(F.col("nb"), rank("node"))["id"].alias("up")), named(f"first-{k}")
        )
        up = scratch.table(
            first.join(first.select(F.col("node").alias("up"), F.col("up").alias("upper")), "up").select(
                "node", F.col("upper").alias("up")
            ),
            named(f"up-{k}"),
        )
        moved = (
            live.join(up.select(F.col("node").alias("a"), F.col("up").alias("ua")), "a")
            .join(up.select(F.col("node").alias("b"), F.col("up").alias("ub")), "b")
            .where("ua <> ub")
        )
        live_next = scratch.table(
            moved.select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(),
            named(f"edges-{k + 1}"),
        )
        roots_next = scratch.table(
            roots.join(up.withColumnRenamed("node", "root"), "root", "left").select(
                "node", F.coalesce("up", "root").alias("root")
            ),
            named(f"roots-{k + 1}"),
        )
        scratch.drop(named(f"edges-{k}"), named(f"roots-{k}"), named(f"first-{k}"), named(f"up-{k}"))
        live, roots = live_next, roots_next
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    least = scratch.table(roots.groupBy("root").agg(F.min("node").alias("component")), named("least"))
    return scratch.table(roots.join(least, "root").select("node", "component"), named("result"))
