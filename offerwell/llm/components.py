"""Connected components of a link table, by contraction.

In every round each node hooks to its smallest neighbour (by id, and in every second round by a hash, so that chains shrink as fast
as stars); links are then carried over to the hooks until none is left. Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwell.session import cut_lineage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every node that has a link; component is the smallest id that links reach. Links with a null end are left out."""
    pair = links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), F.col(a).alias("x"), F.col(b).alias("y"))
    edges = cut_lineage(pair.where("x <> y").select("a", "b").distinct(), "links")
    owner, turn = None, 0
    while owner is None or not edges.isEmpty():
        order = (lambda c: F.struct(c.alias("h"), c.alias("n"))) if turn % 2 == 0 else (
            lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), c.alias("n"))
        )
        ends = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = ends.groupBy("a").agg(F.min(order(F.col("b"))).alias("m"))
        hooks = best.select(F.col("a").alias("id"), F.least("m", order(F.col("a")))["n"].alias("hook"))
        hooks = cut_lineage(hooks, "hooks")
        left, right = hooks.toDF("a", "p"), hooks.toDF("b", "q")
        moved = edges.join(left, "a").join(right, "b").where("p <> q")
        edges = cut_lineage(moved.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct(), "links")
        if owner is None:
            owner = hooks
        else:
            step = hooks.toDF("hook", "next")
            owner = owner.join(step, "hook", "left").select("id", F.coalesce("next", "hook").alias("hook"))
        turn += 1
    smallest = owner.groupBy("hook").agg(F.min("id").alias("component"))
    return cut_lineage(owner.join(smallest, "hook").select("id", "component"), "components")
