"""Connected components by hooking, pointer jumping and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import materialize


def connected(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node that the ``(a, b)`` edges touch; the root is one node of its component.

    Each round hooks every node to its smallest neighbour (or itself),
    follows these pointers once and contracts the edges; every component
    that still has an edge at least halves its nodes, so rounds grow with
    the logarithm. Minima are pre-aggregated, so a star's hub is no task's
    whole work, and each round's tables are written to the shared folder.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
    both = materialize(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    mapping = None
    while mapping is None or not both.isEmpty():
        hook = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("p"))
        hook = materialize(hook, "hooks")
        step = hook.select(F.col("u").alias("p"), F.col("p").alias("q"))
        hook = materialize(hook.join(step, "p").select("u", F.col("q").alias("p")), "hooks")
        if mapping is None:
            mapping = hook.select(F.col("u").alias("node"), F.col("p").alias("root"))
        else:
            mapping = mapping.join(hook.select(F.col("u").alias("root"), "p"), "root", "left")
            mapping = materialize(mapping.select("node", F.coalesce("p", "root").alias("root")), "roots")
        ends = both.join(hook, "u").select(F.col("p").alias("a"), "v")
        ends = ends.join(hook.select(F.col("u").alias("v"), F.col("p").alias("b")), "v")
        both = materialize(ends.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "edges")
    return mapping
