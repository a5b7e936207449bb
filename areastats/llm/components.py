"""Connected components of a link table, by hooking and contraction in Spark jobs."""

from pyspark.sql import DataFrame, functions as F

from areastats.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every linked node: root is the smallest node it can reach.

    `links` has two long columns `a`, `b`; order, repeats and self links do not matter, nulls
    are dropped. Each round hooks every node to its smallest lower neighbour, flattens the
    hooks by pointer jumping, and rewrites the links to the roots, so the table shrinks
    every round. A node with very many neighbours only meets minimum aggregates (combined
    map-side) and sort-merge joins of stored tables, which AQE splits.
    """
    lo, hi = F.least("a", "b"), F.greatest("a", "b")
    edges = stored(links.dropna().select(lo.alias("lo"), hi.alias("hi")).where("lo < hi").distinct(), "links")
    result = None
    while not edges.isEmpty():
        hooks = _flat(stored(edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root")), "hooks"))
        result = hooks if result is None else stored(_through(result, hooks).union(hooks), "roots")
        low = hooks.select(F.col("node").alias("lo"), F.col("root").alias("lo_root"))
        high = hooks.select(F.col("node").alias("hi"), F.col("root").alias("hi_root"))
        moved = edges.join(low, "lo", "left").join(high, "hi", "left").select(
            F.coalesce("lo_root", "lo").alias("a"), F.coalesce("hi_root", "hi").alias("b")
        )
        edges = stored(moved.select(lo.alias("lo"), hi.alias("hi")).where("lo < hi").distinct(), "links")
    if result is None:
        return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    roots = result.select("root").distinct()
    return result.union(roots.select(F.col("root").alias("node"), "root"))


def _through(table: DataFrame, hooks: DataFrame) -> DataFrame:
    """(node, root) with each root replaced by its own root."""
    up = hooks.select(F.col("node").alias("root"), F.col("root").alias("upper"))
    return table.join(up, "root", "left").select("node", F.coalesce("upper", "root").alias("root"))


def _flat(hooks: DataFrame) -> DataFrame:
    """Follow hooks until every root is a node that hooks nowhere."""
    while not hooks.join(hooks.select(F.col("node").alias("root")), "root", "left_semi").isEmpty():
        hooks = stored(_through(hooks, hooks), "hooks")
    return hooks
