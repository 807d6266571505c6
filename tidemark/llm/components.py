"""Connected components of a large edge list, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import settle

ROUNDS = 60


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; one root per component.

    Each round hooks every node to the neighbour with the smallest hash (or to
    itself) and contracts the edges. Hashes change by round, so a long chain
    shrinks by a constant factor like any other shape. The hooking is a minimum
    with map-side combine; a node with very many links is a hot key of an equi
    join only, which adaptive execution splits. Each round is a stored table.
    """
    links = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    links = settle(links.distinct(), "links")
    roots = None
    for step in range(ROUNDS):
        if links.isEmpty():
            break
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hashed = F.struct(F.xxhash64(F.lit(step), "v").alias("h"), F.col("v").alias("v"))
        least = both.groupBy("u").agg(F.min(hashed).alias("m"))
        own = F.struct(F.xxhash64(F.lit(step), "u").alias("h"), F.col("u").alias("v"))
        hooks = settle(least.select("u", F.least("m", own)["v"].alias("to")), "hooks")
        if roots is None:
            roots = hooks.select(F.col("u").alias("node"), F.col("to").alias("root"))
        else:
            moved = hooks.select(F.col("u").alias("root"), "to")
            roots = settle(roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "roots")
        left = links.join(hooks, "u").select("v", F.col("to").alias("p"))
        right = hooks.select(F.col("u").alias("v"), F.col("to").alias("q"))
        links = settle(left.join(right, "v").filter("p <> q").select(F.least("p", "q").alias("u"), F.greatest("p", "q").alias("v")).distinct(), "links")
    else:
        raise RuntimeError("components did not converge")
    if roots is None:
        kind = edges.schema[a].dataType
        return edges.sparkSession.createDataFrame([], "node long, root long").select(F.col("node").cast(kind), F.col("root").cast(kind))
    return roots


def merge_roots(roots: DataFrame | None, links: DataFrame, a: str = "ra", b: str = "rb") -> DataFrame:
    """``roots`` (node, root) after links between roots. Nodes that ``roots``
    does not list are their own roots."""
    moved = connected(links, a, b)
    if roots is None:
        return moved
    to = moved.select(F.col("node").alias("root"), F.col("root").alias("to"))
    known = roots.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return settle(known.unionByName(moved.join(roots, "node", "left_anti")), "roots")
