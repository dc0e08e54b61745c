"""Connected components of a graph of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import saved


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; the component is its least node.

    Large-star and small-star steps in turn (Kiveris et al., 2014): each links the neighbours
    of a node to the least node they know, until the graph is one star per component. Least
    nodes are found by an aggregation that starts before the shuffle, so a node with most of
    the edges is no hot group. Each round is written to the scratch folder; the driver sees
    only a count and a checksum. Null nodes and loops are no edges.
    """
    pairs = edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    pairs, before = saved(pairs.distinct(), "edges"), None
    while True:
        now = pairs.agg(
            F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("mark")
        ).first()
        if now["n"] == 0 or now == before:
            break
        before = now
        pairs = saved(small_star(large_star(pairs)), "edges")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        pairs.select("v", "v").distinct()
    )


def large_star(pairs: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to the least node around it."""
    both = pairs.select("u", "v").union(pairs.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("at"), F.least("u", "m").alias("m"))
    # a larger neighbour v of u appears in pairs as (v, u)
    return (
        pairs.join(least, pairs["v"] == least["at"])
        .select(F.col("u"), F.col("m").alias("v"))
        .distinct()
    )


def small_star(pairs: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of them."""
    least = pairs.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("m"))
    links = pairs.join(least, pairs["u"] == least["at"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select(F.col("at").alias("u"), F.col("m").alias("v"))
    return links.where("u <> v").union(own).distinct()
