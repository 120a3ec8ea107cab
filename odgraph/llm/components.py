"""Connected components of an edge table by alternating star contraction.

A round makes every node point its larger neighbours to the smallest node it
knows (large star), then does the same along smaller neighbours (small star).
After a logarithmic number of rounds every component is a star around its
smallest node, which one aggregate over the nodes finds out; edges that are
stars already take no round.  All work is joins and aggregates; the edge table
of each round is written to the shared folder, and only a flag comes to the
driver.  A hot node is aggregated map-side, and the join that hands its minimum
back is one that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odgraph.llm.common import cut


def _star(pairs: DataFrame) -> DataFrame:
    """(a, b) with m = the smallest b of each a."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m"))
    return pairs.join(least, "a")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, or larger ones only."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))).alias("e"))
    nodes = ends.groupBy("e.node").agg(F.sum("e.below").alias("below"), F.max("e.above").alias("above"))
    return nodes.where("below > 1 OR below = 1 AND above = 1").isEmpty()


def connected_components(edges: DataFrame, a: str = "src", b: str = "dst") -> DataFrame:
    """Return ``(node, component)`` for every node of ``edges``; ``component``
    is the smallest node reachable.

    Edges with a null end are ignored, self-edges and repeated edges change
    nothing, and an empty table gives an empty result.
    """
    x, y = F.col(a), F.col(b)
    state = cut(
        edges.where(x.isNotNull() & y.isNotNull())
        .select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(),
        "components",
    )
    loops = state.where("u = v").select(F.col("u").alias("node"), F.col("v").alias("component"))
    live = state.where("u > v")
    while not _are_stars(live):
        both = live.select(F.col("u").alias("a"), F.col("v").alias("b")).unionAll(
            live.select(F.col("v").alias("a"), F.col("u").alias("b")))
        large = (_star(both).where("b > a")
                 .select(F.col("b").alias("a"), F.least("a", "m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct(F.col("b").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("a").alias("u"), F.col("m").alias("v")))).alias("e"))
        live = cut(small.select("e.u", "e.v").where("u > v").distinct(), "components")
    stars = live.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = live.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionAll(centres).unionAll(loops).groupBy("node").agg(
        F.min("component").alias("component"))
