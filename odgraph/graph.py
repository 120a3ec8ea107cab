"""The graph value: two DataFrames, no graph package."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Graph:
    """``vertices(id)`` and ``edges(src, dst, weight)``.

    Edges are unique per ``(src, dst)`` when built from an edge list; the
    algorithms do not rely on it (duplicate rows simply count twice, as they
    would in a multigraph).
    """

    vertices: DataFrame
    edges: DataFrame

    @staticmethod
    def from_edge_list(edge_list: DataFrame, weight: str = "trip_count") -> "Graph":
        """G1: vertex set = distinct endpoints, edges = ``src, dst, weight``."""
        edges = edge_list.select("src", "dst", F.col(weight).alias("weight"))
        return Graph(vertices_of(edge_list), edges)


def vertices_of(edges: DataFrame) -> DataFrame:
    """Distinct ``src`` ∪ distinct ``dst`` as ``id``.

    One ``union`` followed by one ``distinct``: the partial aggregate on each
    side removes duplicates before the single shuffle.
    """
    return (
        edges.select(F.col("src").alias("id"))
        .union(edges.select(F.col("dst").alias("id")))
        .distinct()
    )
