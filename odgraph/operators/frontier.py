"""Edges that a loop reads by the zones they leave, so that late rounds read few."""

from __future__ import annotations

import math
from typing import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from odgraph.params import DEFAULTS, Params
from odgraph.session import scratch_path

#: Called after a round with its number, its frontier's zones and the edges it read.
OnRound = Callable[[int, int, int], None]


class FrontierEdges:
    """Edges ``src, dst, len`` that can be read by the zones they leave."""

    def __init__(self, edges: DataFrame, n_edges: int, p: Params = DEFAULTS):
        self.p = p
        self.spark = edges.sparkSession
        self.buckets = min(p.max_buckets, max(1, math.ceil(n_edges / p.edges_per_bucket)))
        self.path = scratch_path(self.spark, "frontier-edges")
        # "rebalance" splits the folder of a hot zone over several files
        out = edges.select(self.bucket("src").alias("bucket"), "src", "dst", "len").hint("rebalance", "bucket")
        out.sortWithinPartitions("bucket", "src").write.partitionBy("bucket").parquet(self.path)
        self.schema = edges.select("src", "dst", "len", F.lit(0).alias("bucket")).schema

    def bucket(self, col: str):
        return F.pmod(F.xxhash64(F.col(col)), F.lit(self.buckets)).cast("int")

    def _slices(self, counts: dict[int, int]) -> list[list[int]]:
        """Buckets dealt into groups of at most ``broadcast_vertex_limit`` frontier
        zones (a bucket beyond that is a group of its own)."""
        out, held = [[]], 0
        for b in sorted(counts):
            if out[-1] and held + counts[b] > self.p.broadcast_vertex_limit:
                out.append([])
                held = 0
            out[-1].append(b)
            held += counts[b]
        return out

    def leaving(self, frontier: DataFrame) -> tuple[DataFrame | None, int, list[Observation]]:
        """Edges of the zones in ``frontier`` (``id`` and other columns) with its
        columns, the number of its zones, and observations of the rows read."""
        by_bucket = frontier.groupBy(self.bucket("id").alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
        row = by_bucket.agg(F.map_from_entries(F.collect_list(F.struct("b", "n"))).alias("counts"),
                            F.min("low").alias("low"), F.max("high").alias("high")).first()
        counts = row["counts"]
        if not counts:
            return None, 0, []
        table = self.spark.read.schema(self.schema).parquet(self.path)
        out, seen = None, []
        for group in self._slices(counts):
            seen.append(Observation())
            edges = table.where(F.col("bucket").isin(group) & F.col("src").between(row["low"], row["high"]))
            edges = edges.observe(seen[-1], F.count(F.lit(1)).alias("edges")).drop("bucket")
            part = frontier.where(self.bucket("id").isin(group)) if len(group) < len(counts) else frontier
            if sum(counts[b] for b in group) <= self.p.broadcast_vertex_limit:
                part = F.broadcast(part)
            part = edges.join(part, F.col("src") == F.col("id")).drop("id")
            out = part if out is None else out.unionByName(part)
        return out, sum(counts.values()), seen
