"""Hop distance, shortest travel distance and routes from one zone.

Relaxation (Bellman-Ford) as DataFrame rounds that follow the frontier: only
zones that improved in the last round offer their neighbours a way.

* :class:`~odgraph.operators.frontier.FrontierEdges` writes the edge table once into the shared folder,
  foldered by a hash bucket of the source and sorted by source.  A round reads
  the folders that hold a zone of its frontier (a partition filter on the list
  of buckets, plus the frontier's id range for the Parquet statistics) and
  meets them with the broadcast frontier, so late rounds read few edges and a
  zone with a third of all edges is many file splits, not one task.  A
  frontier beyond the broadcast bound is dealt into slices of buckets.
* A zone's label is (distance, edges on the way, previous zone); the least
  label wins, so of equally short ways the one with fewest edges, then with the
  smallest previous zone, is kept, whatever the order of offers.
* Rounds stop when no zone improves, which non-negative lengths reach within
  as many rounds as the longest shortest way has edges.

Routes are read off the previous zones by pointer doubling: jump tables of 1,
2, 4, ... zones back, each one join, then one join a table from the longest
jump down gives every place of every route once.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odgraph.graph import vertices_of
from odgraph.operators.frontier import FrontierEdges, OnRound
from odgraph.params import DEFAULTS, Params
from odgraph.plans.iterate import graph_loop, meet, reliable_checkpoint


def busiest_origin(edge_list: DataFrame) -> DataFrame:
    """One-row frame: the zone with the most outgoing trips (ties → smaller id)."""
    return edge_list.groupBy("src").agg(F.sum("trip_count").alias("t")).agg(
        F.max_by("src", F.struct(F.col("t"), (-F.col("src")).alias("ns"))).alias("source")
    )


def _relax(edge_list: DataFrame, source: int | None, length: str, max_hops: int | None, p: Params,
           on_round: OnRound | None) -> DataFrame:
    """``id, hops, best`` with ``best`` = (dist, steps, prev); nulls where unreached."""
    verts = reliable_checkpoint(vertices_of(edge_list))
    n = verts.count()
    src_col = F.lit(source) if source is not None else busiest_origin(edge_list).scalar()
    id_type = dict(verts.dtypes)["id"]
    edges = edge_list.select(F.col("src").cast(id_type), F.col("dst").cast(id_type),
                             F.coalesce(F.col(length).cast("double"), F.lit(0.0)).alias("len"))
    at = FrontierEdges(edges, edge_list.count(), p)
    start = F.col("id") == src_col
    label = F.struct(F.lit(0.0).alias("dist"), F.lit(0).alias("steps"), F.lit(None).cast(id_type).alias("prev"))
    with graph_loop(edge_list, p):
        state = reliable_checkpoint(verts.select(
            "id", F.when(start, F.lit(0)).alias("hops"), F.when(start, label).alias("best"), start.alias("fresh")))
        for i in itertools.count() if max_hops is None else range(max_hops):
            leaving, zones, seen = at.leaving(state.where("fresh").select("id", "hops", "best"))
            if leaving is None:
                break
            if max_hops is None and i > n:
                raise ValueError(f"negative cycle: distances still improve after {n} rounds")
            offers = leaving.select(
                F.col("dst").alias("id"), (F.col("hops") + 1).alias("hops"),
                F.struct((F.col("best.dist") + F.col("len")).alias("dist"), (F.col("best.steps") + 1).alias("steps"),
                         F.col("src").alias("prev")).alias("best"),
                F.lit(None).cast("int").alias("old_hops"), F.lit(None).cast(state.schema["best"].dataType).alias("old"))
            kept = state.select("id", "hops", "best", F.col("hops").alias("old_hops"), F.col("best").alias("old"))
            new = offers.unionByName(kept).groupBy("id").agg(
                F.min("hops").alias("hops"), F.min("best").alias("best"),
                F.min("old_hops").alias("old_hops"), F.min("old").alias("old"))
            # a smaller previous zone alone changes nothing that a zone offers
            better = (~F.col("hops").eqNullSafe(F.col("old_hops")) | ~F.col("best.dist").eqNullSafe(F.col("old.dist"))
                      | ~F.col("best.steps").eqNullSafe(F.col("old.steps")))
            state = reliable_checkpoint(new.select("id", "hops", "best", better.alias("fresh")))
            if on_round is not None:
                on_round(i, zones, sum(s.get["edges"] for s in seen))
    return state.drop("fresh")


def shortest_paths(edge_list: DataFrame, source: int | None = None, length: str = "avg_distance",
                   max_hops: int | None = None, p: Params = DEFAULTS, on_round: OnRound | None = None) -> DataFrame:
    """``zone_id, hops, distance, steps, previous`` from ``source`` (default: busiest origin).

    ``hops`` is the BFS level; ``distance`` the shortest Σ ``length`` over all
    ways, or, only where the caller gives ``max_hops``, over ways of at most
    that many edges; ``steps`` the edges of the kept way of that length and
    ``previous`` the zone before its end.  Unreachable zones have nulls.  A
    cycle of negative length has no shortest way and raises ``ValueError``.
    """
    state = _relax(edge_list, source, length, max_hops, p, on_round)
    return state.select(F.col("id").alias("zone_id"), "hops", F.col("best.dist").alias("distance"),
                        F.col("best.steps").alias("steps"), F.col("best.prev").alias("previous"))


def hop_distance(edge_list: DataFrame, source: int | None = None, length: str = "avg_distance",
                 max_hops: int | None = None, p: Params = DEFAULTS, on_round: OnRound | None = None) -> DataFrame:
    """``zone_id, hops, distance`` of :func:`shortest_paths`."""
    return shortest_paths(edge_list, source, length, max_hops, p, on_round).select("zone_id", "hops", "distance")


def shortest_route(edge_list: DataFrame, source: int | None = None, targets: DataFrame | None = None,
                   length: str = "avg_distance", p: Params = DEFAULTS) -> DataFrame:
    """``zone_id, step, via, distance``: the zones of the shortest way to every
    reachable zone (or those in ``targets``, a frame with ``zone_id``), from step 0,
    the source, to the zone itself, with the distance travelled so far."""
    paths = reliable_checkpoint(shortest_paths(edge_list, source, length, p=p)).where("distance is not null")
    most, n = paths.agg(F.max("steps"), F.count(F.lit(1))).first()
    jumps = []
    with graph_loop(edge_list, p):
        back = paths.select(F.col("zone_id").alias("at"), F.col("previous").alias("to"))
        for k in range((most or 0).bit_length()):
            if k:
                last = jumps[-1]
                further = meet(last.where("to is not null"), "to", "at", last.toDF("zone", "far"), n, p).select(
                    "at", F.col("far").alias("to"))
                back = further.unionByName(last.where("to is null"))
            jumps.append(reliable_checkpoint(back))
        places = paths.select("zone_id", F.col("steps").alias("step"), F.col("zone_id").alias("via"))
        if targets is not None:
            places = places.join(targets.select("zone_id").distinct(), "zone_id", "left_semi")
        for k in reversed(range(len(jumps))):
            hop = 1 << k
            here = F.struct("step", "via")
            there = F.struct((F.col("step") - hop).alias("step"), F.col("far").alias("via"))
            both = F.when(F.col("step") >= hop, F.array(here, there)).otherwise(F.array(here))
            places = meet(places, "via", "zone_id", jumps[k].toDF("zone", "far"), n, p).select(
                "zone_id", F.explode(both).alias("place")).select("zone_id", "place.*")
        so_far = paths.select(F.col("zone_id").alias("zone"), "distance")
        return reliable_checkpoint(meet(places, "via", "zone_id", so_far, n, p).select("zone_id", "step", "via", "distance"))

