"""Communities and their analysis.

Label propagation semantics (synchronous, as Spark's GraphX computes it)::

    label_0(v) = id(v)
    each round every edge (u, v) sends label(u) to v and label(v) to u;
    label'(v) = the label received most often (one vote per edge row and
                direction), smallest label on ties; a vertex that receives
                nothing keeps its label.
    exactly ``lpa_iters`` rounds (bipartite pieces oscillate, so the round
    count is part of the result).

Per round: one join of the (pre-aggregated) vote table with the label state
on the sender, then ``groupBy(receiver, label)`` and ``groupBy(receiver)``
with ``min_by(label, (-votes, label))``.  Both aggregates run partially in
the map tasks, so a hub receiving a third of all votes is folded before the
shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odgraph.functions.exprs import pct
from odgraph.graph import Graph
from odgraph.params import DEFAULTS, Params
from odgraph.plans.iterate import (
    VertexJoin, graph_loop, materialize, release, reliable_checkpoint, run_rounds, write_table,
)


def vote_table(edges: DataFrame) -> DataFrame:
    """Both directions of every edge row, folded to (sender, receiver, votes)."""
    both = edges.select(F.col("src").alias("sender"), F.col("dst").alias("receiver")).unionByName(
        edges.select(F.col("dst").alias("sender"), F.col("src").alias("receiver"))
    )
    return both.groupBy("sender", "receiver").agg(F.count(F.lit(1)).alias("votes"))


def label_propagation(graph: Graph, p: Params = DEFAULTS, iterations: int | None = None) -> DataFrame:
    """``zone_id, community_id`` (bigint).

    Vertices on no edge never receive a vote and keep their own id; they are
    set aside once, so each round reads the label state exactly once (the
    plan grows linearly between checkpoints).  Every vertex on an edge
    receives at least one vote per round.
    """
    iters = p.lpa_iters if iterations is None else iterations
    verts = graph.vertices.select("id")
    with graph_loop(graph.edges, p):
        votes = vote_table(graph.edges).persist()
        on_edge, n = materialize(votes.select(F.col("receiver").alias("id")).distinct())
        isolated = verts.join(on_edge, "id", "left_anti")
        vj = VertexJoin(votes, "sender", "receiver", n, p)

        def step(state: DataFrame, _i: int) -> DataFrame:
            tallies = vj.attach(state).groupBy(F.col("receiver").alias("id"), "label").agg(
                F.sum("votes").alias("cnt")
            )
            return tallies.groupBy("id").agg(
                F.min_by("label", F.struct((-F.col("cnt")).alias("k"), F.col("label").alias("l"))).alias("label")
            )

        state0 = on_edge.select("id", F.col("id").cast("bigint").alias("label"))
        final = run_rounds(state0, step, iters, p)
        vj.release()
        isolated = reliable_checkpoint(isolated)
        release(votes, on_edge)
    out = final.unionByName(isolated.select("id", F.col("id").cast("bigint").alias("label")))
    return out.select(F.col("id").alias("zone_id"), F.col("label").alias("community_id"))


# ---------------------------------------------------------------- analyses


def community_ranks(communities: DataFrame, ranks: DataFrame) -> DataFrame:
    """Assignment ⋈ rank on ``zone_id`` (both are per-vertex tables)."""
    return communities.join(ranks, "zone_id", "inner").select("zone_id", "community_id", "pagerank")


def community_stats(communities: DataFrame, ranks: DataFrame) -> DataFrame:
    """Per community — zones, Σ rank, mean rank."""
    return community_ranks(communities, ranks).groupBy("community_id").agg(
        F.count("zone_id").alias("num_zones"),
        F.sum("pagerank").alias("total_pagerank"),
        F.avg("pagerank").alias("avg_pagerank"),
    )


def size_order() -> list:
    return [F.desc("num_zones"), F.asc("community_id")]


def top_communities(stats: DataFrame, k: int = 20) -> DataFrame:
    """Largest communities, with the ``Comm {id}`` chart label."""
    return stats.orderBy(*size_order()).limit(k).withColumn(
        "label", F.format_string("Comm %d", F.col("community_id"))
    )


def top_communities_by_rank(stats: DataFrame, k: int = 10) -> DataFrame:
    """Communities with the largest Σ rank."""
    return stats.orderBy(F.desc(F.round("total_pagerank", 6)), "community_id").limit(k).withColumn(
        "label", F.format_string("Comm %d", F.col("community_id"))
    )


def community_extremes(stats: DataFrame) -> DataFrame:
    """Largest and smallest community (ties → smaller id), one aggregate."""
    big = F.struct(F.col("num_zones"), (-F.col("community_id")).alias("neg_id"))
    small = F.struct((-F.col("num_zones")).alias("neg_n"), (-F.col("community_id")).alias("neg_id"))
    picked = F.struct("community_id", "num_zones", "total_pagerank")
    row = stats.agg(
        F.max_by(picked, big).alias("largest"),
        F.max_by(picked, small).alias("smallest"),
        F.count(F.lit(1)).alias("num_communities"),
    )
    return row.select(
        "num_communities",
        F.col("largest.community_id").alias("largest_id"),
        F.col("largest.num_zones").alias("largest_zones"),
        F.col("largest.total_pagerank").alias("largest_total_pagerank"),
        F.col("smallest.community_id").alias("smallest_id"),
        F.col("smallest.num_zones").alias("smallest_zones"),
        F.col("smallest.total_pagerank").alias("smallest_total_pagerank"),
    )


def community_concentration(stats: DataFrame, ks=(5, 10)) -> DataFrame:
    """% of Σ rank in the top 5 / 10 communities **by size**."""
    from pyspark.sql import Window

    kmax = max(ks)
    total = stats.agg(F.sum("total_pagerank")).scalar()
    top = stats.orderBy(*size_order()).limit(kmax)
    # window over the bounded top-k rows only
    w = top.select("total_pagerank", F.row_number().over(Window.orderBy(*size_order())).alias("pos"))
    return w.agg(
        *[
            (F.try_divide(F.sum(F.when(F.col("pos") <= k, F.col("total_pagerank"))), total) * 100).alias(
                f"top{k}_pct"
            )
            for k in ks
        ]
    )


def edges_with_communities(edge_list: DataFrame, communities: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Role-playing self-join — the community of each end of every edge.

    Both joins are many-to-one onto the per-vertex assignment.  They go
    through :class:`VertexJoin`: the assignment is broadcast only after its
    row count is checked, otherwise the edge side is salted so that a hub
    holding a large share of the edges does not land in one task.
    """
    n = communities.count()
    e = edge_list.select("src", "dst", "trip_count")
    src_join = VertexJoin(e, "src", "dst", n, p, reuse=False)
    by_src = src_join.attach(
        communities.select(F.col("zone_id").alias("id"), F.col("community_id").alias("src_community"))
    )
    dst_join = VertexJoin(by_src, "dst", "src", n, p, reuse=False)
    by_dst = dst_join.attach(
        communities.select(F.col("zone_id").alias("id"), F.col("community_id").alias("dst_community"))
    ).select("src", "dst", "trip_count", "src_community", "dst_community")
    if src_join.holds_cache or dst_join.holds_cache:
        # the joined table is written once, then both cached edge tables go
        by_dst = write_table(by_dst, "edge_communities")
        src_join.release()
        dst_join.release()
    return by_dst


def connectivity(edge_list: DataFrame, communities: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Trips inside vs between communities, one conditional agg.

    The verdict follows the reference: intra > 50 % → strong, inter > 50 % →
    weak, otherwise balanced; null shares (no trips) → ``no data``.
    """
    ec = edges_with_communities(edge_list, communities, p)
    same = F.col("src_community") == F.col("dst_community")
    row = ec.agg(
        F.coalesce(F.sum("trip_count"), F.lit(0)).cast("bigint").alias("total_trips"),
        F.coalesce(F.sum(F.when(same, F.col("trip_count"))), F.lit(0)).cast("bigint").alias("intra_trips"),
        F.coalesce(F.sum(F.when(~same, F.col("trip_count"))), F.lit(0)).cast("bigint").alias("inter_trips"),
    )
    row = row.select(
        "total_trips", "intra_trips", "inter_trips",
        pct("intra_trips", "total_trips").alias("intra_pct"),
        pct("inter_trips", "total_trips").alias("inter_pct"),
    )
    t = F.lit(p.connectivity_share)
    return row.withColumn(
        "verdict",
        F.when(F.col("intra_pct").isNull(), F.lit("no data"))
        .when(F.col("intra_pct") > t, F.lit("strong intra-connectivity"))
        .when(F.col("inter_pct") > t, F.lit("weak intra-connectivity"))
        .otherwise(F.lit("balanced")),
    )


def modularity(edge_list: DataFrame, communities: DataFrame, weight: str | None = "trip_count") -> DataFrame:
    """Modularity Q of an assignment on the symmetrised weighted graph.

    With ``W`` = Σ edge weight, ``in_c`` = weight of edges inside ``c`` and
    ``S_c`` = Σ (out + in strength) of the members of ``c``::

        Q = Σ_c  in_c / W  -  (S_c / 2W)^2

    ``weight=None`` counts every edge row once.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    ec = edges_with_communities(
        edge_list.select("src", "dst", w.alias("trip_count")), communities
    )
    per_comm = ec.select(
        F.explode(
            F.array(
                F.struct(F.col("src_community").alias("c"), F.col("trip_count").alias("s"),
                         F.when(F.col("src_community") == F.col("dst_community"), F.col("trip_count"))
                         .otherwise(F.lit(0.0)).alias("inside")),
                F.struct(F.col("dst_community").alias("c"), F.col("trip_count").alias("s"),
                         F.lit(0.0).alias("inside")),
            )
        ).alias("r")
    ).groupBy("r.c").agg(F.sum("r.s").alias("strength"), F.sum("r.inside").alias("inside"))
    total = edge_list.agg(F.sum(w)).scalar()
    terms = per_comm.select(
        (F.try_divide(F.col("inside"), total)
         - F.pow(F.try_divide(F.col("strength"), F.lit(2.0) * total), 2)).alias("q")
    )
    return terms.agg(
        F.coalesce(F.sum("q"), F.lit(0.0)).alias("modularity"),
        F.count(F.lit(1)).alias("num_communities"),
    )
