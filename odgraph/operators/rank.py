"""PageRank (plain, weighted, to tolerance, by residuals), HITS.

PageRank semantics (static, as Spark's GraphX computes it)::

    rank_0(v)   = 1
    rank_t+1(v) = r + (1 - r) * Σ_{(u,v) ∈ E} rank_t(u) * w(u,v)
    result(v)   = rank_T(v) * |V| / Σ rank_T          (one final scaling)

with ``w(u,v) = 1 / outdeg(u)`` (edge rows, weights ignored) for the plain
form and ``weight(u,v) / Σ_v weight(u,v)`` for the weighted form.  Sinks leak
mass, repaired only by the final scaling; ranks sum to ``|V|`` (or to 1 with
``scale='1'``).

Each round is one join of the edge table with the rank state on ``src``
(:class:`~odgraph.plans.iterate.VertexJoin`) and one ``groupBy(dst)``.  The
transition table carries one zero-weight self-edge per vertex, so vertices
without in-edges survive the group-by with no union or outer join (one
pipeline per round instead of a union with a zero row per vertex).
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odgraph.functions.exprs import correlation
from odgraph.graph import Graph
from odgraph.operators.frontier import FrontierEdges, OnRound
from odgraph.params import DEFAULTS, Params
from odgraph.plans.iterate import (
    VertexJoin, fixed_plans, graph_loop, materialize, release, reliable_checkpoint, run_rounds,
)


def _prepared(graph: Graph, p: Params, weight: str | None):
    """Persisted vertices, vertex count and the (src, dst, w) transition table.

    Both are static inputs re-read by every round; the vertex set is
    persisted here, the transition table by the round join (partitioned on
    ``src``), and both are released once the final state is checkpointed.
    """
    verts, n = materialize(graph.vertices.select(F.col("id")))
    e = graph.edges
    if weight is None:
        per_src = e.groupBy(F.col("src").alias("id")).agg(
            (F.lit(1.0) / F.count(F.lit(1))).alias("_norm")
        )
        base = e.select("src", "dst", F.lit(1.0).alias("_w"))
    else:
        wcol = F.coalesce(F.col(weight).cast("double"), F.lit(0.0))
        per_src = e.groupBy(F.col("src").alias("id")).agg(
            F.try_divide(F.lit(1.0), F.sum(wcol)).alias("_norm")
        )
        base = e.select("src", "dst", wcol.alias("_w"))
    # attach the per-source normaliser with the same skew-safe join as rounds
    vj0 = VertexJoin(base, "src", "dst", n, p, reuse=False)
    trans = vj0.attach(per_src).select("src", "dst", (F.col("_w") * F.col("_norm")).alias("w"))
    # one zero-weight self-edge per vertex: every vertex then receives a
    # (0.0) contribution through the round's join, so vertices without
    # in-edges survive the group-by without a union or outer join per round
    zero_loops = verts.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(0.0).alias("w"))
    trans = trans.filter(F.col("w").isNotNull()).unionByName(zero_loops)
    return verts, n, trans, vj0


def _pagerank_step(vj: VertexJoin, verts: DataFrame, p: Params):
    reset, damp = p.reset_prob, 1.0 - p.reset_prob

    def step(state: DataFrame, _i: int) -> DataFrame:
        contrib = vj.attach(state).select(F.col("dst").alias("id"), (F.col("rank") * F.col("w")).alias("c"))
        return contrib.groupBy("id").agg((F.lit(reset) + F.lit(damp) * F.sum("c")).alias("rank"))

    return step


def _scaled(state: DataFrame, n: int, scale: str) -> DataFrame:
    total = state.agg(F.sum("rank")).scalar()
    target = F.lit(float(n)) if scale == "n" else F.lit(1.0)
    return state.select(
        F.col("id").alias("zone_id"),
        F.try_divide(F.col("rank") * target, total).alias("pagerank"),
    )


def pagerank(graph: Graph, p: Params = DEFAULTS, iterations: int | None = None,
             weight: str | None = None, scale: str = "n") -> DataFrame:
    """G2 (``weight=None``) / G5 (``weight='weight'``): static PageRank."""
    iters = p.pagerank_iters if iterations is None else iterations
    with graph_loop(graph.edges, p):
        verts, n, trans, vj0 = _prepared(graph, p, weight)
        vj = VertexJoin(trans, "src", "dst", n, p)
        state0 = verts.select("id", F.lit(1.0).alias("rank"))
        final = run_rounds(state0, _pagerank_step(vj, verts, p), iters, p)
        vj.release()
        vj0.release()
        release(verts)
    return _scaled(final, n, scale)


def pagerank_to_tolerance(graph: Graph, p: Params = DEFAULTS, max_iterations: int | None = None,
                          weight: str | None = None, scale: str = "n") -> DataFrame:
    """Iterate until max |Δ rank| < tolerance.

    Changes shrink by the damping factor each round, so the loop ends by
    itself; a caller may bound it with ``max_iterations``.  The convergence
    test is one small aggregate per round over two checkpointed vertex
    states; the result carries the rounds used and whether it converged.
    """
    with graph_loop(graph.edges, p):
        verts, n, trans, vj0 = _prepared(graph, p, weight)
        vj = VertexJoin(trans, "src", "dst", n, p)
        step = _pagerank_step(vj, verts, p)
        state = reliable_checkpoint(verts.select("id", F.lit(1.0).alias("rank")))
        used, converged = 0, False
        for i in itertools.count() if max_iterations is None else range(max_iterations):
            new = reliable_checkpoint(step(state, i))
            used = i + 1
            delta = (
                new.alias("a").join(state.alias("b"), "id")
                .agg(F.max(F.abs(F.col("a.rank") - F.col("b.rank"))).alias("d"))
                .first()["d"]
            )
            state = new
            if delta is None or delta < p.tolerance:
                converged = True
                break
        vj.release()
        vj0.release()
        release(verts)
    return _scaled(state, n, scale).withColumn("iterations", F.lit(used)).withColumn("converged", F.lit(converged))


def pagerank_residual(graph: Graph, p: Params = DEFAULTS, tolerance: float | None = None, weight: str | None = None,
                      scale: str = "n", on_round: OnRound | None = None) -> DataFrame:
    """G4 by residuals: only zones that still hold rank to pass on send messages.

    Every zone starts with rank 1 and, as residual, the change that one round would
    make.  A round moves the residual of each active zone (above ``tolerance`` in
    size) into its rank and passes ``1 - r`` of it along its edges; a smaller
    residual waits until more arrives.  Residuals of both signs cancel.
    Rank plus waiting residual is returned, so what is left out is at most
    ``(1 - r) / r * tolerance`` a zone on average.  The fixpoint is that of
    :func:`pagerank_to_tolerance`.

    While more zones are active than may be broadcast, a round reads the edge
    table as the other loops do; from then on it reads the folders of the active
    zones (:class:`~odgraph.operators.frontier.FrontierEdges`).  ``on_round`` is
    called with the round, its active zones and, of rounds that read folders,
    the edges read (else the size of the edge table).
    """
    tol = p.tolerance if tolerance is None else tolerance
    damp = F.lit(1.0 - p.reset_prob)
    active = F.abs(F.col("res")) > F.lit(tol)
    with graph_loop(graph.edges, p):
        verts, n, trans, vj0 = _prepared(graph, p, weight)
        change = F.lit(p.reset_prob) + damp * F.sum("w") - F.lit(1.0)
        state = reliable_checkpoint(trans.groupBy(F.col("dst").alias("id")).agg(
            F.lit(1.0).alias("rank"), change.alias("res")))
        trans = reliable_checkpoint(trans.where("w <> 0").withColumnRenamed("w", "len"))
        n_edges = trans.count()
        vj0.release()
        release(verts)
        whole, folders = None, None
        for i in itertools.count():
            frontier = state.where(active).select("id", "res")
            zones = frontier.count()
            if not zones:
                break
            if folders is None and zones > min(p.broadcast_vertex_limit, n // 2):
                whole = whole or VertexJoin(trans, "src", "dst", n, p)
                sent, seen = whole.attach(frontier), []
            else:
                folders = folders or FrontierEdges(trans, n_edges, p)
                sent, zones, seen = folders.leaving(frontier)
            passed = sent.select(F.col("dst").alias("id"), F.lit(0.0).alias("rank"),
                                 (damp * F.col("res") * F.col("len")).alias("res"))
            kept = state.select("id", F.when(active, F.col("rank") + F.col("res")).otherwise(F.col("rank")).alias("rank"),
                                F.when(active, F.lit(0.0)).otherwise(F.col("res")).alias("res"))
            state = reliable_checkpoint(kept.unionByName(passed).groupBy("id").agg(
                F.sum("rank").alias("rank"), F.sum("res").alias("res")))
            if on_round is not None:
                on_round(i, zones, sum(s.get["edges"] for s in seen) if seen else n_edges)
        if whole is not None:
            whole.release()
    return _scaled(state.select("id", (F.col("rank") + F.col("res")).alias("rank")), n, scale)


def hits(graph: Graph, p: Params = DEFAULTS, iterations: int = 20) -> DataFrame:
    """hub/authority scores, L2-normalised.

    Per round: ``auth(v) = Σ_{u→v} hub(u)`` then ``hub(u) = Σ_{u→v} auth(v)``
    with the new authority.  Only the hub vector is carried between rounds
    (each round reads the state once, so the plan grows linearly between
    checkpoints); the authority of the last round is recomputed from the
    hub of the round before.  Hubs are rescaled at each checkpoint (a
    positive rescaling leaves the normalised result unchanged) so that they
    cannot overflow on large graphs.
    """
    with graph_loop(graph.edges, p):
        verts, n = materialize(graph.vertices.select("id"))
        e = graph.edges.select("src", "dst")
        by_src = VertexJoin(e, "src", "dst", n, p)
        by_dst = VertexJoin(e, "dst", "src", n, p)

        # a vertex without in-edges (out-edges) gets no authority (hub) row; it
        # contributes nothing to the next half-step, and is filled with 0 at the end
        def authority(hub: DataFrame) -> DataFrame:
            return by_src.attach(hub).groupBy(F.col("dst").alias("id")).agg(F.sum("hub").alias("auth"))

        def hub_of(auth: DataFrame) -> DataFrame:
            return by_dst.attach(auth).groupBy(F.col("src").alias("id")).agg(F.sum("auth").alias("hub"))

        def l2(df: DataFrame, c: str) -> DataFrame:
            norm = df.agg(F.sqrt(F.sum(F.col(c) * F.col(c)))).scalar()
            return df.select("id", F.try_divide(F.col(c), norm).alias(c))

        hub0 = verts.select("id", F.lit(1.0).alias("hub"))
        if iterations <= 0:
            auth = verts.select("id", F.lit(1.0).alias("auth"))
            hub = hub0
        else:
            hub_prev = run_rounds(hub0, lambda h, _i: hub_of(authority(h)), iterations - 1, p,
                                  after_checkpoint=lambda h: l2(h, "hub"))
            with fixed_plans(graph.edges.sparkSession, p):
                auth = reliable_checkpoint(authority(l2(hub_prev, "hub")))
                hub = reliable_checkpoint(hub_of(auth))
        by_src.release()
        by_dst.release()
        release(verts)
    out = (
        verts.join(l2(hub, "hub"), "id", "left").join(l2(auth, "auth"), "id", "left")
        .select(
            F.col("id").alias("zone_id"),
            F.coalesce(F.col("hub"), F.lit(0.0)).alias("hub"),
            F.coalesce(F.col("auth"), F.lit(0.0)).alias("authority"),
        )
    )
    return out


# ---------------------------------------------------------------- analyses


def pagerank_totals(ranks: DataFrame) -> DataFrame:
    """A10: zones, Σ rank, mean rank (0 when empty)."""
    return ranks.agg(
        F.count(F.lit(1)).alias("total_zones"),
        F.coalesce(F.sum("pagerank"), F.lit(0.0)).alias("total_pagerank"),
        F.coalesce(F.avg("pagerank"), F.lit(0.0)).alias("avg_pagerank"),
    )


def rank_order(score: str = "pagerank", key: str = "zone_id", places: int = 6) -> list:
    """Descending score rounded to ``places`` (float noise cannot flip ties), id ascending."""
    return [F.desc(F.round(F.col(score), places)), F.asc(key)]


def top_pagerank(ranks: DataFrame, k: int = 20) -> DataFrame:
    """Top-k zones, with the ``Zone {id}`` label of the charts."""
    return (
        ranks.orderBy(*rank_order()).limit(k)
        .select("zone_id", "pagerank", F.format_string("Zone %d", F.col("zone_id")).alias("label"))
    )


def rank_concentration(ranks: DataFrame, ks=(10, 20, 50), p: Params = DEFAULTS) -> DataFrame:
    """% of Σ rank held by the top 10/20/50 zones and the power-law verdict.

    The top ``max(ks)`` rows come from a distributed TakeOrdered; the total
    from a scalar subquery — no global sort of the vertex set.
    """
    kmax = max(ks)
    total = ranks.agg(F.sum("pagerank")).scalar()
    top = ranks.orderBy(*rank_order()).limit(kmax)
    # a window over the bounded top-k rows only
    w = top.select("pagerank", F.row_number().over(Window.orderBy(*rank_order())).alias("pos"))
    aggs = [
        (F.try_divide(F.sum(F.when(F.col("pos") <= k, F.col("pagerank"))), total) * 100).alias(f"top{k}_pct")
        for k in ks
    ]
    out = w.agg(*aggs)
    return out.withColumn(
        "power_law", F.col(f"top{ks[0]}_pct") > F.lit(p.power_law_share)
    )



def degree_vs_rank(degrees: DataFrame, ranks: DataFrame) -> DataFrame:
    """Position by total degree vs position by PageRank, per zone.

    Answers "why PageRank rather than degree centrality": zones whose rank
    position differs most from their degree position are those whose
    neighbours' importance, not their own connection count, decides.
    """
    from odgraph.plans.prefix import ranked_prefix

    j = degrees.select("zone_id", (F.col("out_degree") + F.col("in_degree")).alias("total_degree")).join(
        ranks, "zone_id"
    )
    by_deg = ranked_prefix(j, "total_degree", "zone_id").select(
        "zone_id", "total_degree", "pagerank", F.col("pos").alias("degree_pos")
    )
    by_rank = ranked_prefix(j.select("zone_id", "pagerank"), "pagerank", "zone_id").select(
        "zone_id", F.col("pos").alias("rank_pos")
    )
    return by_deg.join(by_rank, "zone_id").withColumn(
        "pos_diff", F.col("degree_pos") - F.col("rank_pos")
    )


def degree_rank_correlation(degrees: DataFrame, ranks: DataFrame) -> DataFrame:
    """Pearson correlation of total degree / strength with PageRank; NaN where
    all zones have one degree, strength or rank (every pair of zones an edge)."""
    j = degrees.join(ranks, "zone_id")
    rank = F.col("pagerank")
    return j.agg(
        correlation((F.col("out_degree") + F.col("in_degree")).cast("double"), rank).alias("degree_corr"),
        correlation((F.col("out_strength") + F.col("in_strength")).cast("double"), rank).alias("strength_corr"),
        F.count(F.lit(1)).alias("num_zones"),
    )
