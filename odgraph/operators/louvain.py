"""Louvain community detection on the symmetrised weighted graph.

Each level runs rounds of simultaneous local moves, all as DataFrame jobs:

1. every node carries its community and that community's total degree; one
   join of the adjacency with that state (skew-safe
   :class:`~odgraph.plans.iterate.VertexJoin`) and a ``groupBy(node,
   community)`` give ``k_{i,C}``, the weight from node ``i`` to community ``C``;
2. the gain of moving ``i`` from ``D`` to ``C`` is ``k_{i,C} - Σtot_C · k_i / 2m``
   less ``k_{i,D∖i} - (Σtot_D - k_i) · k_i / 2m``; a node with a positive gain is
   a candidate for its best community;
3. a set of candidates that cannot hurt each other moves at once:

   * a community either gives or receives members in a round (whichever its
     candidates gain more by; a hashed coin for ties), so the members that a
     move counts on stay where they are;
   * moves that share a community then lower each other's gain by
     ``k_i · k_j / 2m`` at most, so those go ahead whose gain exceeds half of
     that summed over all others of the two communities (each pair is charged
     to both);
   * where no candidate passes, the moves that have the highest priority (gain,
     then hash, then id) at both of their communities go ahead: at most one a
     community, and never none.

Modularity therefore rises in every round, no state returns, and a level ends
by itself when no node gains by moving.  It is kept only if modularity rose.
The graph is then folded — communities become nodes, weights are summed,
internal weight becomes a self-loop — and the next level starts.  The result
maps every original zone to its final community (the smallest member id of the
community at the first level, carried upwards).

A giant community is a hot key of step 1's join of nodes with community
totals: the totals are broadcast within a bound that is checked, beyond it
the nodes of a hot community are salted (:func:`~odgraph.plans.iterate.meet`).
Sums by community need no salt, for every task folds its own rows first.
"""

from __future__ import annotations

import itertools
from contextlib import contextmanager
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odgraph.params import DEFAULTS, Params
from odgraph.plans.iterate import VertexJoin, graph_loop, meet, reliable_checkpoint

#: Called after a round with the level, the round, the moves made and the state ``id, comm``.
OnRound = Callable[[int, int, int, DataFrame], None]


def symmetric_adjacency(edge_list: DataFrame, weight: str = "trip_count") -> DataFrame:
    """``a, b, w`` with ``w = w_ab + w_ba`` in both directions (self-loops once)."""
    w = F.coalesce(F.col(weight).cast("double"), F.lit(0.0))
    e = edge_list.select(F.col("src").cast("long").alias("a"), F.col("dst").cast("long").alias("b"), w.alias("w"))
    both = e.unionByName(
        e.filter(F.col("a") != F.col("b")).select(F.col("b").alias("a"), F.col("a").alias("b"), "w")
    )
    return both.groupBy("a", "b").agg(F.sum("w").alias("w"))


@contextmanager
def _both_ends(adj: DataFrame, state: DataFrame, n: int, p: Params):
    """``adj`` with the communities ``ca``, ``cb`` of both ends; a hub's rows are
    broadcast-joined or salted (:class:`VertexJoin`), caches go on exit."""
    first = VertexJoin(adj, "a", "b", n, p, reuse=False)
    half = first.attach(state.select("id", F.col("comm").alias("ca")))
    second = VertexJoin(half, "b", "a", n, p, reuse=False)
    try:
        yield second.attach(state.select("id", F.col("comm").alias("cb")))
    finally:
        first.release()
        second.release()


def _modularity(adj: DataFrame, state: DataFrame, two_m: float, n: int, p: Params) -> float:
    """Modularity of ``state`` (``id, comm, k``)."""
    tot = state.groupBy("comm").agg(F.sum("k").alias("tot"))
    with _both_ends(adj, state, n, p) as ends:
        inside = reliable_checkpoint(
            ends.filter(F.col("ca") == F.col("cb")).groupBy(F.col("ca").alias("comm")).agg(F.sum("w").alias("ins")))
    q = tot.join(inside, "comm", "left").agg(
        F.sum(F.coalesce(F.col("ins"), F.lit(0.0)) / two_m - F.pow(F.col("tot") / two_m, 2))
    ).first()[0]
    return float(q or 0.0)


def _candidates(vj: VertexJoin, state: DataFrame, two_m: float, n: int, p: Params) -> DataFrame:
    """``id, k, D, C, gain`` of every node; ``C`` is null where no move gains."""
    tot = state.groupBy("comm").agg(F.sum("k").alias("tot"))
    placed = meet(state, "comm", "id", tot, n, p)  # id, comm, k, tot
    if n > p.broadcast_vertex_limit:
        placed = reliable_checkpoint(placed)
    to = vj.attach(placed.select("id", F.col("comm").alias("C"), "tot")).select(F.col("a").alias("id"), "C", "w", "tot")
    own = placed.select("id", F.col("comm").alias("C"), F.lit(0.0).alias("w"), "tot")
    kic = to.unionByName(own).groupBy("id", "C").agg(F.sum("w").alias("kic"), F.max("tot").alias("tot"))
    mine = state.select("id", F.col("comm").alias("D"), "k")
    kic = meet(kic, "id", "C", mine, n, p)
    stays = F.col("C") == F.col("D")
    others = F.when(stays, F.col("tot") - F.col("k")).otherwise(F.col("tot"))
    kic = kic.withColumn("gain", F.col("kic") - others * F.col("k") / F.lit(two_m))
    best = F.max(F.when(~stays, F.struct("gain", (-F.col("C")).alias("c"))))
    out = kic.groupBy("id").agg(F.first("k").alias("k"), F.first("D").alias("D"), best.alias("best"),
                                F.max(F.when(stays, F.col("gain"))).alias("here"))
    gain = F.col("best.gain") - F.col("here")
    moves = gain > F.lit(max(1e-12, 1e-13 * two_m))
    return out.select("id", "k", "D", F.when(moves, -F.col("best.c")).alias("C"), F.when(moves, gain).alias("gain"))


def _each_end(moves: DataFrame) -> DataFrame:
    """One row a move and community: ``comm, joins`` (or leaves) and the move's columns."""
    end = F.explode(F.array(F.struct(F.col("C").alias("comm"), F.lit(True).alias("joins")),
                            F.struct(F.col("D").alias("comm"), F.lit(False).alias("joins"))))
    return moves.withColumn("end", end).select("end.comm", "end.joins", *moves.columns)


def _at_both(moves: DataFrame, table: DataFrame, n: int, p: Params) -> DataFrame:
    """``moves`` with the structs ``at_c`` and ``at_d`` of their communities in ``table``."""
    value = table.select("comm", F.struct(*[c for c in table.columns if c != "comm"]).alias("v"))
    moves = meet(moves, "C", "id", value.withColumnRenamed("v", "at_c"), n, p)
    return meet(moves, "D", "id", value.withColumnRenamed("v", "at_d"), n, p)


def _together(moves: DataFrame, rnd: int, two_m: float, n: int, p: Params) -> DataFrame:
    """The candidates that go ahead side by side (see the module docstring)."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0.0))
    ends = _each_end(moves).groupBy("comm").agg(
        total(F.when(F.col("joins"), F.col("gain"))).alias("by_in"),
        total(F.when(~F.col("joins"), F.col("gain"))).alias("by_out"))
    coin = F.pmod(F.xxhash64("comm", F.lit(rnd)), F.lit(2)) == 0
    roles = ends.select("comm", F.when(F.col("by_in") == F.col("by_out"), coin).otherwise(
        F.col("by_in") > F.col("by_out")).alias("takes"))
    fit = _at_both(moves, roles, n, p).where(F.col("at_c.takes") & ~F.col("at_d.takes")).drop("at_c", "at_d")
    fit = reliable_checkpoint(fit)
    degrees = _each_end(fit).groupBy("comm").agg(F.sum("k").alias("moving"))
    others = F.col("at_c.moving") + F.col("at_d.moving") - 2 * F.col("k")
    return _at_both(fit, degrees, n, p).where(F.col("gain") > F.col("k") * others / F.lit(2 * two_m)).select("id", "C")


def _dominant(moves: DataFrame, rnd: int, n: int, p: Params) -> DataFrame:
    """The moves that come first at both of their communities: one a community at most."""
    first = F.struct("gain", F.xxhash64("id", F.lit(rnd)).alias("h"), "id")
    top = _each_end(moves).groupBy("comm").agg(F.max(first)["id"].alias("top"))
    return _at_both(moves, top, n, p).where((F.col("at_c.top") == F.col("id")) & (F.col("at_d.top") == F.col("id"))).select("id", "C")


def _level(adj: DataFrame, p: Params, two_m: float, level: int, max_rounds: int | None,
           on_round: OnRound | None) -> tuple[DataFrame, int, bool]:
    """State ``id, comm, k`` after the level, its moves and whether it ran to its end."""
    state = reliable_checkpoint(adj.groupBy(F.col("a").alias("id")).agg(F.sum("w").alias("k")).select(
        "id", F.col("id").alias("comm"), "k"))
    n = state.count()
    vj = VertexJoin(adj.filter(F.col("a") != F.col("b")), "b", "a", n, p)
    moved, settled = 0, False
    for rnd in itertools.count() if max_rounds is None else range(max_rounds):
        moves = reliable_checkpoint(_candidates(vj, state, two_m, n, p).where("C is not null"))
        if moves.isEmpty():
            settled = True
            break
        go = reliable_checkpoint(_together(moves, rnd, two_m, n, p))
        number = go.count()
        if not number:
            go = reliable_checkpoint(_dominant(moves, rnd, n, p))
            number = go.count()
        state = reliable_checkpoint(state.join(go, "id", "left").select(
            "id", F.coalesce("C", "comm").alias("comm"), "k"))
        moved += number
        if on_round is not None:
            on_round(level, rnd, number, state.select("id", "comm"))
    vj.release()
    return state, moved, settled


def louvain(edge_list: DataFrame, p: Params = DEFAULTS, weight: str = "trip_count", max_levels: int | None = None,
            max_rounds: int | None = None, on_round: OnRound | None = None) -> DataFrame:
    """``zone_id, community_id`` (bigint), the final ``modularity`` and ``converged``.

    Levels go on until one gains no modularity, the rounds of a level until no
    node gains by moving; ``converged`` is false only where the caller's
    ``max_levels`` or ``max_rounds`` cut that short.
    """
    with graph_loop(edge_list, p):
        return _louvain(edge_list, p, weight, max_levels, max_rounds, on_round)


def _louvain(edge_list: DataFrame, p: Params, weight: str, max_levels: int | None, max_rounds: int | None,
             on_round: OnRound | None) -> DataFrame:
    adj = reliable_checkpoint(symmetric_adjacency(edge_list, weight))
    two_m = float(adj.agg(F.sum("w")).first()[0] or 0.0)
    identity = adj.groupBy(F.col("a").alias("id")).agg(F.sum("w").alias("k")).withColumn("comm", F.col("id"))
    mapping = reliable_checkpoint(identity.select(F.col("id").alias("zone_id"), F.col("id").alias("node")))
    if two_m <= 0:
        return mapping.select(F.col("zone_id").cast("int"), F.col("node").alias("community_id"),
                              F.lit(0.0).alias("modularity"), F.lit(True).alias("converged"))
    n = mapping.count()
    best_q = _modularity(adj, identity, two_m, n, p)
    converged, ended = True, False
    for level in itertools.count() if max_levels is None else range(max_levels):
        state, moved, settled = _level(adj, p, two_m, level, max_rounds, on_round)
        converged &= settled
        q = _modularity(adj, state, two_m, n, p) if moved else best_q
        if q <= best_q + 1e-12:
            ended = True
            break
        best_q = q
        mapping = reliable_checkpoint(
            meet(mapping, "node", "zone_id", state.select("id", "comm"), n, p)
            .select("zone_id", F.col("comm").alias("node"))
        )
        with _both_ends(adj, state, n, p) as ends:
            adj = reliable_checkpoint(
                ends.groupBy(F.col("ca").alias("a"), F.col("cb").alias("b")).agg(F.sum("w").alias("w")))
    return mapping.select(
        F.col("zone_id").cast("int").alias("zone_id"), F.col("node").cast("bigint").alias("community_id")
    ).withColumn("modularity", F.lit(best_q)).withColumn("converged", F.lit(converged and ended))
