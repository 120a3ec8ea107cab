"""Louvain rounds that cannot cycle, and a giant community."""

import random

import pytest
from pyspark.sql import functions as F

from odgraph.operators import community, louvain
from odgraph.params import DEFAULTS
from odgraph.plans.iterate import VertexJoin, fixed_plans

SCHEMA = "src int, dst int, trip_count bigint"


def _q(edges, label):
    """Modularity by direct summation."""
    m = sum(w for _, _, w in edges)
    inside, degree = {}, {}
    for s, d, w in edges:
        for x in (s, d):
            degree[label[x]] = degree.get(label[x], 0) + w
        if label[s] == label[d]:
            inside[label[s]] = inside.get(label[s], 0) + w
    return sum(inside.get(c, 0) / m - (k / (2 * m)) ** 2 for c, k in degree.items())


def test_rounds_never_lower_modularity_and_end(spark):
    """Equal pairs (whose ends would swap for ever) and a ring of cliques."""
    pairs = [(100 + 2 * i, 101 + 2 * i, 3) for i in range(6)] + [(200 + i, 200 + (i + 1) % 8, 1) for i in range(8)]
    cliques = [(10 * c + i, 10 * c + j, 2) for c in range(4) for i in range(4) for j in range(i)]
    ring = [(10 * c, 10 * ((c + 1) % 4) + 1, 1) for c in range(4)]
    edges = pairs + cliques + ring
    states = []
    el = spark.createDataFrame(edges, SCHEMA)
    got = louvain.louvain(el, on_round=lambda level, rnd, moved, s: states.append((level, moved, s)) if level == 0 else None).collect()
    nodes = {x for s, d, _ in edges for x in (s, d)}
    before = _q(edges, {x: x for x in nodes})
    for _, moved, state in states:
        now = _q(edges, {r.id: r.comm for r in state.collect()})
        assert moved and now > before
        before = now
    label = {r.zone_id: r.community_id for r in got}
    assert set(label) == nodes and all(r.converged for r in got)
    assert got[0].modularity == pytest.approx(_q(edges, label), abs=1e-12) and got[0].modularity >= before - 1e-12
    assert len({label[10 * c + i] for c in range(4) for i in range(4)}) == 4
    assert all(label[100 + 2 * i] == label[101 + 2 * i] for i in range(6))


def test_giant_community_is_split_and_changes_nothing(spark):
    """One community holds half of all nodes: its nodes are salted where they meet
    the community's total, and the round's moves are those of the broadcast plan."""
    rng = random.Random(4)
    core = [(i, j, 5) for i in range(24) for j in rng.sample(range(24), 8) if i != j]
    rest = [(100 + i, 100 + (i + 1) % 24, 2) for i in range(24)] + [(i, 100 + i, 9) for i in range(0, 24, 5)]
    adj = louvain.symmetric_adjacency(spark.createDataFrame(core + rest, SCHEMA))
    two_m = adj.agg(F.sum("w")).first()[0]
    state = adj.groupBy(F.col("a").alias("id")).agg(F.sum("w").alias("k")).withColumn(
        "comm", F.when(F.col("id") < 24, F.lit(0)).otherwise(F.col("id"))).select("id", "comm", "k")
    big = DEFAULTS.with_(broadcast_vertex_limit=0, salt_rows=6)
    with fixed_plans(spark, big, 4):
        join = VertexJoin(state, "comm", "id", 25, big, reuse=False)
        assert join.mode == "salted" and [(r._hid, r._nsalt) for r in join.hot.collect()] == [(0, 4)]
        join.release()
        got = []
        for p in (DEFAULTS, big):
            vj = VertexJoin(adj.where("a <> b"), "b", "a", 48, p)
            moves = louvain._candidates(vj, state, two_m, 48, p).where("C is not null")
            got.append([sorted(map(tuple, df.collect())) for df in (
                moves, louvain._together(moves, 0, two_m, 48, p), louvain._dominant(moves, 0, 48, p))])
            vj.release()
    assert got[0] == got[1] and all(got[0])


def test_told_modularity(spark):
    from odgraph.plans.pipeline import Pipeline
    from odgraph.sources.trips import trips

    pp = Pipeline(trips(spark, "/root/testdata/sf0.001"))
    found = pp.louvain
    assert found.columns == ["zone_id", "community_id", "modularity", "converged"]
    q = community.modularity(pp.edge_list, found.select("zone_id", "community_id")).first().modularity
    assert found.first().modularity == pytest.approx(q, abs=1e-9) and found.first().converged
