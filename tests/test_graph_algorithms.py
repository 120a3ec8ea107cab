import numpy as np
import pytest
from pyspark.sql import functions as F

from odgraph.graph import Graph
from odgraph.operators import community, rank
from odgraph.sources import fixtures


def _toy(spark):
    return Graph.from_edge_list(fixtures.toy_edge_list(spark))


@pytest.mark.parametrize("iters", [1, 2, 20])
def test_pagerank_golden(spark, iters):
    got = {r.zone_id: r.pagerank for r in rank.pagerank(_toy(spark), iterations=iters).collect()}
    for k, v in fixtures.TOY_PAGERANK[iters].items():
        assert abs(got[k] - v) < 1e-8
    assert abs(sum(got.values()) - 10.0) < 1e-9


def test_pagerank_salted_path_equals_broadcast(spark, tiny_params):
    a = {r.zone_id: r.pagerank for r in rank.pagerank(_toy(spark), iterations=20).collect()}
    b = {r.zone_id: r.pagerank for r in rank.pagerank(_toy(spark), tiny_params, iterations=20).collect()}
    assert a.keys() == b.keys()
    assert max(abs(a[k] - b[k]) for k in a) < 1e-12


def _dense(edges, n=10, weights=None):
    a = np.zeros((n, n))
    for i, (s, d) in enumerate(edges):
        a[s - 1, d - 1] += 1.0 if weights is None else weights[i]
    return a


def test_weighted_pagerank_brute_force(spark):
    w = [float(i % 3 + 1) for i in range(len(fixtures.TOY_EDGES))]
    el = spark.createDataFrame(
        [(s, d, int(x)) for (s, d), x in zip(fixtures.TOY_EDGES, w)], "src int, dst int, trip_count bigint"
    )
    got = {r.zone_id: r.pagerank for r in rank.pagerank(Graph.from_edge_list(el), weight="weight").collect()}
    a = _dense(fixtures.TOY_EDGES, weights=w)
    p = np.divide(a, a.sum(1, keepdims=True), out=np.zeros_like(a), where=a.sum(1, keepdims=True) > 0)
    r = np.ones(10)
    for _ in range(20):
        r = 0.15 + 0.85 * p.T @ r
    r = r * 10 / r.sum()
    for k in range(10):
        assert abs(got[k + 1] - r[k]) < 1e-9


def test_hits_brute_force(spark, tiny_params):
    a = _dense(fixtures.TOY_EDGES)
    h = np.ones(10)
    for _ in range(20):
        au = a.T @ h
        h = a @ au
    h, au = h / np.linalg.norm(h), au / np.linalg.norm(au)
    for params in (None, tiny_params):
        got = rank.hits(_toy(spark), params or rank.DEFAULTS).collect()
        for r in got:
            assert abs(r.hub - h[r.zone_id - 1]) < 1e-9
            assert abs(r.authority - au[r.zone_id - 1]) < 1e-9


def test_pagerank_tolerance_matches_long_run(spark):
    tol = rank.pagerank_to_tolerance(_toy(spark), max_iterations=100).collect()
    ref = {r.zone_id: r.pagerank for r in rank.pagerank(_toy(spark), iterations=100).collect()}
    assert tol[0].iterations < 100
    for r in tol:
        assert abs(r.pagerank - ref[r.zone_id]) < 1e-4


def _fixpoint(edges, zones, weights=None):
    a = np.zeros((len(zones), len(zones)))
    at = {z: k for k, z in enumerate(zones)}
    for i, (s, d) in enumerate(edges):
        a[at[s], at[d]] += 1.0 if weights is None else weights[i]
    out = a.sum(1, keepdims=True)
    m = np.divide(a, out, out=np.zeros_like(a), where=out > 0)
    r = np.linalg.solve(np.eye(len(zones)) - 0.85 * m.T, np.full(len(zones), 0.15))
    return dict(zip(zones, r * len(zones) / r.sum()))


@pytest.mark.parametrize("knobs", [{}, {"broadcast_vertex_limit": 2, "edges_per_bucket": 3, "salt_rows": 2}])
def test_residual_pagerank_reaches_the_fixpoint(spark, knobs):
    w = [float(i % 3) for i in range(len(fixtures.TOY_EDGES))]
    el = spark.createDataFrame([(s, d, int(x)) for (s, d), x in zip(fixtures.TOY_EDGES, w)],
                               "src int, dst int, trip_count bigint")
    g, p = Graph.from_edge_list(el), rank.DEFAULTS.with_(**knobs)
    for weight, weights in ((None, None), ("weight", w)):
        got = {r.zone_id: r.pagerank for r in rank.pagerank_residual(g, p, 1e-6, weight).collect()}
        want = _fixpoint(fixtures.TOY_EDGES, list(range(1, 11)), weights)
        assert got.keys() == want.keys() and max(abs(got[z] - want[z]) for z in want) < 1e-4
    assert rank.pagerank_residual(Graph.from_edge_list(el.limit(0))).collect() == []


def test_residual_pagerank_follows_active_zones(spark):
    """60 pairs that end after one step and one long cycle: late rounds read the
    folders of the cycle only."""
    edges = [(1000 + 2 * k, 1001 + 2 * k) for k in range(60)] + [(k, (k + 1) % 5) for k in range(5)] + [(9, 0)]
    el = spark.createDataFrame([(s, d, 1) for s, d in edges], "src int, dst int, trip_count bigint")
    rounds = []
    p = rank.DEFAULTS.with_(edges_per_bucket=2)
    got = rank.pagerank_residual(Graph.from_edge_list(el), p, 1e-3, on_round=lambda *r: rounds.append(r)).collect()
    want = _fixpoint(edges, sorted({z for e in edges for z in e}))
    assert max(abs(r.pagerank - want[r.zone_id]) for r in got) < 0.05
    zones = [z for _, z, _ in rounds]
    assert zones[:2] == [62, 62] and set(zones[2:]) <= {1, 2}
    assert all(read < 20 for _, _, read in rounds[2:])


def test_ranks_that_sum_to_one(spark):
    n = {r.zone_id: r.pagerank for r in rank.pagerank(_toy(spark)).collect()}
    one = {r.zone_id: r.pagerank for r in rank.pagerank(_toy(spark), scale="1").collect()}
    assert abs(sum(one.values()) - 1) < 1e-12 and all(abs(one[z] - n[z] / 10) < 1e-12 for z in n)


@pytest.mark.parametrize("iters", [1, 2, 3, 10])
def test_label_propagation_golden(spark, iters):
    got = community.label_propagation(_toy(spark), iterations=iters).orderBy("zone_id").collect()
    assert [r.community_id for r in got] == fixtures.TOY_LABELS[iters]


def test_label_propagation_salted(spark, tiny_params):
    got = community.label_propagation(_toy(spark), tiny_params, iterations=10).orderBy("zone_id").collect()
    assert [r.community_id for r in got] == fixtures.TOY_LABELS[10]


def test_lpa_sf001_communities(spark):
    from odgraph.plans.pipeline import Pipeline
    from odgraph.sources.trips import trips

    pp = Pipeline(trips(spark, "/root/testdata/sf0.01"))
    n = pp.communities.select("community_id").distinct().count()
    assert n == 9
    assert pp.communities.count() == 263
    conn = community.connectivity(pp.edge_list, pp.communities).first()
    assert conn.intra_trips + conn.inter_trips == conn.total_trips
    assert abs(pp.ranks.agg(F.sum("pagerank")).first()[0] - 263) < 1e-6


def test_modularity_of_planted_blocks(spark):
    el = fixtures.toy_edge_list(spark)
    comm = spark.createDataFrame([(i, 1 if i <= 7 else 8) for i in range(1, 11)], "zone_id int, community_id bigint")
    q = community.modularity(el, comm).first().modularity
    # brute force on the symmetrised graph
    a = _dense(fixtures.TOY_EDGES)
    s = a + a.T
    k = s.sum(1)
    m2 = s.sum()
    lab = [1 if i < 7 else 8 for i in range(10)]
    qq = sum(s[i, j] - k[i] * k[j] / m2 for i in range(10) for j in range(10) if lab[i] == lab[j]) / m2
    assert abs(q - qq) < 1e-12
