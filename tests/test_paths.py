"""Frontier relaxation and routes (G10) against direct computations."""

import heapq
import random

import pytest

from odgraph.operators import paths
from odgraph.params import DEFAULTS

SCHEMA = "src int, dst int, trip_count bigint, avg_distance double"


def _labels(edges, source):
    """Least (distance, edges, previous zone) of every zone, by Dijkstra."""
    out, heap, best = {}, [(0.0, 0, -1, source)], {}
    for s, d, _, w in edges:
        out.setdefault(s, []).append((d, w))
    while heap:
        dist, steps, prev, at = heapq.heappop(heap)
        if at in best:
            continue
        best[at] = (dist, steps, prev)
        for d, w in out.get(at, []):
            heapq.heappush(heap, (dist + w, steps + 1, at, d))
    return best


def _random_edges(seed, n=24, m=70):
    rng = random.Random(seed)
    pairs = {(rng.randrange(n), rng.randrange(n)) for _ in range(m)}
    return [(s, d, 1, float(rng.randint(0, 4))) for s, d in sorted(pairs) if s != d]


@pytest.mark.parametrize("p", [DEFAULTS, DEFAULTS.with_(broadcast_vertex_limit=3, edges_per_bucket=40, salt_rows=8)])
def test_labels_and_routes(spark, p):
    edges = _random_edges(7)
    el = spark.createDataFrame(edges, SCHEMA)
    want = _labels(edges, 5)
    if p is DEFAULTS:
        got = {r.zone_id: r for r in paths.shortest_paths(el, source=5).collect()}
        assert {z: (r.distance, r.steps, r.previous if r.steps else -1) for z, r in got.items() if r.distance is not None} == want
    routes = {}
    for r in paths.shortest_route(el, source=5, p=p).collect():
        assert r.distance == want[r.via][0]
        routes.setdefault(r.zone_id, {})[r.step] = r.via
    assert set(routes) == set(want)
    for z, steps in routes.items():
        way, at = [z], z
        while at != 5:
            at = want[at][2]
            way.append(at)
        assert [steps[k] for k in range(len(steps))] == way[::-1]


def test_routes_on_a_long_chain(spark):
    chain = [(i, i + 1, 1, 0.5) for i in range(1, 16)] + [(20, 21, 1, 1.0)]
    el = spark.createDataFrame(chain, SCHEMA)
    rows = paths.shortest_route(el, source=1, targets=spark.createDataFrame([(16,), (5,), (16,), (21,)], "zone_id int")).collect()
    got = {z: [(r.step, r.via, r.distance) for r in sorted(rows, key=lambda r: r.step) if r.zone_id == z] for z in (5, 16, 21)}
    assert got[16] == [(k, k + 1, 0.5 * k) for k in range(16)] and got[5] == got[16][:5] and got[21] == []
    assert paths.shortest_route(el.limit(0)).collect() == []


def test_late_rounds_read_few_edges(spark):
    """A hub with most edges in round 0, then a chain: later rounds read only the
    folders of the chain's zones."""
    star = [(0, z, 1, 1.0) for z in range(1, 301)]
    mesh = [(z, z % 300 + 1, 1, 1.0) for z in range(1, 301)]
    chain = [(300 + k, 301 + k, 1, 1.0) for k in range(12)]
    el = spark.createDataFrame(star + mesh + chain, SCHEMA)
    rounds = []
    p = DEFAULTS.with_(edges_per_bucket=4)
    got = paths.hop_distance(el, source=0, p=p, on_round=lambda *r: rounds.append(r))
    assert {r.zone_id: r.hops for r in got.collect()} == {0: 0} | {z: 1 for z in range(1, 301)} | {301 + k: 2 + k for k in range(12)}
    assert [zones for _, zones, _ in rounds] == [1, 300] + [1] * 12
    assert rounds[0][2] >= 300 and all(edges < 30 for _, _, edges in rounds[2:])
