import datetime as dt
from collections import deque

import pytest
from pyspark.sql import functions as F

from odgraph.operators import clean, community, louvain, paths, temporal
from odgraph.params import DEFAULTS
from odgraph.plans.iterate import reliable_checkpoint
from odgraph.sources import fixtures, io
from odgraph.streaming import edges as sedges

SCHEMA = "PULocationID int, DOLocationID int, trip_distance double, fare_amount double, tip_amount double, pickup_ts timestamp"


def _trip(pu, do, day, fare=10.0):
    return (pu, do, 1.0, fare, 1.0, dt.datetime(2024, 1, 1) + dt.timedelta(days=day))


def test_stream_equals_batch_and_drops_late_rows(spark, tmp_path):
    src = tmp_path / "src"
    first = [_trip(1, 2, d) for d in range(0, 60, 3)] + [_trip(2, 3, d, 5.0) for d in range(1, 60, 7)]
    spark.createDataFrame(first, SCHEMA).coalesce(1).write.parquet(str(src / "a"))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    kw = dict(schema=spark.createDataFrame([], SCHEMA).schema, duration="7 days", watermark="14 days",
              max_files_per_trigger=1)
    sedges.run_stream_edges(spark, str(src / "a"), out, ck, **kw)
    got = sedges.read_stream_result(spark, out, live=True).select("window_start", "src", "dst", "trip_count")
    batch = temporal.edges_by_window(spark.createDataFrame(first, SCHEMA), "7 days").select(
        "window_start", "src", "dst", "trip_count"
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))

    # a second file arrives later: one on-time trip and one far behind the watermark
    late = [_trip(1, 2, 58), _trip(3, 4, -30)]
    spark.createDataFrame(late, SCHEMA).coalesce(1).write.parquet(str(src / "a" / "b"))
    sedges.run_stream_edges(spark, str(src / "a"), out, ck, **kw)
    res = sedges.read_stream_result(spark, out, live=True)
    assert res.filter((F.col("src") == 3) & (F.col("dst") == 4)).count() == 0
    last = res.filter((F.col("src") == 1) & (F.col("dst") == 2)).orderBy(F.desc("window_start")).first()
    assert last.trip_count == 2  # day 57 and the on-time day-58 trip share a window


def test_louvain_not_worse_than_lpa(spark):
    from odgraph.plans.pipeline import Pipeline
    from odgraph.sources.trips import trips

    pp = Pipeline(trips(spark, "/root/testdata/sf0.001"))
    lv = louvain.louvain(pp.edge_list).select("zone_id", "community_id")
    assert lv.count() == 258
    q_lv = community.modularity(pp.edge_list, lv).first().modularity
    q_lpa = community.modularity(pp.edge_list, pp.communities).first().modularity
    assert q_lv >= q_lpa - 1e-12


def test_hop_distance_brute_force(spark):
    el = fixtures.toy_edge_list(spark).withColumn("avg_distance", (F.col("src") + F.col("dst")).cast("double"))
    got = {r.zone_id: (r.hops, r.distance) for r in paths.hop_distance(el, source=4).collect()}
    adj = {}
    for s, d in fixtures.TOY_EDGES:
        adj.setdefault(s, []).append(d)
    hops, q = {4: 0}, deque([4])
    while q:
        u = q.popleft()
        for v in adj.get(u, []):
            if v not in hops:
                hops[v] = hops[u] + 1
                q.append(v)
    dist = {4: 0.0}
    for _ in range(10):
        for s, d in fixtures.TOY_EDGES:
            if s in dist and dist[s] + s + d < dist.get(d, float("inf")):
                dist[d] = dist[s] + s + d
    for z in range(1, 11):
        assert got[z][0] == hops.get(z)
        assert got[z][1] == dist.get(z)


def test_io_helpers(spark, tmp_path):
    df = spark.range(50).select(F.col("id").cast("int").alias("zone_id"), (F.col("id") / 10.0).alias("pagerank"))
    p = io.save_dataframe_as_csv(df, str(tmp_path / "s"), sample_size=5)
    assert io.read_csv(spark, p, "zone_id int, pagerank double").count() == 5
    top = io.export_top(df, str(tmp_path / "top"), k=3)
    assert [r.zone_id for r in io.read_csv(spark, top, "zone_id int, pagerank double").collect()] == [49, 48, 47]
    assert io.csv_path_for("/x/graph/edges") == "/x/graph_csv/edges"
    from odgraph.operators.scaling import BUILD_METRICS

    m = spark.createDataFrame([("r1", "build_graph", 0.1, 1, 1, 1, 1.0, 0.1, "t")], BUILD_METRICS)
    io.save_metrics_json(m, str(tmp_path / "m1"), "20240101_000000")
    io.save_metrics_json(m.unionAll(m).selectExpr("'r2' AS run_name", "* EXCEPT (run_name)"), str(tmp_path / "m1"))
    back = io.read_metrics_json(spark, str(tmp_path / "m1"), BUILD_METRICS)
    assert back.count() == 3
    assert [r.run_name for r in io.latest_metrics(back).collect()] == ["r2", "r2"]


def test_months_filter(spark):
    from odgraph.sources.trips import months_filter, trips

    t = trips(spark, "/root/testdata/sf0.01")
    n = months_filter(t, ["1995-01", "1995-02", "1995-03"]).count()
    m = t.filter((F.col("pickup_ts") >= "1995-01-01") & (F.col("pickup_ts") < "1995-04-01")).count()
    assert n == m == 2128


def test_empty_graph_everywhere(spark):
    from odgraph.graph import Graph
    from odgraph.operators import rank, report

    el = spark.createDataFrame([], "src int, dst int, trip_count bigint, avg_distance double")
    g = Graph.from_edge_list(el)
    pr = rank.pagerank(g, iterations=3)
    assert pr.count() == 0 and pr.columns == ["zone_id", "pagerank"]
    lp = community.label_propagation(g, iterations=2)
    assert lp.count() == 0 and lp.columns == ["zone_id", "community_id"]
    h = rank.hits(g, iterations=2)
    assert h.count() == 0 and h.columns == ["zone_id", "hub", "authority"]
    lv = louvain.louvain(el)
    assert lv.count() == 0
    hd = paths.hop_distance(el)
    assert hd.count() == 0
    assert report.cumulative_share(pr).count() == 0
    conn = community.connectivity(el, lp).first()
    assert conn.total_trips == 0 and conn.verdict == "no data"


def test_louvain_large_graph_path_matches(spark, tiny_params):
    el = fixtures.toy_edge_list(spark)
    a = sorted(map(tuple, louvain.louvain(el).collect()))
    b = sorted(map(tuple, louvain.louvain(el, tiny_params).collect()))
    assert a == b


def test_backlog_stream_equals_batch_for_unordered_files(spark, tmp_path):
    """Six files without any time order, one file a micro-batch: no trip is lost."""
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    trips = [_trip(1 + i % 5, 2 + i % 3, (i * 37) % 200, float(i)) for i in range(120)]
    df = spark.createDataFrame(trips, SCHEMA)
    for k in range(6):
        spark.createDataFrame(trips[k::6], SCHEMA).coalesce(1).write.mode("append").parquet(src)
    sedges.run_stream_edges(spark, src, out, str(tmp_path / "ck"), schema=df.schema, max_files_per_trigger=1)
    want = sorted(map(tuple, temporal.edges_by_window(clean.clean_trips(df), "7 days").collect()))

    def got(path):
        rows = sedges.read_stream_result(spark, path)
        return sorted(map(tuple, rows.select("window_start", "src", "dst", "trip_count", "total_fare").collect()))

    assert len(list((tmp_path / "out").glob("batch_id=*"))) == 6
    assert got(out) == want
    assert got(sedges.compact_stream_result(spark, out, str(tmp_path / "small"))) == want


def test_hop_distance_on_a_long_chain(spark):
    """Sixteen zones in a row: every hop and distance, none cut off."""
    chain = [(i, i + 1, 1, 0.5 * i) for i in range(1, 16)] + [(20, 21, 1, 1.0)]
    el = spark.createDataFrame(chain, "src int, dst int, trip_count bigint, avg_distance double")
    got = {r.zone_id: (r.hops, r.distance) for r in paths.hop_distance(el, source=1).collect()}
    want = {z: (z - 1, sum(0.5 * i for i in range(1, z))) for z in range(1, 17)}
    assert got == want | {20: (None, None), 21: (None, None)}
    short = {r.zone_id: r.hops for r in paths.hop_distance(el, source=1, max_hops=3).collect()}
    assert short[4] == 3 and short[5] is None
    loop = spark.createDataFrame([(1, 2, 1, 1.0), (2, 1, 1, -2.0)], el.schema)
    with pytest.raises(ValueError):
        paths.hop_distance(loop, source=1)


def test_operators_release_what_they_cache(spark, tiny_params):
    from odgraph.graph import Graph
    from odgraph.operators import rank

    el = reliable_checkpoint(fixtures.toy_edge_list(spark).withColumn("avg_distance", F.lit(1.0)))
    g = Graph.from_edge_list(el)
    count = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    for p in (DEFAULTS, tiny_params):
        start = count()
        rank.pagerank(g, p, iterations=3)
        comm = community.label_propagation(g, p, iterations=3)
        community.connectivity(el, comm, p).collect()
        rank.hits(g, p, iterations=2)
        paths.hop_distance(el, source=4, p=p)
        louvain.louvain(el, p)
        assert count() == start, p


def test_loops_with_many_partitions_give_the_same_results(spark):
    from odgraph.graph import Graph
    from odgraph.operators import rank

    el = fixtures.toy_edge_list(spark).withColumn("avg_distance", F.lit(1.0))
    g = Graph.from_edge_list(el)
    many = DEFAULTS.with_(edges_per_partition=2)
    rows = lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())
    assert rows(rank.pagerank(g, iterations=5)) == rows(rank.pagerank(g, many, iterations=5))
    assert rows(rank.hits(g, iterations=3)) == rows(rank.hits(g, many, iterations=3))
    assert rows(community.label_propagation(g)) == rows(community.label_propagation(g, many))
    assert rows(paths.hop_distance(el, source=4)) == rows(paths.hop_distance(el, source=4, p=many))
