from pyspark.sql import functions as F

from odgraph.operators import report, scaling
from odgraph.sources import fixtures


def _ranks(spark, n=500):
    rows = [(i, float((i * 7919) % 101) / 10.0 + 0.01) for i in range(1, n + 1)]
    return spark.createDataFrame(rows, "zone_id int, pagerank double")


def test_histogram_sums_to_n(spark):
    r = _ranks(spark)
    h = report.histogram(r, "pagerank", 50)
    assert h.count() == 50
    assert h.agg(F.sum("count")).first()[0] == 500
    # max lands in the last (right-closed) bin
    assert h.filter("bin = 49").first()["count"] >= 1


def test_histogram_constant_column(spark):
    r = spark.createDataFrame([(1, 2.0), (2, 2.0)], "zone_id int, pagerank double")
    h = report.histogram(r, "pagerank", 5).orderBy("bin").collect()
    assert [x["count"] for x in h] == [2, 0, 0, 0, 0]


def test_parallel_prefix_equals_running_sum(spark):
    r = _ranks(spark)
    got = report.cumulative_share(r).orderBy("pos").collect()
    rows = sorted(((-round(x.pagerank, 6), x.zone_id, x.pagerank) for x in r.collect()))
    total, cum = sum(x[2] for x in rows), 0.0
    assert [x.zone_id for x in got] == [x[1] for x in rows]
    assert [x.pos for x in got] == list(range(1, len(rows) + 1))
    for x, (_, _, value) in zip(got, rows):
        cum += value
        assert abs(x.cum_pct - cum / total * 100) < 1e-9


def test_speedup_fixture(spark):
    m = fixtures.metrics(spark)
    cmp = {r.test: r for r in scaling.compare_metrics(m.filter("mode = 'single'"), m.filter("mode = 'cluster'")).collect()}
    assert cmp["data_loading"].speedup == 2.0
    assert cmp["graph_construction"].speedup == 1.5  # first row per test wins
    assert cmp["pagerank_simulation"].speedup is None
    sr = {r.mode: r.success_pct for r in scaling.success_rate(m).collect()}
    assert sr == {"single": 75.0, "cluster": 100.0}


def test_hash_sample_nested_and_sweep(spark):
    from odgraph.sources.trips import trips

    t = trips(spark, "/root/testdata/sf0.01")
    assert scaling.hash_sample(t, 5).count() == 2931
    sw = {r.sample_pct: r for r in scaling.sweep_counts(t).collect()}
    assert sw[100].raw_rows == 60000 and sw[100].cleaned_rows == 54916 and sw[100].edges == 12249
    assert sw[5].raw_rows == 2931
    assert sw[1].edges <= sw[5].edges <= sw[10].edges


def test_run_summary_coalesces(spark):
    b = spark.createDataFrame([("r", "build_graph", 0.1, 2.0)], "run_name string, step string, sample_fraction double, runtime_minutes double")
    p = spark.createDataFrame([("r", "pagerank", 0.1, 3.0)], "run_name string, step string, sample_fraction double, total_runtime_minutes double")
    got = sorted((r.step, r.runtime_minutes) for r in scaling.run_summary(b, p).collect())
    assert got == [("build_graph", 2.0), ("pagerank", 3.0)]
