"""Exact samples (S14), k-means with a certificate (G8), counts in one scan (B1)."""

import math

import pytest
from pyspark.sql import functions as F

from odgraph.operators import scaling, zones
from odgraph.sources import fixtures


@pytest.mark.parametrize("few", [10_000, 3])
def test_sample_has_its_size_whatever_the_splits(spark, few):
    df = spark.range(5000).select((F.col("id") % 1250).alias("a"), (F.col("id") % 7).cast("int").alias("b"), "id").dropDuplicates(["a", "b"])
    n = df.count()
    for share in (0.0, 0.0004, 0.05, 0.5, 1.0):
        got = [sorted(r.id for r in scaling.exact_sample(frame, share, keys=("a", "b"), few=few).select("id").collect())
               for frame in (df.repartition(7), df.coalesce(1))]
        assert got[0] == got[1] and len(got[0]) == math.floor(share * n + 0.5)
    other = sorted(r.id for r in scaling.exact_sample(df, 0.05, seed=1, keys=("a", "b")).collect())
    same = sorted(r.id for r in scaling.exact_sample(df, 0.05, seed=42, keys=("a", "b")).collect())
    assert other != same
    assert scaling.exact_sample(df.limit(0), 0.5, keys=("a", "b")).count() == 0
    with pytest.raises(ValueError):
        scaling.exact_sample(df, 1.5)


def test_kmeans_certificate(spark):
    """Each zone is in its nearest centre's cluster, each centre is the mean of its zones."""
    rows = [(i, *[float(((i * 37 + j * 11) % 50) + (40 * (i % 3) if j < 3 else 0)) for j in range(6)], 1.0) for i in range(90)]
    df = spark.createDataFrame(rows, "zone_id int, " + ", ".join(f"{c} double" for c in zones.FEATURES))
    got = zones.zone_kmeans(df, k=3).collect()
    assert all(r.converged for r in got) and len(got) == 90
    x = {r.zone_id: list(r.x) for r in zones._standardised(df).collect()}
    assert all(v[6] == 0.0 for v in x.values())  # a constant feature
    label = {r.zone_id: r.cluster for r in got}
    centre = {c: [sum(v) / len(v) for v in zip(*[x[z] for z in x if label[z] == c])] for c in set(label.values())}
    away = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    for z in x:
        assert away(x[z], centre[label[z]]) <= min(away(x[z], c) for c in centre.values()) + 1e-9
    assert sorted(map(tuple, zones.zone_kmeans(df.repartition(5), k=3).select("zone_id", "cluster").collect())) == sorted(label.items())
    assert not zones.zone_kmeans(df, k=3, max_rounds=1).first().converged
    same = spark.createDataFrame([(i, *[1.0] * 7) for i in range(4)], df.schema)
    assert {r.cluster for r in zones.zone_kmeans(same).collect()} == {0}
    assert zones.zone_kmeans(df.limit(0)).collect() == []


def test_build_counts_take_one_scan(spark):
    from odgraph.sources.trips import trips

    counts = scaling.build_counts(trips(spark, "/root/testdata/sf0.01"))
    plan = spark._jvm.PythonSQLUtils.explainString(counts._jdf.queryExecution(), "simple")
    assert plan.count("FileScan parquet") == 1
    assert tuple(counts.first()) == (60000, 54916, 12249)
    dirty = scaling.build_counts(fixtures.dirty_trips(spark)).first()
    assert tuple(dirty) == (15, sum(e[2] for e in fixtures.DIRTY_EDGES), len(fixtures.DIRTY_EDGES))
    assert tuple(scaling.build_counts(fixtures.empty_trips(spark)).first()) == (0, 0, 0)
