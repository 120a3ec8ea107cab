import math

from pyspark.sql import functions as F

from odgraph.operators import clean, edges
from odgraph.params import DEFAULTS
from odgraph.sources import fixtures


def _rows(df, order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_clean_dirty_trips(spark):
    t = fixtures.dirty_trips(spark)
    kept = clean.clean_trips(t)
    assert kept.count() == 8
    audit = clean.cleaning_audit(t).first()
    assert audit.original_rows == 15 and audit.kept_rows == 8 and audit.removed_rows == 7
    assert math.isclose(audit.removed_pct, 46.666666666666664)
    assert audit.null_pickup == 1 and audit.null_dropoff == 1 and audit.self_loops == 1
    assert audit.negative_fare == 1 and audit.null_fare == 1


def test_edge_list_matches_fixture(spark):
    el = edges.build_edge_list(clean.clean_trips(fixtures.dirty_trips(spark)))
    got = _rows(el, ["src", "dst"])
    assert got == sorted(fixtures.DIRTY_EDGES)


def test_invariants_on_sf0001(spark):
    from odgraph.sources.trips import trips

    t = trips(spark, "/root/testdata/sf0.001")
    c = clean.clean_trips(t)
    el = edges.build_edge_list(c)
    assert el.agg(F.sum("trip_count")).first()[0] == c.count() == 5685
    assert el.count() == 3909
    tot = edges.graph_totals(el).first()
    assert tot.num_vertices == 258 and tot.num_edges == 3909
    deg = edges.degree_table(el).agg(F.sum("out_degree"), F.sum("in_degree")).first()
    assert deg[0] == deg[1] == 3909


def test_heavy_share_without_heavy_edges(spark):
    el = edges.build_edge_list(clean.clean_trips(fixtures.dirty_trips(spark)))
    r = edges.heavy_edge_share(el, DEFAULTS).first()
    assert r.heavy_edges == 0 and r.heavy_trips == 0 and r.heavy_trip_pct == 0.0


def test_empty_input(spark):
    t = fixtures.empty_trips(spark)
    el = edges.build_edge_list(clean.clean_trips(t))
    assert el.count() == 0
    a = clean.cleaning_audit(t).first()
    assert a.original_rows == 0 and a.removed_pct is None
    r = edges.heavy_edge_share(el).first()
    assert r.total_trips == 0 and r.heavy_trip_pct is None
    tot = edges.graph_totals(el).first()
    assert tot.num_edges == 0 and tot.trips_per_edge is None


def test_degree_centrality_keeps_null_keys_apart(spark):
    t = fixtures.dirty_trips(spark)
    d = edges.degree_centrality(t)
    # the null pickup group and the null dropoff group stay two unmatched rows
    nulls = d.filter(F.col("zone_id").isNull()).collect()
    assert len(nulls) == 2
    assert sorted(str((r.out_degree, r.in_degree)) for r in nulls) == ["(1, None)", "(None, 1)"]


def test_cleaning_filter_is_pushed_to_parquet(spark, tmp_path):
    from odgraph.sources.trips import read_trips

    path = str(tmp_path / "trips")
    fixtures.dirty_trips(spark).write.parquet(path)
    df = clean.clean_trips(read_trips(spark, path))
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pushed = [ln for ln in plan.splitlines() if "PushedFilters" in ln][0]
    for f in ("IsNotNull(PULocationID)", "GreaterThanOrEqual(PULocationID,1)", "LessThanOrEqual(DOLocationID,263)",
              "GreaterThanOrEqual(fare_amount,0.0)"):
        assert f in pushed
    assert "ReadSchema: struct<PULocationID:bigint,DOLocationID:bigint,trip_distance:double" in plan


def test_monthly_files_with_drifting_columns(spark, tmp_path):
    from odgraph.sources.trips import read_trips

    base = fixtures.dirty_trips(spark)
    jan = str(tmp_path / "m01.parquet")
    feb = str(tmp_path / "m02.parquet")
    base.limit(8).write.parquet(jan)
    base.withColumn("airport_fee", F.lit(1.25)).write.parquet(feb)  # a column added later
    t = read_trips(spark, [jan, feb], merge_schema=True)
    assert t.columns == ["PULocationID", "DOLocationID", "trip_distance", "fare_amount", "tip_amount"]
    assert t.count() == 8 + 15
    g = read_trips(spark, str(tmp_path / "m0*.parquet"), merge_schema=True)  # path glob (S3)
    assert g.count() == 23


def test_id_widths_mix_and_bad_ids_are_cleaned(spark, tmp_path):
    """Files with 32- and 64-bit ids and float amounts read together; an id beyond
    32 bits is cleaned, and the rule reaches the files of either width."""
    from odgraph.sources.trips import read_trips

    base = fixtures.dirty_trips(spark)
    narrow, wide = str(tmp_path / "m01.parquet"), str(tmp_path / "m02.parquet")
    base.withColumn("fare_amount", F.col("fare_amount").cast("float")).write.parquet(narrow)
    big = base.withColumns({c: F.col(c).cast("bigint") for c in ("PULocationID", "DOLocationID")})
    big.unionAll(spark.createDataFrame([(3_000_000_000, 5, 1.0, 1.0, 1.0), (5, 1 << 40, 1.0, 1.0, 1.0)], big.schema)
                 ).write.parquet(wide)
    once = sorted(map(str, clean.clean_trips(base).collect()))
    for paths in ([narrow, wide], [wide, narrow], str(tmp_path / "m0*.parquet")):
        t = read_trips(spark, paths)
        assert t.count() == 2 * base.count() + 2
        kept = clean.clean_trips(t)
        assert dict(kept.dtypes)["PULocationID"] == dict(kept.dtypes)["DOLocationID"] == "int"
        assert sorted(map(str, kept.collect())) == sorted(2 * once)
        audit = clean.cleaning_audit(t).first()
        assert audit.original_rows == t.count() and audit.kept_rows == 2 * len(once)
    plan = spark._jvm.PythonSQLUtils.explainString(
        clean.clean_trips(read_trips(spark, wide))._jdf.queryExecution(), "formatted")
    pushed = [ln for ln in plan.splitlines() if "PushedFilters" in ln][0]
    assert "GreaterThanOrEqual(PULocationID,1)" in pushed and "LessThanOrEqual(DOLocationID,263)" in pushed


def test_edge_list_of_the_pipeline_is_pushed(spark, tmp_path):
    from odgraph.plans.pipeline import Pipeline
    from odgraph.sources.trips import read_trips

    path = str(tmp_path / "trips")
    fixtures.dirty_trips(spark).write.parquet(path)
    pp = Pipeline(read_trips(spark, path))
    plan = spark._jvm.PythonSQLUtils.explainString(edges.build_edge_list(pp.clean)._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(PULocationID,1)" in [ln for ln in plan.splitlines() if "PushedFilters" in ln][0]
    assert pp.audit.first().kept_rows == pp.edge_list.agg(F.sum("trip_count")).first()[0]
