"""Degenerate correlations, and every column of a metric file."""

import math
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from odgraph.functions.exprs import correlation
from odgraph.operators import rank


def test_correlation_where_all_zones_have_one_degree(spark):
    """Three zones with every edge between them: one degree, one rank, several strengths."""
    degrees = spark.createDataFrame([(z, 2, 2, 5 + z, 7) for z in (1, 2, 3)],
                                    "zone_id int, out_degree long, in_degree long, out_strength long, in_strength long")
    ranks = spark.createDataFrame([(1, 0.5), (2, 1.0), (3, 1.75)], "zone_id int, pagerank double")
    row = rank.degree_rank_correlation(degrees, ranks).first()
    assert math.isnan(row.degree_corr) and row.num_zones == 3
    assert row.strength_corr == pytest.approx(0.993399, abs=1e-6)
    row = rank.degree_rank_correlation(degrees, ranks.withColumn("pagerank", F.lit(1.0))).first()
    assert math.isnan(row.degree_corr) and math.isnan(row.strength_corr)
    row = rank.degree_rank_correlation(degrees.where("zone_id > 3"), ranks).first()
    assert (row.degree_corr, row.strength_corr, row.num_zones) == (None, None, 0)


def test_correlation_of_rows_with_both_values(spark):
    rows = [(1.0, 2.0), (2.0, 1.0), (4.0, 7.0), (None, 100.0), (50.0, None)]
    got = spark.createDataFrame(rows, "x double, y double").agg(
        correlation(F.col("x"), F.col("y")).alias("ours"), F.corr("x", "y").alias("sparks")).first()
    assert got.ours == pytest.approx(got.sparks, abs=1e-12)


@pytest.fixture(scope="module")
def lineitem(spark, tmp_path_factory):
    """Trips between all of 6 zones, each pair as often as any other."""
    d = str(tmp_path_factory.mktemp("lineitem"))
    pairs = [(a, b) for a in range(1, 7) for b in range(1, 7) if a != b]
    day = datetime(1995, 1, 1)
    rows = [(b + 30 * k, 1 + k, a + 270 * k, 5.0, 3000.0 + a, 0.05, day + timedelta(days=k)) for k in range(4) for a, b in pairs]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double, "
                                "l_tax double, l_shipdate timestamp_ntz").coalesce(1).write.parquet(f"{d}/lineitem.parquet")
    return d


def both(spark, name, d):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{d}/lineitem.parquet/*.parquet'")
    sql = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in sql.description]
    found = entry.queries()[name](spark, d)
    assert found.columns == names
    return [sorted(map(repr, rows)) for rows in (map(tuple, found.collect()), sql.fetchall())]


def test_degree_rank_corr_of_a_complete_graph(spark, lineitem):
    found, sql = both(spark, "degree_rank_corr", lineitem)
    assert found == sql == ["(nan, nan, 6)"]


def test_metrics_csv_roundtrip_has_every_column(spark, lineitem):
    found, sql = both(spark, "metrics_csv_roundtrip", lineitem)
    assert found == sql and len(found) == 12
    rows = entry.queries()["metrics_csv_roundtrip"](spark, lineitem).collect()
    assert {r.time_seconds for r in rows if r.test == "sample_100pct"} == {120 / 1e6}
