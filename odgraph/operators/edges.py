"""Edge list, graph profile and degrees.

Scale notes
-----------
* The edge list is a ``groupBy(src, dst)`` over the trip table.  Spark runs a
  partial aggregate in every scan task before the shuffle, so each task ships
  at most one row per zone pair (≤ 263·262) however many trips a hot pair
  has: a skewed pair is folded map-side and never reaches one reducer whole.
* All profile statistics are single ``agg`` passes over the (small) edge
  list instead of one job per number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odgraph.functions.exprs import pct
from odgraph.graph import vertices_of
from odgraph.params import DEFAULTS, DISTANCE, DROPOFF, FARE, PICKUP, TIP, Params


def build_edge_list(clean: DataFrame) -> DataFrame:
    """Per (src, dst): trips, Σ/avg fare, Σ tip, avg distance.

    ``sum``/``avg`` skip nulls; ``total_tip`` is null when every tip is null.
    """
    return clean.groupBy(F.col(PICKUP).alias("src"), F.col(DROPOFF).alias("dst")).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum(FARE).alias("total_fare"),
        F.avg(FARE).alias("avg_fare"),
        F.sum(TIP).alias("total_tip"),
        F.avg(DISTANCE).alias("avg_distance"),
    )


def edge_counts(clean: DataFrame) -> DataFrame:
    """A2: count-only edge list (benchmark form)."""
    return clean.groupBy(F.col(PICKUP).alias("src"), F.col(DROPOFF).alias("dst")).agg(
        F.count(F.lit(1)).alias("trip_count")
    )


def raw_edge_list(trips: DataFrame) -> DataFrame:
    """uncleaned pair counts with the null-key filter after the group-by.

    Catalyst moves the ``isNotNull`` filter below the aggregate into the scan.
    """
    return (
        trips.groupBy(PICKUP, DROPOFF)
        .agg(F.count(F.lit(1)).alias("trip_count"))
        .filter(F.col(PICKUP).isNotNull() & F.col(DROPOFF).isNotNull())
    )


def graph_edges(edge_list: DataFrame, weight: str = "trip_count") -> DataFrame:
    """F8: ``src, dst, weight``."""
    return edge_list.select("src", "dst", F.col(weight).alias("weight"))


def vertices(edge_list: DataFrame) -> DataFrame:
    """U1."""
    return vertices_of(edge_list)


def graph_totals(edge_list: DataFrame) -> DataFrame:
    """Edges, vertices, trips, trips per edge — one job.

    The vertex count comes from a scalar subquery over the union of
    endpoints, so no driver round trip is needed between the two numbers.
    """
    n_vertices = vertices_of(edge_list).agg(F.count(F.lit(1))).scalar()
    return edge_list.agg(
        F.count(F.lit(1)).alias("num_edges"),
        F.coalesce(F.sum("trip_count"), F.lit(0)).cast("bigint").alias("total_trips"),
    ).select(
        "num_edges",
        n_vertices.alias("num_vertices"),
        "total_trips",
        F.try_divide(F.col("total_trips").cast("double"), F.col("num_edges").cast("double")).alias(
            "trips_per_edge"
        ),
    )


def out_degree(edge_list: DataFrame) -> DataFrame:
    """A4: number of distinct out-neighbours (edges are unique per pair)."""
    return edge_list.groupBy(F.col("src").alias("zone_id")).agg(
        F.count("dst").alias("out_degree")
    )


def in_degree(edge_list: DataFrame) -> DataFrame:
    """A5."""
    return edge_list.groupBy(F.col("dst").alias("zone_id")).agg(F.count("src").alias("in_degree"))


def degree_table(edge_list: DataFrame) -> DataFrame:
    """Out/in degree and out/in strength (Σ trips) per zone in one aggregate.

    Each edge contributes one row to its source and one to its target; a
    single ``groupBy(zone_id)`` then replaces two group-bys and a join.
    """
    both = edge_list.select(
        F.explode(
            F.array(
                F.struct(F.col("src").alias("zone_id"), F.lit(1).alias("o"), F.lit(0).alias("i"),
                         F.col("trip_count").alias("os"), F.lit(0).cast("bigint").alias("is_")),
                F.struct(F.col("dst").alias("zone_id"), F.lit(0).alias("o"), F.lit(1).alias("i"),
                         F.lit(0).cast("bigint").alias("os"), F.col("trip_count").alias("is_")),
            )
        ).alias("r")
    ).select("r.*")
    return both.groupBy("zone_id").agg(
        F.sum("o").cast("bigint").alias("out_degree"),
        F.sum("i").cast("bigint").alias("in_degree"),
        F.sum("os").cast("bigint").alias("out_strength"),
        F.sum("is_").cast("bigint").alias("in_strength"),
    )


def top_k(df: DataFrame, k: int, order: list) -> DataFrame:
    """T*: ``orderBy(...).limit(k)`` — planned as a distributed TakeOrdered."""
    return df.orderBy(*order).limit(k)


def top_edges(edge_list: DataFrame, k: int = 10) -> DataFrame:
    """Busiest edges, ties by (src, dst)."""
    return top_k(edge_list, k, [F.desc("trip_count"), "src", "dst"])


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Typed ``describe`` — count, mean, sample stddev, min, max.

    One aggregate over all requested columns, unpivoted to one row per
    column (Spark's own ``describe`` returns strings).
    """
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"{c}__count"),
            F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__stddev"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
        ]
    wide = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"{c}__count").alias("count"),
            F.col(f"{c}__mean").alias("mean"),
            F.col(f"{c}__stddev").alias("stddev"),
            F.col(f"{c}__min").alias("min"),
            F.col(f"{c}__max").alias("max"),
        )
        for c in columns
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def heavy_edges(edge_list: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """F10."""
    return edge_list.filter(F.col("trip_count") >= p.heavy_edge_threshold)


def heavy_edge_share(edge_list: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Number of heavy edges and % of trips on them — one conditional agg.

    Zero heavy edges gives 0 (the reference divides ``None``); an empty edge
    list gives a null share.
    """
    heavy = F.col("trip_count") >= p.heavy_edge_threshold
    return edge_list.agg(
        F.count_if(heavy).alias("heavy_edges"),
        F.coalesce(F.sum(F.when(heavy, F.col("trip_count"))), F.lit(0)).cast("bigint").alias("heavy_trips"),
        F.coalesce(F.sum("trip_count"), F.lit(0)).cast("bigint").alias("total_trips"),
    ).select(
        F.lit(p.heavy_edge_threshold).alias("threshold"),
        "heavy_edges",
        "heavy_trips",
        "total_trips",
        pct("heavy_trips", "total_trips").alias("heavy_trip_pct"),
    )


def degree_centrality(trips: DataFrame) -> DataFrame:
    """Trip-weighted out/in degree over raw trips, full outer join.

    Both keys are kept (the null-key groups never match each other), and a
    coalesced ``zone_id`` is added.  Both sides are per-zone aggregates, so
    the join input is tiny whatever the trip volume.
    """
    out_d = trips.groupBy(PICKUP).agg(F.count(F.lit(1)).alias("out_degree")).alias("o")
    in_d = trips.groupBy(DROPOFF).agg(F.count(F.lit(1)).alias("in_degree")).alias("i")
    j = out_d.join(in_d, F.col(f"o.{PICKUP}") == F.col(f"i.{DROPOFF}"), "full_outer")
    return j.select(
        F.coalesce(F.col(f"o.{PICKUP}"), F.col(f"i.{DROPOFF}")).alias("zone_id"),
        F.col(f"o.{PICKUP}").alias(PICKUP),
        "out_degree",
        F.col(f"i.{DROPOFF}").alias(DROPOFF),
        "in_degree",
    )


def table_profile(df: DataFrame, name: str) -> DataFrame:
    """Rows and columns of a table."""
    return df.agg(F.count(F.lit(1)).alias("num_rows")).select(
        F.lit(name).alias("table_name"),
        "num_rows",
        F.lit(len(df.columns)).alias("num_columns"),
        F.lit(",".join(df.columns)).alias("column_names"),
    )
