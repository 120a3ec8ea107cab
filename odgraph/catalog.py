"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (the ``trips`` view is derived from
``lineitem``) in full; the sampling operators sample them as their feature.  Doubles are rounded at the very end so results can
be compared with an independent SQL engine: 6 places for averages, ranks
and shares, 4 for per-edge sums, 2 for global sums.

The pipeline artefacts (edge list, ranks, labels) are computed once per
``(session, data folder)`` and reused by the many report queries.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odgraph.functions.exprs import round_cols
from odgraph.operators import clean, community, edges, rank, report, scaling
from odgraph.params import DEFAULTS, DISTANCE, DROPOFF, FARE, PICKUP, TIP
from odgraph.plans.pipeline import Pipeline
from odgraph.sources import io
from odgraph.sources.trips import months_filter, table, trips

# test-data parameters: the driver's trips are ~100x fewer per pair than taxi
# trips, so the heavy-edge threshold is 10 instead of 1000 (FIXTURES §2)
HEAVY = DEFAULTS.with_(heavy_edge_threshold=10)
MONTHS = ("1995-01", "1995-02", "1995-03")

_PIPES: dict = {}


def pipe(spark: SparkSession, sf_dir: str) -> Pipeline:
    sc = spark.sparkContext
    key = (sc.applicationId, sc.startTime, sf_dir.rstrip("/"))
    if key not in _PIPES:
        _PIPES[key] = Pipeline(trips(spark, sf_dir))
    return _PIPES[key]


def _r6(df: DataFrame, *cols: str) -> DataFrame:
    return round_cols(df, {c: 6 for c in cols})


TRIP_COLS = [PICKUP, DROPOFF, DISTANCE, FARE, TIP]

# ------------------------------------------------------------------ scans


def q_scan_trips(spark, d):
    return trips(spark, d).select(*TRIP_COLS)


def q_scan_months(spark, d):
    return months_filter(trips(spark, d), MONTHS).select(*TRIP_COLS)


def q_clean_trips(spark, d):
    return clean.clean_trips(trips(spark, d)).select(*TRIP_COLS)


def q_clean_audit(spark, d):
    return _r6(clean.cleaning_audit(trips(spark, d)), "removed_pct")


def q_table_profile(spark, d):
    return edges.table_profile(trips(spark, d).select(*TRIP_COLS), "trips")


# ------------------------------------------------------------------ edges


def _edge_round(df):
    return round_cols(df, {"total_fare": 4, "avg_fare": 6, "total_tip": 4, "avg_distance": 6})


def q_edge_list(spark, d):
    return _edge_round(pipe(spark, d).edge_list)


def q_edge_count_only(spark, d):
    return edges.edge_counts(clean.clean_trips(trips(spark, d)))


def q_raw_edge_list(spark, d):
    return edges.raw_edge_list(trips(spark, d))


def q_graph_edges(spark, d):
    return edges.graph_edges(pipe(spark, d).edge_list)


def q_vertices(spark, d):
    return edges.vertices(pipe(spark, d).edge_list)


def q_graph_totals(spark, d):
    return _r6(edges.graph_totals(pipe(spark, d).edge_list), "trips_per_edge")


def q_out_degree(spark, d):
    return edges.out_degree(pipe(spark, d).edge_list)


def q_in_degree(spark, d):
    return edges.in_degree(pipe(spark, d).edge_list)


def q_degree_table(spark, d):
    return edges.degree_table(pipe(spark, d).edge_list)


def q_degree_centrality(spark, d):
    return edges.degree_centrality(trips(spark, d))


def _describe(df, cols):
    return _r6(edges.describe(df, cols), "mean", "stddev", "min", "max").withColumnRenamed(
        "column", "column_name"
    )


def q_describe_degrees(spark, d):
    el = pipe(spark, d).edge_list
    o = edges.out_degree(el).select("zone_id", "out_degree")
    i = edges.in_degree(el).select("zone_id", "in_degree")
    return _describe(o, ["out_degree"]).unionByName(_describe(i, ["in_degree"]))


def q_describe_edge_weight(spark, d):
    return _describe(pipe(spark, d).edge_list, ["trip_count"])


def q_heavy_edges(spark, d):
    return _edge_round(edges.heavy_edges(pipe(spark, d).edge_list, HEAVY))


def q_heavy_edge_share(spark, d):
    return _r6(edges.heavy_edge_share(pipe(spark, d).edge_list, HEAVY), "heavy_trip_pct")


def q_heavy_edge_share_default(spark, d):
    return _r6(edges.heavy_edge_share(pipe(spark, d).edge_list), "heavy_trip_pct")


def q_top_edges(spark, d):
    return _edge_round(edges.top_edges(pipe(spark, d).edge_list, 10))


def q_top_out_degree(spark, d):
    return edges.top_k(edges.out_degree(pipe(spark, d).edge_list), 10, [F.desc("out_degree"), "zone_id"])


def q_top_in_degree(spark, d):
    return edges.top_k(edges.in_degree(pipe(spark, d).edge_list), 10, [F.desc("in_degree"), "zone_id"])


# ------------------------------------------------------------------ sinks


def q_edge_roundtrip(spark, d):
    from odgraph.session import scratch_path

    path = io.write_parquet(pipe(spark, d).edge_list, scratch_path(spark, "edges"))
    return _edge_round(io.read_edge_list(spark, path))


def q_csv_roundtrip(spark, d):
    from odgraph.params import EDGE_SCHEMA
    from odgraph.session import scratch_path

    path = io.write_csv(pipe(spark, d).edge_list, scratch_path(spark, "graph_csv"), single_file=False)
    return _edge_round(io.read_csv(spark, path, EDGE_SCHEMA))


def q_top100_export(spark, d):
    from odgraph.session import scratch_path

    path = io.export_top(pipe(spark, d).ranks, scratch_path(spark, "top100"), 100)
    return _r6(io.read_csv(spark, path, "zone_id int, pagerank double"), "pagerank")


def q_union_files(spark, d):
    """Monthly files of two widths (64-bit ids in odd years, 32-bit in even), read as one table."""
    from odgraph.session import scratch_path
    from odgraph.sources.trips import read_trips

    t = trips(spark, d).withColumn("year", F.year("pickup_ts"))
    path = scratch_path(spark, "trips_by_year")
    wide = {PICKUP: F.col(PICKUP).cast("bigint"), DROPOFF: F.col(DROPOFF).cast("bigint")}
    t.where("year % 2 = 1").withColumns(wide).hint("rebalance").write.parquet(f"{path}/wide")
    t.where("year % 2 = 0 OR year IS NULL").hint("rebalance").write.parquet(f"{path}/narrow")
    both = read_trips(spark, [f"{path}/wide", f"{path}/narrow"])
    return both.select(F.col(PICKUP).cast("int"), F.col(DROPOFF).cast("int"), DISTANCE, FARE, TIP)


# ------------------------------------------------------------------ ranks


def q_pagerank(spark, d):
    return _r6(pipe(spark, d).ranks, "pagerank")


def q_pagerank_totals(spark, d):
    return round_cols(rank.pagerank_totals(pipe(spark, d).ranks), {"total_pagerank": 2, "avg_pagerank": 6})


def q_top20_pagerank(spark, d):
    return _r6(rank.top_pagerank(pipe(spark, d).ranks, 20), "pagerank")


def q_top50_zones(spark, d):
    return _r6(rank.top_pagerank(pipe(spark, d).ranks, 50), "pagerank")


def q_rank_concentration(spark, d):
    return _r6(rank.rank_concentration(pipe(spark, d).ranks), "top10_pct", "top20_pct", "top50_pct")


def q_describe_pagerank(spark, d):
    return _describe(pipe(spark, d).ranks, ["pagerank"])


def q_hist_pagerank(spark, d):
    return _r6(report.histogram(pipe(spark, d).ranks, "pagerank", 50), "bin_start", "bin_end")


def q_rank_cumulative_share(spark, d):
    return _r6(report.cumulative_share(pipe(spark, d).ranks), "pagerank", "cum_pct")


def q_rank_loglog(spark, d):
    return _r6(report.rank_loglog(pipe(spark, d).ranks), "pagerank", "log_pos", "log_pagerank")


def q_concentration_crossing(spark, d):
    return report.concentration_crossing(pipe(spark, d).ranks)


# ------------------------------------------------------------------ communities


def q_label_propagation(spark, d):
    return pipe(spark, d).communities


def q_community_rank(spark, d):
    pp = pipe(spark, d)
    return _r6(community.community_ranks(pp.communities, pp.ranks), "pagerank")


def q_community_stats(spark, d):
    return _r6(pipe(spark, d).community_stats, "total_pagerank", "avg_pagerank")


def q_top_communities(spark, d):
    return _r6(community.top_communities(pipe(spark, d).community_stats, 20), "total_pagerank", "avg_pagerank")


def q_top15_communities(spark, d):
    return _r6(community.top_communities(pipe(spark, d).community_stats, 15), "total_pagerank", "avg_pagerank")


def q_top10_comm_by_rank(spark, d):
    return _r6(community.top_communities_by_rank(pipe(spark, d).community_stats, 10),
               "total_pagerank", "avg_pagerank")


def q_community_extremes(spark, d):
    return _r6(community.community_extremes(pipe(spark, d).community_stats),
               "largest_total_pagerank", "smallest_total_pagerank")


def q_community_concentration(spark, d):
    return _r6(community.community_concentration(pipe(spark, d).community_stats), "top5_pct", "top10_pct")


def q_describe_communities(spark, d):
    return _describe(pipe(spark, d).community_stats, ["num_zones"])


def q_edge_communities(spark, d):
    pp = pipe(spark, d)
    return community.edges_with_communities(pp.edge_list, pp.communities)


def q_connectivity(spark, d):
    pp = pipe(spark, d)
    return _r6(community.connectivity(pp.edge_list, pp.communities), "intra_pct", "inter_pct")


def q_modularity(spark, d):
    pp = pipe(spark, d)
    return _r6(community.modularity(pp.edge_list, pp.communities), "modularity")


def q_hist_community_size(spark, d):
    return _r6(report.histogram(pipe(spark, d).community_stats, "num_zones", 30), "bin_start", "bin_end")


def q_size_rank_scatter(spark, d):
    return _r6(report.size_rank_scatter(pipe(spark, d).community_stats), "total_pagerank")


def q_summary_report(spark, d):
    pp = pipe(spark, d)
    return _r6(report.summary_report(pp.ranks, pp.community_stats), "value")


# ------------------------------------------------------------------ scaling


def q_sample_hash(spark, d):
    return scaling.hash_sample(trips(spark, d), 5).select(*TRIP_COLS)


def q_sample_seeded(spark, d):
    """Exactly 5 % of the rows, by a seeded hash."""
    return scaling.exact_sample(trips(spark, d), 0.05, 42).select(*TRIP_COLS)


def q_sweep_counts(spark, d):
    return scaling.sweep_counts(trips(spark, d))


SWEEP = (1, 5, 10, 20, 50, 100)


def q_sweep_build(spark, d):
    """B1 over the whole sweep: the counts of every sample size, without the clock."""
    counts = scaling.sweep_counts(trips(spark, d), SWEEP)
    return counts.select(
        F.format_string("sample_%dpct", F.col("sample_pct")).alias("run_name"), F.lit("build_graph").alias("step"),
        (F.col("sample_pct") / 100).alias("sample_fraction"), "raw_rows", "cleaned_rows", "edges")


def q_build_counts(spark, d):
    """B1's counts over all trips, in one scan."""
    return scaling.build_counts(trips(spark, d))


def q_sweep_pagerank(spark, d):
    """B2 on a tenth of the trips and on all: graph sizes and rounds, without the clock."""
    t = trips(spark, d)
    runs = [scaling.benchmark_pagerank(spark, t, pct, f"sample_{pct}pct") for pct in (10, 100)]
    return runs[0].unionByName(runs[1]).select("run_name", "step", "sample_fraction", "vertices", "edges", "iterations")


def _coverage(spark, d):
    t = trips(spark, d)
    return scaling.coverage_metrics(t, "raw", SWEEP), scaling.coverage_metrics(t, "clean", SWEEP)


def q_compare_metrics(spark, d):
    raw, kept = _coverage(spark, d)
    both = scaling.compare_metrics(kept, raw, "result_rows", ("clean", "raw"), "share_kept")
    return _r6(both, "share_kept")


def q_success_rate(spark, d):
    raw, kept = _coverage(spark, d)
    return _r6(scaling.success_rate(raw.unionByName(kept)), "success_pct")


def q_stress_curve(spark, d):
    raw, kept = _coverage(spark, d)
    return scaling.stress_curve(raw.unionByName(kept), "result_rows")


def q_run_summary(spark, d):
    """X6 over a build and a rank table of counts: the rows that each step reads."""
    counts = scaling.sweep_counts(trips(spark, d), SWEEP)
    name = F.format_string("sample_%dpct", F.col("sample_pct")).alias("run_name")
    fraction = (F.col("sample_pct") / 100).alias("sample_fraction")
    build = counts.select(name, F.lit("build_graph").alias("step"), fraction, F.col("raw_rows").alias("rows_read"))
    ranks = counts.select(name, F.lit("pagerank").alias("step"), fraction, F.col("edges").alias("edges_read"))
    return scaling.run_summary(build, ranks, ("rows_read", "edges_read"))


# ------------------------------------------------------------------ tier B: more centrality


def _weighted(col):
    def q(spark, d):
        from odgraph.graph import Graph

        el = pipe(spark, d).edge_list
        return _r6(rank.pagerank(Graph.from_edge_list(el, weight=col), weight="weight"), "pagerank")

    q.__doc__ = f"G5: PageRank with transition weights ∝ {col}."
    return q


q_pagerank_weighted_trips = _weighted("trip_count")
q_pagerank_weighted_fare = _weighted("total_fare")
q_pagerank_weighted_tip = _weighted("total_tip")


def q_hits(spark, d):
    return _r6(pipe(spark, d).hits, "hub", "authority")


def q_pagerank_tol(spark, d):
    return _r6(rank.pagerank_to_tolerance(pipe(spark, d).graph), "pagerank")


def q_pagerank_residual(spark, d):
    return _r6(rank.pagerank_residual(pipe(spark, d).graph, tolerance=1e-9), "pagerank")


def q_pagerank_unit(spark, d):
    """G2 with ranks that sum to 1."""
    return round_cols(rank.pagerank(pipe(spark, d).graph, scale="1"), {"pagerank": 9})


def q_degree_vs_rank(spark, d):
    pp = pipe(spark, d)
    return _r6(rank.degree_vs_rank(pp.degrees, pp.ranks), "pagerank")


def q_degree_rank_corr(spark, d):
    pp = pipe(spark, d)
    return _r6(rank.degree_rank_correlation(pp.degrees, pp.ranks), "degree_corr", "strength_corr")


def _zones(spark, d):
    return io.zones_from_nations(pipe(spark, d).ranks, table(spark, d, "nation"), table(spark, d, "region"))


def q_zone_names(spark, d):
    return _r6(io.attach_zone_names(pipe(spark, d).ranks, _zones(spark, d)), "pagerank")


def q_zone_lookup_csv(spark, d):
    from odgraph.session import scratch_path

    path = io.write_csv(_zones(spark, d), scratch_path(spark, "zone_lookup"), single_file=False)
    return io.read_zone_lookup(spark, path)


def q_zone_features(spark, d):
    """The feature table that k-means clusters."""
    from odgraph.operators import zones

    pp = pipe(spark, d)
    return _r6(zones.zone_features(pp.ranks, pp.degrees, pp.hits), *zones.FEATURES)


def q_zone_kmeans(spark, d):
    from odgraph.operators import zones

    pp = pipe(spark, d)
    return zones.zone_kmeans(zones.zone_features(pp.ranks, pp.degrees, pp.hits)).select("zone_id", "cluster", "converged")


def q_louvain(spark, d):
    """Community of every zone, the modularity reached and whether it ran to its end."""
    return _r6(pipe(spark, d).louvain, "modularity")


def q_louvain_modularity(spark, d):
    """Modularity of label propagation, and whether Louvain's is at least that."""
    pp = pipe(spark, d)
    lpa = community.modularity(pp.edge_list, pp.communities).select(F.col("modularity").alias("lpa_modularity"))
    own = community.modularity(pp.edge_list, pp.louvain.select("zone_id", "community_id")).agg(F.max("modularity")).scalar()
    told = pp.louvain.agg(F.max("modularity")).scalar()
    ended = pp.louvain.agg(F.min("converged")).scalar()
    return _r6(lpa.withColumn("louvain_not_worse", own >= F.col("lpa_modularity") - 1e-12)
               .withColumn("modularity_as_told", F.abs(own - told) < 1e-9).withColumn("converged", ended), "lpa_modularity")


# ------------------------------------------------------------------ tier C: paths, time, streams


def q_hop_distance(spark, d):
    from odgraph.operators import paths

    return _r6(paths.hop_distance(pipe(spark, d).edge_list), "distance")


def q_shortest_route(spark, d):
    """Routes from the busiest origin to every zone, over lengths of six places."""
    from odgraph.operators import paths

    el = pipe(spark, d).edge_list.withColumn("length", F.round("avg_distance", 6))
    return _r6(paths.shortest_route(el, length="length"), "distance")


def _prof(df):
    return round_cols(df, {"total_fare": 2, "avg_fare": 6, "total_tip": 2, "avg_distance": 6})


def q_monthly_profile(spark, d):
    from odgraph.operators import temporal

    return _prof(temporal.monthly_profile(pipe(spark, d).clean))


def q_weekday_profile(spark, d):
    from odgraph.operators import temporal

    return _prof(temporal.weekday_profile(pipe(spark, d).clean))


def q_edges_by_month(spark, d):
    from odgraph.operators import temporal

    return round_cols(temporal.edges_by_month(pipe(spark, d).clean), {"total_fare": 4})


def _window_out(df, *more):
    from odgraph.functions.exprs import utc_day

    # batch windows over TIMESTAMP_NTZ are wall-clock values; stream windows
    # are UTC instants — both rendered as a day without the session zone
    start = F.col("window_start")
    day = (F.date_format(start, "yyyy-MM-dd") if dict(df.dtypes)["window_start"] == "timestamp_ntz"
           else utc_day(start))
    return round_cols(
        df.select(*more, day.alias("window_start"), "src", "dst", "trip_count", "total_fare"),
        {"total_fare": 4},
    )


def q_edges_by_window(spark, d):
    from odgraph.operators import temporal

    return _window_out(temporal.edges_by_window(pipe(spark, d).clean))


def q_stream_edges(spark, d):
    """P1 over the table's files, at most 16 a micro-batch."""
    from odgraph.session import scratch_path
    from odgraph.sources.trips import trips_from_lineitem
    from odgraph.streaming import edges as sedges

    out = scratch_path(spark, "stream_edges")
    folder, glob = io.stream_source(spark, f"{d.rstrip('/')}/lineitem.parquet")
    sedges.run_stream_edges(
        spark, folder, out, scratch_path(spark, "stream_ckpt"), schema=table(spark, d, "lineitem").schema,
        transform=trips_from_lineitem, glob=glob, max_files_per_trigger=16,
    )
    return _window_out(sedges.read_stream_result(spark, out))


def _late(day: str):
    """Trips before ``day`` in one of a hundred hash buckets: those that come late in a stream."""
    from odgraph.functions.exprs import hash_bucket

    return (hash_bucket(*scaling.TRIP_KEY) == 0) & (F.col("pickup_ts") < F.lit(day).cast("timestamp_ntz"))


def q_stream_edges_live(spark, d):
    """P1 live: a first run over the trips before 1995, a second over the others and
    the late ones, its last batch run again; the table before and after compaction."""
    from odgraph.session import scratch_path
    from odgraph.streaming import edges as sedges
    from odgraph.streaming.live import LiveTable

    t = trips(spark, d)
    late = F.coalesce(_late("1994-01-01"), F.lit(False))
    early = F.coalesce(F.col("pickup_ts") < F.lit("1995-01-01").cast("timestamp_ntz"), F.lit(False))
    src, out, ckpt = (scratch_path(spark, f"live_{x}") for x in ("src", "out", "ckpt"))
    for rows in (t.where(early & ~late), t.where(late | ~early)):
        rows.write.mode("append").parquet(src)
        sedges.run_stream_edges(spark, src, out, ckpt, schema=t.schema, watermark="14 days", max_files_per_trigger=None)
    live = LiveTable(spark, out)
    last = max(int(n.rsplit("=", 1)[1]) for n in live._names("batches/batch_id=*"))
    again = scratch_path(spark, "live_again")
    live.batch(last).write.parquet(again)
    live.upsert(spark.read.parquet(again), last)
    before = scratch_path(spark, "live_before")
    live.read().write.parquet(before)
    live.compact()
    live.upsert(spark.read.parquet(again), last)  # a batch below the mark changes nothing
    both = spark.read.parquet(before).select(F.lit("before").alias("state"), "*").unionByName(
        live.read().select(F.lit("after").alias("state"), "*"))
    return _window_out(both, "state")


def q_stream_edges_closed(spark, d):
    """P1 state: windows of a week, each told when the watermark has passed it."""
    from odgraph.session import scratch_path
    from odgraph.sources.trips import trips_from_lineitem
    from odgraph.streaming import closing

    out = scratch_path(spark, "closing_edges")
    folder, glob = io.stream_source(spark, f"{d.rstrip('/')}/lineitem.parquet")
    closing.run_closing_edges(spark, folder, out, scratch_path(spark, "closing_ckpt"), schema=table(spark, d, "lineitem").schema,
                              transform=trips_from_lineitem, glob=glob, max_files_per_trigger=16)
    return _window_out(closing.read_closed(spark, out))


def q_size_rank_corr(spark, d):
    return _r6(report.size_rank_correlation(pipe(spark, d).community_stats), "size_rank_corr")


def q_status_counts(spark, d):
    raw, kept = _coverage(spark, d)
    return scaling.status_counts(raw.unionByName(kept))


def q_metrics_csv_roundtrip(spark, d):
    """S13 with every column of a metric file.  ``time_seconds`` is no measurement: it
    stands for ``result_rows`` at a million rows a second, so that results can be compared."""
    from odgraph.session import scratch_path

    raw, kept = _coverage(spark, d)
    metrics = raw.unionByName(kept).withColumn("time_seconds", F.col("result_rows") / 1e6)
    # a CSV is read by position
    path = io.write_metrics_csv(metrics.select(*scaling.STRESS_METRICS.names), scratch_path(spark, "metrics_csv"))
    return io.read_metrics_csv(spark, path, scaling.STRESS_METRICS)


def q_zone_cluster_profile(spark, d):
    from odgraph.operators import zones

    pp = pipe(spark, d)
    km = zones.zone_kmeans(zones.zone_features(pp.ranks, pp.degrees, pp.hits))
    return _r6(zones.cluster_profile(km), *[f"avg_{c}" for c in zones.FEATURES])


def q_hourly_profile(spark, d):
    from odgraph.operators import temporal

    return _prof(temporal.hourly_profile(pipe(spark, d).clean))


def q_report_csvs(spark, d):
    """Both report files written, read back and stacked."""
    from odgraph.session import scratch_path

    pp = pipe(spark, d)
    paths = report.write_reports(pp.ranks, pp.community_stats, scratch_path(spark, "reports"))
    summary = io.read_csv(spark, paths["summary"], "metric string, value double")
    top = io.read_csv(spark, paths["top"], "zone_id int, pagerank double")
    return _r6(summary.select(F.lit("summary").alias("file"), "metric", "value").unionAll(
        top.select(F.lit("top"), F.col("zone_id").cast("string"), "pagerank")), "value")


def q_results_roundtrip(spark, d):
    """Every saved output (Parquet and CSV) loaded back and stacked."""
    from odgraph.session import scratch_path

    pp = pipe(spark, d)
    out = scratch_path(spark, "pipeline")
    paths = pp.save(out)
    edge_back, rank_back = io.load_graph_data(spark, out)
    res = io.load_results(spark, out)
    csv = {k: io.csv_path_for(paths[k]) for k in ("edges", "communities", "community_stats")}
    tables = {
        "edges": edge_back,
        "edges_csv": io.read_csv(spark, csv["edges"], edge_back.schema),
        "pagerank": rank_back,
        "results_pagerank": res["pagerank"],
        "communities": res["communities"],
        "communities_csv": io.read_csv(spark, csv["communities"], io.COMMUNITY_SCHEMA),
        "community_stats": res["community_stats"],
        "community_stats_csv": io.read_csv(spark, csv["community_stats"], io.STATS_SCHEMA),
    }
    keys = {"edges": ("src", "dst", "total_fare"), "pagerank": ("zone_id", "zone_id", "pagerank"),
            "communities": ("zone_id", "community_id", None), "stats": ("community_id", "num_zones", "total_pagerank")}
    stacked = None
    for name, df in tables.items():
        a, b, value = keys[next(k for k in ("stats", "communities", "pagerank", "edges") if k in name)]
        rows = df.select(F.lit(name).alias("saved"), F.col(a).cast("bigint").alias("a"), F.col(b).cast("bigint").alias("b"),
                         F.round(F.col(value) if value else F.lit(0.0), 4).alias("value"))
        stacked = rows if stacked is None else stacked.unionAll(rows)
    return stacked


def _trips_table(spark, d):
    """The month-partitioned trip table, written once for all keys that read it."""
    from odgraph.session import scratch_path
    from odgraph.sources.trips import write_trips_table

    pp = pipe(spark, d)
    if not hasattr(pp, "trips_table"):
        pp.trips_table = write_trips_table(trips(spark, d), scratch_path(spark, "trips_table"))
    return pp.trips_table


def q_clean_trips_table(spark, d):
    """F5 on a stored trip table: the cleaning predicate reaches the Parquet reader."""
    from odgraph.sources.trips import read_trips_table

    return clean.clean_trips(read_trips_table(spark, _trips_table(spark, d))).select(*TRIP_COLS)


def q_scan_months_partitioned(spark, d):
    """S2 on a month-partitioned trip table: only three month folders are read."""
    from odgraph.sources.trips import read_trips_table

    return read_trips_table(spark, _trips_table(spark, d), MONTHS).select(*TRIP_COLS)


def q_metrics_json_latest(spark, d):
    """S11 + S19: two runs saved as time-stamped JSON files; the latest read back."""
    from odgraph.session import scratch_path

    folder = scratch_path(spark, "benchmarks")
    runs = q_sweep_build(spark, d)
    io.save_metrics_json(runs.where("sample_fraction < 1"), folder, "19950101_000000")
    io.save_metrics_json(runs.where("sample_fraction = 1"), folder, "19950201_000000")
    back = io.read_metrics_json(spark, folder, scaling.BUILD_METRICS)
    return io.latest_metrics(back).select("run_name", "step", "sample_fraction", "raw_rows", "cleaned_rows", "edges")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
