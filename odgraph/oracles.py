"""Independent SQL (DuckDB dialect) for the registered queries.

Each statement recomputes its result from the raw driver tables; nothing is
shared with the Spark code except the definitions of the ``trips`` view and
the cleaning rule.  Column names and roundings match :mod:`odgraph.catalog`.
"""

from __future__ import annotations

from odgraph.sources.trips import TRIPS_SQL

TRIPS = f"trips AS ({TRIPS_SQL})"
CLEAN = (
    "clean AS (SELECT * FROM trips WHERE PULocationID BETWEEN 1 AND 263 AND DOLocationID BETWEEN 1 AND 263"
    " AND PULocationID <> DOLocationID AND fare_amount >= 0)"
)
EDGES = (
    "edges AS (SELECT PULocationID AS src, DOLocationID AS dst, COUNT(*) AS trip_count,"
    " SUM(fare_amount) AS total_fare, AVG(fare_amount) AS avg_fare, SUM(tip_amount) AS total_tip,"
    " AVG(trip_distance) AS avg_distance FROM clean GROUP BY 1, 2)"
)
VERTS = "v AS (SELECT src AS id FROM edges UNION SELECT dst FROM edges)"


def pagerank_cte(iters: int = 20, weight: str | None = None, name: str = "pr") -> str:
    """Recursive PageRank; ``weight`` names an edge column for the weighted form."""
    if weight is None:
        trans = (
            f"{name}_t AS (SELECT e.src, e.dst, 1.0 / COUNT(*) OVER (PARTITION BY e.src) AS w FROM edges e)"
        )
    else:
        trans = (
            f"{name}_t AS (SELECT src, dst, w FROM (SELECT src, dst, COALESCE({weight}, 0)::DOUBLE"
            f" / NULLIF(SUM(COALESCE({weight}, 0)::DOUBLE) OVER (PARTITION BY src), 0) AS w FROM edges)"
            f" WHERE w IS NOT NULL)"
        )
    return f"""{trans},
{name}_r(it, id, rank) AS (
  SELECT 0, id, 1.0::DOUBLE FROM v
  UNION ALL
  SELECT any_value(r0.it) + 1, v.id, 0.15 + 0.85 * COALESCE(SUM(m.c), 0)
  FROM v CROSS JOIN (SELECT DISTINCT it FROM {name}_r) r0
  LEFT JOIN (SELECT t.dst, r.rank * t.w AS c FROM {name}_r r JOIN {name}_t t ON r.id = t.src) m
    ON m.dst = v.id
  WHERE r0.it < {iters} GROUP BY v.id),
{name} AS (SELECT id AS zone_id, rank * (SELECT COUNT(*) FROM v)
  / (SELECT SUM(rank) FROM {name}_r WHERE it = {iters}) AS pagerank FROM {name}_r WHERE it = {iters})"""


LPA = """n AS (SELECT src AS a, dst AS b FROM edges UNION ALL SELECT dst, src FROM edges),
l(it, id, label) AS (
  SELECT 0, id, id::BIGINT FROM v
  UNION ALL
  SELECT it, id, label FROM (
    SELECT it + 1 AS it, a AS id, label,
           ROW_NUMBER() OVER (PARTITION BY a ORDER BY COUNT(*) DESC, label) AS rn
    FROM l JOIN n ON n.b = l.id WHERE it < 10 GROUP BY it, a, label) WHERE rn = 1),
comm AS (SELECT id AS zone_id, label AS community_id FROM l WHERE it = 10)"""

STATS = """cstats AS (SELECT c.community_id, COUNT(c.zone_id) AS num_zones, SUM(p.pagerank) AS total_pagerank,
  AVG(p.pagerank) AS avg_pagerank FROM comm c JOIN pr p ON c.zone_id = p.zone_id GROUP BY 1)"""


def with_(*ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n"


BASE = (TRIPS, CLEAN, EDGES)
GRAPH = (TRIPS, CLEAN, EDGES, VERTS)
PR = GRAPH + (pagerank_cte(),)
COMM = PR + (LPA, STATS)

TRIP_COLS = "PULocationID, DOLocationID, trip_distance, fare_amount, tip_amount"
EDGE_ROUND = (
    "src, dst, trip_count, ROUND(total_fare, 4) AS total_fare, ROUND(avg_fare, 6) AS avg_fare,"
    " ROUND(total_tip, 4) AS total_tip, ROUND(avg_distance, 6) AS avg_distance"
)


def describe_sql(source: str, col: str) -> str:
    return (
        f"SELECT '{col}' AS column_name, COUNT({col}) AS count, ROUND(AVG({col}::DOUBLE), 6) AS mean,"
        f" ROUND(STDDEV_SAMP({col}::DOUBLE), 6) AS stddev, ROUND(MIN({col})::DOUBLE, 6) AS min,"
        f" ROUND(MAX({col})::DOUBLE, 6) AS max FROM {source}"
    )


def histogram_sql(source: str, col: str, bins: int, ctes: tuple) -> str:
    mm = f"mm AS (SELECT MIN({col})::DOUBLE AS mn, MAX({col})::DOUBLE AS mx FROM {source})"
    hb = (
        f"hb AS (SELECT LEAST(COALESCE(CAST(FLOOR(({col}::DOUBLE - mn) / NULLIF((mx - mn) / {bins}.0, 0)) AS INT), 0),"
        f" {bins - 1}) AS bin, COUNT(*) AS cnt FROM {source}, mm WHERE {col} IS NOT NULL GROUP BY 1)"
    )
    return with_(*ctes, mm, hb, recursive=True) + f"""SELECT g.bin, ROUND(mn + g.bin * ((mx - mn) / {bins}.0), 6) AS bin_start,
  ROUND(mn + (g.bin + 1) * ((mx - mn) / {bins}.0), 6) AS bin_end, COALESCE(hb.cnt, 0)::BIGINT AS count
FROM (SELECT range::INT AS bin FROM range({bins})) g CROSS JOIN mm LEFT JOIN hb ON hb.bin = g.bin"""


PR_ORDER = "ROUND(pagerank, 6) DESC, zone_id"

SQL: dict[str, str] = {}

# ------------------------------------------------------------------ scans
SQL["scan_trips"] = with_(TRIPS) + f"SELECT {TRIP_COLS} FROM trips"
SQL["scan_months"] = with_(TRIPS) + (
    f"SELECT {TRIP_COLS} FROM trips WHERE pickup_ts >= TIMESTAMP '1995-01-01' AND pickup_ts < TIMESTAMP '1995-04-01'"
)
SQL["clean_trips"] = with_(TRIPS, CLEAN) + f"SELECT {TRIP_COLS} FROM clean"
SQL["clean_audit"] = with_(TRIPS) + """SELECT COUNT(*) AS original_rows,
  COUNT(*) FILTER (WHERE PULocationID BETWEEN 1 AND 263 AND DOLocationID BETWEEN 1 AND 263
                   AND PULocationID <> DOLocationID AND fare_amount >= 0) AS kept_rows,
  COUNT(*) - COUNT(*) FILTER (WHERE PULocationID BETWEEN 1 AND 263 AND DOLocationID BETWEEN 1 AND 263
                   AND PULocationID <> DOLocationID AND fare_amount >= 0) AS removed_rows,
  ROUND((COUNT(*) - COUNT(*) FILTER (WHERE PULocationID BETWEEN 1 AND 263 AND DOLocationID BETWEEN 1 AND 263
                   AND PULocationID <> DOLocationID AND fare_amount >= 0))::DOUBLE / NULLIF(COUNT(*), 0) * 100, 6)
    AS removed_pct,
  COUNT(*) FILTER (WHERE PULocationID IS NULL) AS null_pickup,
  COUNT(*) FILTER (WHERE DOLocationID IS NULL) AS null_dropoff,
  COUNT(*) FILTER (WHERE NOT (PULocationID BETWEEN 1 AND 263)) AS pickup_out_of_range,
  COUNT(*) FILTER (WHERE NOT (DOLocationID BETWEEN 1 AND 263)) AS dropoff_out_of_range,
  COUNT(*) FILTER (WHERE PULocationID = DOLocationID) AS self_loops,
  COUNT(*) FILTER (WHERE fare_amount < 0) AS negative_fare,
  COUNT(*) FILTER (WHERE fare_amount IS NULL) AS null_fare
FROM trips"""
SQL["table_profile"] = with_(TRIPS) + (
    "SELECT 'trips' AS table_name, COUNT(*) AS num_rows, 5 AS num_columns,"
    " 'PULocationID,DOLocationID,trip_distance,fare_amount,tip_amount' AS column_names FROM trips"
)

# ------------------------------------------------------------------ edges
SQL["edge_list"] = with_(*BASE) + f"SELECT {EDGE_ROUND} FROM edges"
SQL["edge_roundtrip"] = SQL["edge_list"]
SQL["csv_roundtrip"] = SQL["edge_list"]
SQL["edge_count_only"] = with_(*BASE) + "SELECT src, dst, trip_count FROM edges"
SQL["raw_edge_list"] = with_(TRIPS) + (
    "SELECT PULocationID, DOLocationID, COUNT(*) AS trip_count FROM trips"
    " WHERE PULocationID IS NOT NULL AND DOLocationID IS NOT NULL GROUP BY 1, 2"
)
SQL["graph_edges"] = with_(*BASE) + "SELECT src, dst, trip_count AS weight FROM edges"
SQL["vertices"] = with_(*GRAPH) + "SELECT id FROM v"
SQL["graph_totals"] = with_(*GRAPH) + (
    "SELECT COUNT(*) AS num_edges, (SELECT COUNT(*) FROM v) AS num_vertices,"
    " COALESCE(SUM(trip_count), 0)::BIGINT AS total_trips,"
    " ROUND(SUM(trip_count)::DOUBLE / NULLIF(COUNT(*), 0), 6) AS trips_per_edge FROM edges"
)
SQL["out_degree"] = with_(*BASE) + "SELECT src AS zone_id, COUNT(dst) AS out_degree FROM edges GROUP BY 1"
SQL["in_degree"] = with_(*BASE) + "SELECT dst AS zone_id, COUNT(src) AS in_degree FROM edges GROUP BY 1"
SQL["degree_table"] = with_(*BASE) + """SELECT zone_id, SUM(o)::BIGINT AS out_degree, SUM(i)::BIGINT AS in_degree,
  SUM(os)::BIGINT AS out_strength, SUM(is_)::BIGINT AS in_strength FROM (
  SELECT src AS zone_id, 1 AS o, 0 AS i, trip_count AS os, 0 AS is_ FROM edges
  UNION ALL SELECT dst, 0, 1, 0, trip_count FROM edges) GROUP BY 1"""
SQL["degree_centrality"] = with_(TRIPS) + """SELECT COALESCE(o.PULocationID, i.DOLocationID) AS zone_id,
  o.PULocationID, o.out_degree, i.DOLocationID, i.in_degree
FROM (SELECT PULocationID, COUNT(*) AS out_degree FROM trips GROUP BY 1) o
FULL OUTER JOIN (SELECT DOLocationID, COUNT(*) AS in_degree FROM trips GROUP BY 1) i
  ON o.PULocationID = i.DOLocationID"""
SQL["describe_degrees"] = with_(*BASE) + (
    describe_sql("(SELECT src, COUNT(dst) AS out_degree FROM edges GROUP BY 1)", "out_degree")
    + " UNION ALL "
    + describe_sql("(SELECT dst, COUNT(src) AS in_degree FROM edges GROUP BY 1)", "in_degree")
)
SQL["describe_edge_weight"] = with_(*BASE) + describe_sql("edges", "trip_count")
SQL["heavy_edges"] = with_(*BASE) + f"SELECT {EDGE_ROUND} FROM edges WHERE trip_count >= 10"


def heavy_share_sql(t: int) -> str:
    return with_(*BASE) + f"""SELECT {t} AS threshold, COUNT(*) FILTER (WHERE trip_count >= {t}) AS heavy_edges,
  COALESCE(SUM(trip_count) FILTER (WHERE trip_count >= {t}), 0)::BIGINT AS heavy_trips,
  COALESCE(SUM(trip_count), 0)::BIGINT AS total_trips,
  ROUND(COALESCE(SUM(trip_count) FILTER (WHERE trip_count >= {t}), 0)::DOUBLE
        / NULLIF(SUM(trip_count), 0) * 100, 6) AS heavy_trip_pct FROM edges"""


SQL["heavy_edge_share"] = heavy_share_sql(10)
SQL["heavy_edge_share_default"] = heavy_share_sql(1000)
SQL["top_edges"] = with_(*BASE) + f"SELECT {EDGE_ROUND} FROM edges ORDER BY trip_count DESC, src, dst LIMIT 10"
SQL["top_out_degree"] = with_(*BASE) + (
    "SELECT src AS zone_id, COUNT(dst) AS out_degree FROM edges GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
)
SQL["top_in_degree"] = with_(*BASE) + (
    "SELECT dst AS zone_id, COUNT(src) AS in_degree FROM edges GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
)
SQL["union_files"] = SQL["scan_trips"]

# ------------------------------------------------------------------ ranks
SQL["pagerank"] = with_(*PR, recursive=True) + "SELECT zone_id, ROUND(pagerank, 6) AS pagerank FROM pr"
SQL["pagerank_totals"] = with_(*PR, recursive=True) + (
    "SELECT COUNT(*) AS total_zones, ROUND(COALESCE(SUM(pagerank), 0), 2) AS total_pagerank,"
    " ROUND(COALESCE(AVG(pagerank), 0), 6) AS avg_pagerank FROM pr"
)
SQL["top20_pagerank"] = with_(*PR, recursive=True) + (
    f"SELECT zone_id, ROUND(pagerank, 6) AS pagerank, 'Zone ' || zone_id AS label FROM pr ORDER BY {PR_ORDER} LIMIT 20"
)
SQL["top50_zones"] = with_(*PR, recursive=True) + (
    f"SELECT zone_id, ROUND(pagerank, 6) AS pagerank, 'Zone ' || zone_id AS label FROM pr ORDER BY {PR_ORDER} LIMIT 50"
)
SQL["top100_export"] = with_(*PR, recursive=True) + (
    f"SELECT zone_id, ROUND(pagerank, 6) AS pagerank FROM pr ORDER BY {PR_ORDER} LIMIT 100"
)
SQL["rank_concentration"] = with_(*PR, recursive=True) + f"""SELECT
  ROUND(SUM(pagerank) FILTER (WHERE pos <= 10) / (SELECT SUM(pagerank) FROM pr) * 100, 6) AS top10_pct,
  ROUND(SUM(pagerank) FILTER (WHERE pos <= 20) / (SELECT SUM(pagerank) FROM pr) * 100, 6) AS top20_pct,
  ROUND(SUM(pagerank) FILTER (WHERE pos <= 50) / (SELECT SUM(pagerank) FROM pr) * 100, 6) AS top50_pct,
  SUM(pagerank) FILTER (WHERE pos <= 10) / (SELECT SUM(pagerank) FROM pr) * 100 > 40 AS power_law
FROM (SELECT pagerank, ROW_NUMBER() OVER (ORDER BY {PR_ORDER}) AS pos FROM pr)"""
SQL["describe_pagerank"] = with_(*PR, recursive=True) + describe_sql("pr", "pagerank")
SQL["hist_pagerank"] = histogram_sql("pr", "pagerank", 50, PR)
CUM = f"""cs AS (SELECT ROW_NUMBER() OVER (ORDER BY {PR_ORDER}) AS pos, zone_id, pagerank,
  SUM(pagerank) OVER (ORDER BY {PR_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  / (SELECT SUM(pagerank) FROM pr) * 100 AS cum_pct FROM pr)"""
SQL["rank_cumulative_share"] = with_(*PR, CUM, recursive=True) + (
    "SELECT pos, zone_id, ROUND(pagerank, 6) AS pagerank, ROUND(cum_pct, 6) AS cum_pct FROM cs"
)
SQL["rank_loglog"] = with_(*PR, CUM, recursive=True) + (
    "SELECT pos, zone_id, ROUND(pagerank, 6) AS pagerank, ROUND(LOG10(pos), 6) AS log_pos,"
    " ROUND(LOG10(pagerank), 6) AS log_pagerank FROM cs"
)
SQL["concentration_crossing"] = with_(*PR, CUM, recursive=True) + (
    "SELECT MIN(pos) FILTER (WHERE cum_pct >= 50) AS pos_50pct, MIN(pos) FILTER (WHERE cum_pct >= 80) AS pos_80pct,"
    " COUNT(*) AS num_zones FROM cs"
)

# ------------------------------------------------------------------ communities
SQL["label_propagation"] = with_(*COMM, recursive=True) + "SELECT zone_id, community_id FROM comm"
SQL["community_rank"] = with_(*COMM, recursive=True) + (
    "SELECT c.zone_id, c.community_id, ROUND(p.pagerank, 6) AS pagerank FROM comm c JOIN pr p ON c.zone_id = p.zone_id"
)
CS_ROUND = "community_id, num_zones, ROUND(total_pagerank, 6) AS total_pagerank, ROUND(avg_pagerank, 6) AS avg_pagerank"
SQL["community_stats"] = with_(*COMM, recursive=True) + f"SELECT {CS_ROUND} FROM cstats"
SQL["top_communities"] = with_(*COMM, recursive=True) + (
    f"SELECT {CS_ROUND}, 'Comm ' || community_id AS label FROM cstats ORDER BY num_zones DESC, community_id LIMIT 20"
)
SQL["top15_communities"] = with_(*COMM, recursive=True) + (
    f"SELECT {CS_ROUND}, 'Comm ' || community_id AS label FROM cstats ORDER BY num_zones DESC, community_id LIMIT 15"
)
SQL["top10_comm_by_rank"] = with_(*COMM, recursive=True) + (
    f"SELECT {CS_ROUND}, 'Comm ' || community_id AS label FROM cstats"
    " ORDER BY ROUND(total_pagerank, 6) DESC, community_id LIMIT 10"
)
SQL["community_extremes"] = with_(*COMM, recursive=True) + """SELECT (SELECT COUNT(*) FROM cstats) AS num_communities,
  l.community_id AS largest_id, l.num_zones AS largest_zones, ROUND(l.total_pagerank, 6) AS largest_total_pagerank,
  s.community_id AS smallest_id, s.num_zones AS smallest_zones, ROUND(s.total_pagerank, 6) AS smallest_total_pagerank
FROM (SELECT * FROM cstats ORDER BY num_zones DESC, community_id LIMIT 1) l,
     (SELECT * FROM cstats ORDER BY num_zones ASC, community_id LIMIT 1) s"""
SQL["community_concentration"] = with_(*COMM, recursive=True) + """SELECT
  ROUND(SUM(total_pagerank) FILTER (WHERE pos <= 5) / (SELECT SUM(total_pagerank) FROM cstats) * 100, 6) AS top5_pct,
  ROUND(SUM(total_pagerank) FILTER (WHERE pos <= 10) / (SELECT SUM(total_pagerank) FROM cstats) * 100, 6) AS top10_pct
FROM (SELECT total_pagerank, ROW_NUMBER() OVER (ORDER BY num_zones DESC, community_id) AS pos FROM cstats)"""
SQL["describe_communities"] = with_(*COMM, recursive=True) + describe_sql("cstats", "num_zones")
EC = """ec AS (SELECT e.src, e.dst, e.trip_count, c1.community_id AS src_community, c2.community_id AS dst_community
  FROM edges e JOIN comm c1 ON e.src = c1.zone_id JOIN comm c2 ON e.dst = c2.zone_id)"""
SQL["edge_communities"] = with_(*COMM, EC, recursive=True) + "SELECT * FROM ec"
SQL["connectivity"] = with_(*COMM, EC, recursive=True) + """SELECT total_trips, intra_trips, inter_trips,
  ROUND(intra_trips::DOUBLE / NULLIF(total_trips, 0) * 100, 6) AS intra_pct,
  ROUND(inter_trips::DOUBLE / NULLIF(total_trips, 0) * 100, 6) AS inter_pct,
  CASE WHEN total_trips = 0 THEN 'no data'
       WHEN intra_trips::DOUBLE / total_trips * 100 > 50 THEN 'strong intra-connectivity'
       WHEN inter_trips::DOUBLE / total_trips * 100 > 50 THEN 'weak intra-connectivity'
       ELSE 'balanced' END AS verdict
FROM (SELECT COALESCE(SUM(trip_count), 0)::BIGINT AS total_trips,
  COALESCE(SUM(trip_count) FILTER (WHERE src_community = dst_community), 0)::BIGINT AS intra_trips,
  COALESCE(SUM(trip_count) FILTER (WHERE src_community <> dst_community), 0)::BIGINT AS inter_trips FROM ec)"""
SQL["modularity"] = with_(*COMM, EC, recursive=True) + """SELECT ROUND(COALESCE(SUM(q), 0), 6) AS modularity,
  COUNT(*) AS num_communities FROM (
  SELECT c, SUM(inside) / (SELECT SUM(trip_count)::DOUBLE FROM edges)
         - POW(SUM(s) / (2.0 * (SELECT SUM(trip_count)::DOUBLE FROM edges)), 2) AS q FROM (
    SELECT src_community AS c, trip_count::DOUBLE AS s,
           CASE WHEN src_community = dst_community THEN trip_count::DOUBLE ELSE 0.0 END AS inside FROM ec
    UNION ALL SELECT dst_community, trip_count::DOUBLE, 0.0 FROM ec) GROUP BY c)"""
SQL["hist_community_size"] = histogram_sql("cstats", "num_zones", 30, COMM)
SQL["size_rank_scatter"] = with_(*COMM, recursive=True) + (
    "SELECT community_id, num_zones, ROUND(total_pagerank, 6) AS total_pagerank FROM cstats"
)
SQL["summary_report"] = with_(*COMM, recursive=True) + """SELECT metric, ROUND(value, 6) AS value FROM (
  SELECT 'Total Zones' AS metric, (SELECT COUNT(*) FROM pr)::DOUBLE AS value
  UNION ALL SELECT 'Total Communities', (SELECT COUNT(*) FROM cstats)::DOUBLE
  UNION ALL SELECT 'Avg PageRank', (SELECT AVG(pagerank) FROM pr)
  UNION ALL SELECT 'Max PageRank', (SELECT MAX(pagerank) FROM pr)
  UNION ALL SELECT 'Min PageRank', (SELECT MIN(pagerank) FROM pr)
  UNION ALL SELECT 'Avg Community Size', (SELECT AVG(num_zones) FROM cstats)
  UNION ALL SELECT 'Largest Community', (SELECT MAX(num_zones) FROM cstats)::DOUBLE
  UNION ALL SELECT 'Smallest Community', (SELECT MIN(num_zones) FROM cstats)::DOUBLE)"""

# ------------------------------------------------------------------ scaling
HASH = "('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)), 1, 8))::BIGINT % 100"
SQL["sample_hash"] = with_(TRIPS) + f"SELECT {TRIP_COLS} FROM trips WHERE {HASH} < 5"
ORDER_KEY = ("('0x' || substr(md5(COALESCE(CAST(l_orderkey AS VARCHAR), '') || '-' || COALESCE(CAST(l_linenumber AS VARCHAR), '')"
             " || '-42'), 1, 15))::BIGINT")
SQL["sample_seeded"] = with_(TRIPS) + (
    f"SELECT {TRIP_COLS} FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY {ORDER_KEY}, l_orderkey, l_linenumber) AS rn FROM trips)"
    " WHERE rn <= (SELECT FLOOR(0.05 * COUNT(*) + 0.5) FROM trips)"
)
SQL["build_counts"] = with_(TRIPS, CLEAN) + (
    "SELECT (SELECT COUNT(*) FROM trips) AS raw_rows, (SELECT COUNT(*) FROM clean) AS cleaned_rows,"
    " (SELECT COUNT(*) FROM (SELECT DISTINCT PULocationID, DOLocationID FROM clean)) AS edges"
)
SQL["sweep_counts"] = with_(
    TRIPS,
    f"""hb AS (SELECT {HASH} AS h,
  COALESCE(PULocationID BETWEEN 1 AND 263 AND DOLocationID BETWEEN 1 AND 263 AND PULocationID <> DOLocationID
           AND fare_amount >= 0, FALSE) AS ok, PULocationID AS src, DOLocationID AS dst FROM trips)""",
    "grid AS (SELECT * FROM (VALUES (1), (5), (10), (20), (50), (100)) g(pct))",
    "first_seen AS (SELECT src, dst, MIN(h) AS h0 FROM hb WHERE ok GROUP BY 1, 2)",
) + """SELECT g.pct AS sample_pct,
  (SELECT COUNT(*) FROM hb WHERE h < g.pct) AS raw_rows,
  (SELECT COUNT(*) FROM hb WHERE h < g.pct AND ok) AS cleaned_rows,
  (SELECT COUNT(*) FROM first_seen WHERE h0 < g.pct) AS edges
FROM grid g"""

# ------------------------------------------------------------------ tier B
for _key, _col in (("trips", "trip_count"), ("fare", "total_fare"), ("tip", "total_tip")):
    SQL[f"pagerank_weighted_{_key}"] = with_(*GRAPH, pagerank_cte(weight=_col, name="wpr"), recursive=True) + (
        "SELECT zone_id, ROUND(pagerank, 6) AS pagerank FROM wpr"
    )

HITS = """h(it, id, hub, auth) AS (
  SELECT 0, id, 1.0::DOUBLE, 1.0::DOUBLE FROM v
  UNION ALL
  SELECT p.it + 1, p.id, COALESCE(hh.x, 0), p.a FROM (
    SELECT h0.it, v.id, COALESCE(SUM(g.hub), 0) AS a
    FROM v CROSS JOIN (SELECT DISTINCT it FROM h) h0
    LEFT JOIN edges e ON e.dst = v.id LEFT JOIN h g ON g.id = e.src
    WHERE h0.it < 20 GROUP BY h0.it, v.id) p
  LEFT JOIN (SELECT e.src AS id, SUM(a2.a) AS x FROM edges e
             JOIN (SELECT e2.dst AS id, SUM(g2.hub) AS a FROM edges e2 JOIN h g2 ON g2.id = e2.src GROUP BY 1) a2
               ON a2.id = e.dst GROUP BY 1) hh ON hh.id = p.id)"""
SQL["hits"] = with_(*GRAPH, HITS, recursive=True) + (
    "SELECT id AS zone_id, ROUND(hub / SQRT(SUM(hub * hub) OVER ()), 6) AS hub,"
    " ROUND(auth / SQRT(SUM(auth * auth) OVER ()), 6) AS authority FROM h WHERE it = 20"
)
DEG = """dg AS (SELECT zone_id, SUM(o) AS total_degree, SUM(s) AS total_strength FROM (
  SELECT src AS zone_id, 1 AS o, trip_count AS s FROM edges UNION ALL SELECT dst, 1, trip_count FROM edges)
  GROUP BY 1)"""
SQL["degree_vs_rank"] = with_(*PR, DEG, recursive=True) + """SELECT zone_id, total_degree, pagerank, degree_pos,
  rank_pos, degree_pos - rank_pos AS pos_diff FROM (
  SELECT d.zone_id, d.total_degree::BIGINT AS total_degree, ROUND(p.pagerank, 6) AS pagerank,
    ROW_NUMBER() OVER (ORDER BY d.total_degree DESC, d.zone_id) AS degree_pos,
    ROW_NUMBER() OVER (ORDER BY ROUND(p.pagerank, 6) DESC, d.zone_id) AS rank_pos
  FROM dg d JOIN pr p ON d.zone_id = p.zone_id)"""
SQL["degree_rank_corr"] = with_(*PR, DEG, recursive=True) + (
    "SELECT ROUND(CORR(d.total_degree::DOUBLE, p.pagerank), 6) AS degree_corr,"
    " ROUND(CORR(d.total_strength::DOUBLE, p.pagerank), 6) AS strength_corr, COUNT(*) AS num_zones"
    " FROM dg d JOIN pr p ON d.zone_id = p.zone_id"
)
ZONES = """zones AS (SELECT v.id AS zone_id, r.r_name AS borough, n.n_name AS zone_name FROM v
  JOIN nation n ON v.id % 25 = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""
SQL["zone_names"] = with_(*PR, ZONES, recursive=True) + (
    "SELECT p.zone_id, ROUND(p.pagerank, 6) AS pagerank, z.borough, z.zone_name FROM pr p"
    " LEFT JOIN zones z ON p.zone_id = z.zone_id"
)
SQL["zone_lookup_csv"] = with_(*GRAPH, ZONES) + "SELECT zone_id, borough, zone_name FROM zones"

# ------------------------------------------------------------------ tier C
HOPS = """so AS (SELECT src AS s FROM edges GROUP BY src ORDER BY SUM(trip_count) DESC, src LIMIT 1),
hd(it, id, hops, dist, moved) AS (
  SELECT 0, id, CASE WHEN id = (SELECT s FROM so) THEN 0 END,
         CASE WHEN id = (SELECT s FROM so) THEN 0.0::DOUBLE END, TRUE FROM v
  UNION ALL
  SELECT it, id, hops, dist, bool_or(differs) OVER () FROM (
    SELECT h.it + 1 AS it, h.id, LEAST(h.hops, m.h) AS hops, LEAST(h.dist, m.d) AS dist,
           LEAST(h.hops, m.h) IS DISTINCT FROM h.hops OR LEAST(h.dist, m.d) IS DISTINCT FROM h.dist AS differs
    FROM hd h LEFT JOIN (SELECT e.dst, MIN(p.hops) + 1 AS h, MIN(p.dist + COALESCE(e.avg_distance, 0.0)) AS d
                         FROM hd p JOIN edges e ON p.id = e.src WHERE p.dist IS NOT NULL GROUP BY e.dst) m
      ON m.dst = h.id
    WHERE h.moved))"""
SQL["hop_distance"] = with_(*GRAPH, HOPS, recursive=True) + (
    "SELECT id AS zone_id, hops, ROUND(dist, 6) AS distance FROM hd WHERE it = (SELECT MAX(it) FROM hd)"
)
# routes: the least (distance, edges, previous zone) of every zone, then back to the source
ROUTES = """so AS (SELECT src AS s FROM edges GROUP BY src ORDER BY SUM(trip_count) DESC, src LIMIT 1),
le AS (SELECT src, dst, COALESCE(ROUND(avg_distance, 6), 0.0) AS len FROM edges),
lb(it, id, dist, steps, prev, moved) AS (
  SELECT 0, id, CASE WHEN id = (SELECT s FROM so) THEN 0.0::DOUBLE END, CASE WHEN id = (SELECT s FROM so) THEN 0 END,
         NULL::INT, TRUE FROM v
  UNION ALL
  SELECT it, id, dist, steps, prev, bool_or(differs) OVER () FROM (
    SELECT c.it + 1 AS it, c.id, c.dist, c.steps, c.prev, c.dist IS DISTINCT FROM h.dist OR c.steps IS DISTINCT FROM h.steps AS differs,
           ROW_NUMBER() OVER (PARTITION BY c.id ORDER BY c.dist NULLS LAST, c.steps, c.prev NULLS FIRST) AS rn
    FROM (SELECT it, id, dist, steps, prev FROM lb WHERE moved
          UNION ALL
          SELECT p.it, e.dst, p.dist + e.len, p.steps + 1, p.id FROM lb p JOIN le e ON p.id = e.src
          WHERE p.moved AND p.dist IS NOT NULL) c
    JOIN lb h ON h.id = c.id) WHERE rn = 1),
best AS (SELECT id, dist, steps, prev FROM lb WHERE it = (SELECT MAX(it) FROM lb) AND dist IS NOT NULL),
rt(zone_id, step, via) AS (
  SELECT id, steps, id FROM best
  UNION ALL
  SELECT rt.zone_id, rt.step - 1, b.prev FROM rt JOIN best b ON b.id = rt.via WHERE rt.step > 0)"""
SQL["shortest_route"] = with_(*GRAPH, ROUTES, recursive=True) + (
    "SELECT rt.zone_id, rt.step, rt.via, ROUND(best.dist, 6) AS distance FROM rt JOIN best ON best.id = rt.via"
)
PROF = ("COUNT(*) AS trips, ROUND(SUM(fare_amount), 2) AS total_fare, ROUND(AVG(fare_amount), 6) AS avg_fare,"
        " ROUND(SUM(tip_amount), 2) AS total_tip, ROUND(AVG(trip_distance), 6) AS avg_distance")
SQL["monthly_profile"] = with_(TRIPS, CLEAN) + (
    f"SELECT year(pickup_ts)::INT AS year, month(pickup_ts)::INT AS month, {PROF} FROM clean GROUP BY 1, 2"
)
SQL["weekday_profile"] = with_(TRIPS, CLEAN) + f"SELECT isodow(pickup_ts)::INT AS iso_weekday, {PROF} FROM clean GROUP BY 1"
SQL["edges_by_month"] = with_(TRIPS, CLEAN) + (
    "SELECT year(pickup_ts)::INT AS year, month(pickup_ts)::INT AS month, PULocationID AS src, DOLocationID AS dst,"
    " COUNT(*) AS trip_count, ROUND(SUM(fare_amount), 4) AS total_fare FROM clean GROUP BY 1, 2, 3, 4"
)
SQL["edges_by_window"] = with_(TRIPS, CLEAN) + (
    "SELECT strftime(time_bucket(INTERVAL '7 days', pickup_ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d') AS window_start,"
    " PULocationID AS src, DOLocationID AS dst, COUNT(*) AS trip_count, ROUND(SUM(fare_amount), 4) AS total_fare"
    " FROM clean GROUP BY 1, 2, 3"
)
SQL["stream_edges"] = SQL["edges_by_window"]
# late trips come when the watermark has long passed their windows, so a live table lacks them
_LIVE = SQL["edges_by_window"].replace(
    " FROM clean GROUP BY", f" FROM clean WHERE NOT ({HASH} = 0 AND pickup_ts < TIMESTAMP '1994-01-01') GROUP BY")
SQL["stream_edges_live"] = f"SELECT * FROM (VALUES ('before'), ('after')) s(state) CROSS JOIN ({_LIVE})"
# windows that end by the last valid trip's time less 14 days
SQL["stream_edges_closed"] = with_(TRIPS, CLEAN) + (
    "SELECT strftime(w, '%Y-%m-%d') AS window_start, PULocationID AS src, DOLocationID AS dst, COUNT(*) AS trip_count,"
    " ROUND(SUM(fare_amount), 4) AS total_fare"
    " FROM (SELECT *, time_bucket(INTERVAL '7 days', pickup_ts, TIMESTAMP '1970-01-01') AS w FROM clean)"
    " WHERE w + INTERVAL '7 days' <= (SELECT MAX(pickup_ts) FROM clean) - INTERVAL '14 days' GROUP BY 1, 2, 3"
)

SQL["size_rank_corr"] = with_(*COMM, recursive=True) + (
    "SELECT ROUND(CORR(num_zones::DOUBLE, total_pagerank), 6) AS size_rank_corr, COUNT(*) AS num_communities FROM cstats"
)
SQL["hourly_profile"] = with_(TRIPS, CLEAN) + f"SELECT hour(pickup_ts)::INT AS hour, {PROF} FROM clean GROUP BY 1"
SQL["report_csvs"] = SQL["summary_report"].replace("SELECT metric, ROUND(value, 6) AS value FROM (", """SELECT file, metric, ROUND(value, 6) AS value FROM (
  SELECT 'top' AS file, zone_id::VARCHAR AS metric, pagerank AS value
  FROM (SELECT * FROM pr ORDER BY ROUND(pagerank, 6) DESC, zone_id LIMIT 50)
  UNION ALL SELECT 'summary', metric, value FROM (""", 1) + ")"

# PageRank until the largest change of a round is below 1e-6;
# each row carries the largest change of its round, the recursion stops after it drops
PR_TOL = """tt AS (SELECT e.src, e.dst, 1.0 / COUNT(*) OVER (PARTITION BY e.src) AS w FROM edges e),
rt(it, id, rank, md) AS (
  SELECT 0, id, 1.0::DOUBLE, 1e9::DOUBLE FROM v
  UNION ALL
  SELECT it, id, rank, MAX(ABS(rank - old)) OVER () FROM (
    SELECT any_value(r0.it) + 1 AS it, v.id, 0.15 + 0.85 * COALESCE(SUM(m.c), 0) AS rank, any_value(o.rank) AS old
    FROM v CROSS JOIN (SELECT DISTINCT it, md FROM rt) r0
    LEFT JOIN (SELECT t.dst, r.rank * t.w AS c FROM rt r JOIN tt t ON r.id = t.src) m ON m.dst = v.id
    LEFT JOIN rt o ON o.id = v.id
    WHERE r0.md >= 1e-6 GROUP BY v.id)),
lastit AS (SELECT MAX(it) AS it FROM rt)"""
SQL["pagerank_tol"] = with_(*GRAPH, PR_TOL, recursive=True) + (
    "SELECT id AS zone_id, ROUND(rank * (SELECT COUNT(*) FROM v) / (SELECT SUM(rank) FROM rt WHERE it = (SELECT it FROM lastit)), 6)"
    " AS pagerank, (SELECT it FROM lastit) AS iterations, TRUE AS converged FROM rt WHERE it = (SELECT it FROM lastit)"
)
SQL["pagerank_residual"] = with_(*GRAPH, PR_TOL.replace("1e-6", "1e-11"), recursive=True) + (
    "SELECT id AS zone_id, ROUND(rank * (SELECT COUNT(*) FROM v) / (SELECT SUM(rank) FROM rt WHERE it = (SELECT it FROM lastit)), 6)"
    " AS pagerank FROM rt WHERE it = (SELECT it FROM lastit)"
)
SQL["pagerank_unit"] = with_(*PR, recursive=True) + (
    "SELECT zone_id, ROUND(pagerank / (SELECT COUNT(*) FROM v), 9) AS pagerank FROM pr"
)
_SAVED = {
    "edges": ("src", "dst", "total_fare", "edges"), "edges_csv": ("src", "dst", "total_fare", "edges"),
    "pagerank": ("zone_id", "zone_id", "pagerank", "pr"), "results_pagerank": ("zone_id", "zone_id", "pagerank", "pr"),
    "communities": ("zone_id", "community_id", "0.0", "comm"), "communities_csv": ("zone_id", "community_id", "0.0", "comm"),
    "community_stats": ("community_id", "num_zones", "total_pagerank", "cstats"),
    "community_stats_csv": ("community_id", "num_zones", "total_pagerank", "cstats"),
}
SQL["results_roundtrip"] = with_(*COMM, recursive=True) + " UNION ALL ".join(
    f"SELECT '{k}' AS saved, {a}::BIGINT AS a, {b}::BIGINT AS b, ROUND({x}::DOUBLE, 4) AS value FROM {t}"
    for k, (a, b, x, t) in _SAVED.items()
)
SQL["clean_trips_table"] = SQL["clean_trips"]
SQL["scan_months_partitioned"] = SQL["scan_months"]

# ------------------------------------------------------------------ metric tables from counts
COUNTS = "WITH counts AS (" + SQL["sweep_counts"] + ")"
RUN = "'sample_' || sample_pct || 'pct' AS run_name"
SQL["sweep_build"] = COUNTS + f""" SELECT {RUN}, 'build_graph' AS step, sample_pct / 100.0::DOUBLE AS sample_fraction,
  raw_rows, cleaned_rows, edges FROM counts"""
SQL["metrics_json_latest"] = SQL["sweep_build"] + " WHERE sample_pct = 100"
SQL["run_summary"] = COUNTS + f""" SELECT {RUN}, 'build_graph' AS step, sample_pct / 100.0::DOUBLE AS sample_fraction,
  raw_rows AS rows_read FROM counts
  UNION ALL SELECT {RUN}, 'pagerank', sample_pct / 100.0::DOUBLE, edges FROM counts"""
COVERAGE = COUNTS + """, metrics AS (
  SELECT mode, sample_pct AS seq, 'sample_' || sample_pct || 'pct' AS test,
         CASE WHEN edges * 2 >= (SELECT MAX(edges) FROM counts) THEN 'SUCCESS' ELSE 'FAILED' END AS status,
         sample_pct / 100.0::DOUBLE AS sample_fraction,
         CASE mode WHEN 'raw' THEN raw_rows ELSE cleaned_rows END AS result_rows
  FROM counts, (VALUES ('raw'), ('clean')) m(mode)) """
SQL["metrics_csv_roundtrip"] = COVERAGE + """SELECT *, result_rows / 1e6::DOUBLE AS time_seconds,
  CASE WHEN status = 'FAILED' THEN 'too few edges' END AS error FROM metrics"""
SQL["success_rate"] = COVERAGE + """SELECT mode, COUNT(*) AS tests, COUNT(*) FILTER (WHERE status = 'SUCCESS') AS successes,
  ROUND(COUNT(*) FILTER (WHERE status = 'SUCCESS') / COUNT(*)::DOUBLE * 100, 6) AS success_pct FROM metrics GROUP BY mode"""
SQL["status_counts"] = COVERAGE + "SELECT mode, status, COUNT(*) AS n FROM metrics GROUP BY 1, 2"
SQL["stress_curve"] = COVERAGE + """SELECT mode, sample_fraction * 100 AS sample_pct, result_rows
  FROM metrics WHERE status = 'SUCCESS'"""
SQL["compare_metrics"] = COVERAGE + """SELECT c.test, c.status AS clean_status, c.result_rows AS clean_result_rows,
  r.status AS raw_status, r.result_rows AS raw_result_rows,
  CASE WHEN r.status = 'SUCCESS' AND c.status = 'SUCCESS' THEN ROUND(c.result_rows / r.result_rows::DOUBLE, 6) END AS share_kept,
  r.status = 'SUCCESS' AND c.status = 'SUCCESS' AS complete
  FROM metrics r JOIN metrics c USING (test) WHERE r.mode = 'raw' AND c.mode = 'clean'"""
SQL["sweep_pagerank"] = with_(TRIPS, CLEAN) + " UNION ALL ".join(
    f"""SELECT 'sample_{pct}pct' AS run_name, 'pagerank' AS step, {pct / 100}::DOUBLE AS sample_fraction,
  (SELECT COUNT(DISTINCT id) FROM (SELECT PULocationID AS id FROM clean WHERE {HASH} < {pct}
                                   UNION ALL SELECT DOLocationID FROM clean WHERE {HASH} < {pct})) AS vertices,
  (SELECT COUNT(*) FROM (SELECT DISTINCT PULocationID, DOLocationID FROM clean WHERE {HASH} < {pct})) AS edges,
  5 AS iterations""" for pct in (10, 100)
)
SQL["louvain_modularity"] = (
    "SELECT modularity AS lpa_modularity, TRUE AS louvain_not_worse, TRUE AS modularity_as_told, TRUE AS converged FROM (" + SQL["modularity"] + ")"
)
SQL["zone_features"] = with_(*PR, HITS, recursive=True) + """, norms AS (
  SELECT id AS zone_id, hub / SQRT(SUM(hub * hub) OVER ()) AS hub, auth / SQRT(SUM(auth * auth) OVER ()) AS authority
  FROM h WHERE it = 20),
sides AS (
  SELECT zone_id, SUM(o)::DOUBLE AS out_degree, SUM(i)::DOUBLE AS in_degree, SUM(os)::DOUBLE AS out_strength,
         SUM(ist)::DOUBLE AS in_strength
  FROM (SELECT src AS zone_id, 1 AS o, 0 AS i, trip_count AS os, 0 AS ist FROM edges
        UNION ALL SELECT dst, 0, 1, 0, trip_count FROM edges) GROUP BY zone_id)
SELECT zone_id, ROUND(pagerank, 6) AS pagerank, out_degree, in_degree, out_strength, in_strength,
       ROUND(hub, 6) AS hub, ROUND(authority, 6) AS authority
FROM pr JOIN sides USING (zone_id) JOIN norms USING (zone_id)"""

# k-means: farthest-first centres, then rounds until no zone changes its cluster
_FEATURES = ("pagerank", "out_degree", "in_degree", "out_strength", "in_strength", "hub", "authority")
_POINTS = SQL["zone_features"].replace("ROUND(pagerank, 6)", "pagerank").replace("ROUND(hub, 6)", "hub").replace(
    "ROUND(authority, 6)", "authority")
_AWAY = "list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"


def _seed(k: int) -> str:
    if k == 0:
        return f"c0 AS (SELECT 0 AS k, x FROM pts ORDER BY {_AWAY.format(a='x', b='[0.0, 0, 0, 0, 0, 0, 0]')} DESC, zone_id LIMIT 1)"
    away = _AWAY.format(a="pts.x", b="c.x")
    return (f"c{k} AS (SELECT * FROM c{k - 1} UNION ALL (SELECT {k}, x FROM (SELECT pts.zone_id, any_value(pts.x) AS x, MIN({away}) AS d"
            f" FROM pts CROSS JOIN c{k - 1} c GROUP BY pts.zone_id) WHERE d > 0 ORDER BY d DESC, zone_id LIMIT 1))")


_SCALED = ", ".join(f"COALESCE(({c} - AVG({c}) OVER ()) / NULLIF(STDDEV_SAMP({c}) OVER (), 0), 0)" for c in _FEATURES)
_MEANS = ", ".join(f"AVG(x[{i}])" for i in range(1, 8))
KMEANS = f"""feats AS ({_POINTS}),
pts AS (SELECT zone_id, [{_SCALED}] AS x FROM feats),
{", ".join(_seed(k) for k in range(5))},
km(it, zone_id, x, k, moved) AS (
  SELECT 0, zone_id, x, k, TRUE FROM (
    SELECT pts.zone_id, pts.x, c.k, ROW_NUMBER() OVER (PARTITION BY pts.zone_id ORDER BY {_AWAY.format(a="pts.x", b="c.x")}, c.k) AS rn
    FROM pts CROSS JOIN c4 c) WHERE rn = 1
  UNION ALL
  SELECT it, zone_id, x, k, bool_or(k <> was) OVER () FROM (
    SELECT h.it + 1 AS it, h.zone_id, h.x, h.k AS was, c.k,
           ROW_NUMBER() OVER (PARTITION BY h.zone_id ORDER BY {_AWAY.format(a="h.x", b="c.x")}, c.k) AS rn
    FROM km h CROSS JOIN (SELECT k, [{_MEANS}] AS x FROM km GROUP BY k) c WHERE h.moved) WHERE rn = 1),
clusters AS (SELECT zone_id, k AS cluster FROM km WHERE it = (SELECT MAX(it) FROM km))"""
SQL["zone_kmeans"] = f"WITH RECURSIVE {KMEANS} SELECT zone_id, cluster, TRUE AS converged FROM clusters"
SQL["zone_cluster_profile"] = f"WITH RECURSIVE {KMEANS} SELECT cluster, COUNT(*) AS num_zones, " + ", ".join(
    f"ROUND(AVG({c}), 6) AS avg_{c}" for c in _FEATURES) + " FROM clusters JOIN feats USING (zone_id) GROUP BY cluster"
