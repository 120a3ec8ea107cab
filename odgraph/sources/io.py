"""Parquet/CSV/JSON readers and writers, zone lookup."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odgraph.params import EDGE_SCHEMA


def write_parquet(df: DataFrame, path: str) -> str:
    """Overwrite a Parquet directory."""
    df.write.mode("overwrite").parquet(path)
    return path


def read_edge_list(spark: SparkSession, path: str) -> DataFrame:
    """The edge list, with its declared schema."""
    return spark.read.schema(EDGE_SCHEMA).parquet(path)


def csv_path_for(path: str) -> str:
    """The reference's path rule ``/graph/``→``/graph_csv/``, ``/results/``→``/results_csv/``."""
    return path.replace("/graph/", "/graph_csv/").replace("/results/", "/results_csv/")


def write_csv(df: DataFrame, path: str, single_file: bool = True) -> str:
    """CSV with a header.

    ``single_file`` gives one part file (the reference's ``coalesce(1)``);
    use it only for bounded outputs (top-k, summaries) — a large table should
    be written in parallel with ``single_file=False``.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", "true").csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", "true").csv(path)


def save_dataframe_as_csv(df: DataFrame, path: str, sample_size: int | None = None) -> str:
    """Optionally the first ``sample_size`` rows, then CSV.

    A bounded sample is written as one file (as the reference does); a whole
    table is written in parallel, one file per partition.
    """
    if sample_size:
        return write_csv(df.limit(sample_size), path, single_file=True)
    return write_csv(df, path, single_file=False)


def export_top(ranks: DataFrame, path: str, k: int = 100) -> str:
    """The top-k zones by rank (ties by id) as one CSV."""
    top = ranks.orderBy(F.desc(F.round("pagerank", 6)), "zone_id").limit(k)
    return write_csv(top, path)


def save_metrics_json(metrics: DataFrame, folder: str, timestamp: str | None = None) -> str:
    """Metric rows (a handful per run) as one JSON-lines file in
    ``<folder>/benchmark_<yyyymmdd_HHMMSS>``."""
    name = timestamp or datetime.now().strftime("%Y%m%d_%H%M%S")
    path = f"{folder}/benchmark_{name}"
    metrics.coalesce(1).write.mode("overwrite").json(path)
    return path


def write_metrics_csv(metrics: DataFrame, path: str) -> str:
    """A metric table (a handful of rows) as one CSV file with a header."""
    return write_csv(metrics, path, single_file=True)


def read_metrics_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A metric CSV read back with its declared schema (no inference)."""
    return read_csv(spark, path, schema)


def read_metrics_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Metric JSON of a folder read back with its schema, plus each run's time stamp."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").json(path).withColumn(
        "saved_at", F.regexp_extract(F.col("_metadata.file_path"), r"benchmark_([0-9_]+)", 1))


def latest_metrics(df: DataFrame) -> DataFrame:
    """Rows of the run with the latest time stamp."""
    return df.filter(F.col("saved_at") == df.agg(F.max("saved_at")).scalar())


def stream_source(spark: SparkSession, path: str) -> tuple[str, str | None]:
    """Folder and file name pattern by which a stream reads a stored table, be it
    a folder of part files or a single file."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(hadoop).isDirectory():
        return path, None
    return hadoop.getParent().toString(), hadoop.getName()


ZONE_SCHEMA = T.StructType(
    [
        T.StructField("zone_id", T.IntegerType()),
        T.StructField("borough", T.StringType()),
        T.StructField("zone_name", T.StringType()),
    ]
)


def zones_from_nations(zone_ids: DataFrame, nation: DataFrame, region: DataFrame,
                       broadcast_limit: int = 100_000) -> DataFrame:
    """Zone lookup for the test data: zone ``z`` lies in nation ``z % 25``.

    Borough = region name, zone name = nation name; the lookup has one row
    per zone id that occurs.  The nation/region dimension is broadcast after
    its row count has been checked.
    """
    nr = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        "n_nationkey", "n_name", "r_name"
    )
    if nation.count() <= broadcast_limit:
        nr = F.broadcast(nr)
    return zone_ids.select(F.col("zone_id").cast("int")).distinct().join(
        nr, F.col("zone_id") % 25 == F.col("n_nationkey")
    ).select("zone_id", F.col("r_name").alias("borough"), F.col("n_name").alias("zone_name"))


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV (``zone_id, borough, zone_name``) with a header."""
    return read_csv(spark, path, ZONE_SCHEMA)


def attach_zone_names(df: DataFrame, zones: DataFrame, broadcast_limit: int = 100_000) -> DataFrame:
    """Left join of a per-zone result with the lookup.

    The lookup is a dimension table; it is broadcast only after its row
    count has been checked against ``broadcast_limit``, otherwise the join is
    left to the planner.
    """
    n = zones.count()
    z = F.broadcast(zones) if n <= broadcast_limit else zones
    return df.join(z, "zone_id", "left")


RANK_SCHEMA = T.StructType([T.StructField("zone_id", T.IntegerType()), T.StructField("pagerank", T.DoubleType())])
COMMUNITY_SCHEMA = T.StructType(
    [T.StructField("zone_id", T.IntegerType()), T.StructField("community_id", T.LongType())]
)
STATS_SCHEMA = T.StructType(
    [
        T.StructField("community_id", T.LongType()),
        T.StructField("num_zones", T.LongType()),
        T.StructField("total_pagerank", T.DoubleType()),
        T.StructField("avg_pagerank", T.DoubleType()),
    ]
)


def load_graph_data(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """The saved edge list and ranks of a pipeline output folder."""
    return (read_edge_list(spark, f"{out}/graph/edges"),
            spark.read.schema(RANK_SCHEMA).parquet(f"{out}/results/pagerank"))


def load_results(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """Ranks, community assignments and community statistics, typed."""
    return {
        "pagerank": spark.read.schema(RANK_SCHEMA).parquet(f"{out}/results/pagerank"),
        "communities": spark.read.schema(COMMUNITY_SCHEMA).parquet(f"{out}/results/communities"),
        "community_stats": spark.read.schema(STATS_SCHEMA).parquet(f"{out}/results/community_stats"),
    }
