"""Trip scans.

Two ways in:

* :func:`read_trips` — a real trip Parquet directory (or glob, or list of
  monthly files).  Only the five columns the graph needs are read, with a
  declared schema (64-bit ids, double amounts), so the scan prunes every
  other column, takes files of either id width, and the cleaning predicate
  reaches the Parquet reader as pushed filters.
* :func:`trips_from_lineitem` — the ``trips`` view over the driver's
  TPC-H-style ``lineitem`` table (the test data holds no taxi trips).
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odgraph.params import DISTANCE, DROPOFF, FARE, PICKUP, PICKUP_TS, TIP, TRIP_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _validate(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"trip table lacks columns {missing}; has {df.columns}")


def conform_trips(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Project to the five trip columns (+ ``keep``).

    Id columns stay as they are read, so the cleaning rule is a filter on bare
    columns that reaches the files; :func:`~odgraph.operators.clean.clean_trips`
    narrows 64-bit ids after it, when only valid zones are left.
    """
    _validate(df, TRIP_COLUMNS)
    extra = [c for c in keep if c in df.columns and c not in TRIP_COLUMNS]
    return df.select(
        PICKUP,
        DROPOFF,
        F.col(DISTANCE).cast("double").alias(DISTANCE),
        F.col(FARE).cast("double").alias(FARE),
        F.col(TIP).cast("double").alias(TIP),
        *extra,
    )


def read_trips(
    spark: SparkSession,
    paths: str | list[str],
    *,
    keep: Iterable[str] = (),
    merge_schema: bool = False,
    glob: str | None = None,
) -> DataFrame:
    """Scan one directory, a glob, or several monthly files.

    The read schema is declared: ids are 64-bit and amounts double, which the
    Parquet reader widens from 32-bit files, so files of either width can be
    mixed and a column that only later files have does not matter.  Columns in
    ``keep`` take their type from the first file, or with ``merge_schema``
    from all files.
    """
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    path_list = [paths] if isinstance(paths, str) else list(paths)
    kept = [c for c in keep if c not in TRIP_COLUMNS]
    found = reader.option("mergeSchema", str(merge_schema and bool(kept)).lower()).parquet(*path_list)
    _validate(found, TRIP_COLUMNS)
    fields = [T.StructField(c, T.LongType()) for c in (PICKUP, DROPOFF)]
    fields += [T.StructField(c, T.DoubleType()) for c in (DISTANCE, FARE, TIP)]
    fields += [found.schema[c] for c in kept if c in found.columns]
    return conform_trips(reader.schema(T.StructType(fields)).parquet(*path_list), keep=keep)


def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """The ``trips`` view over ``lineitem`` (FIXTURES §2).

    About 90 % of trips stay inside a 30-zone block, so the graph has planted
    communities; out-of-range ids, null pickups, self-loops and negative fares
    all occur, so every cleaning rule fires.  The row key
    ``(l_orderkey, l_linenumber)`` is carried for hash sampling.
    """
    pu = (F.col("l_partkey") % 270).cast("int")
    b = lineitem.select(
        pu.alias("pu"),
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_tax",
        "l_shipdate",
    )
    dropoff = F.when(
        F.col("l_quantity") <= 45,
        F.col("pu") - F.col("pu") % 30 + F.col("l_orderkey") % 30,
    ).otherwise(F.col("l_orderkey") % 270)
    return b.select(
        F.when(F.col("pu") == 269, F.lit(None)).otherwise(F.col("pu")).cast("int").alias(PICKUP),
        dropoff.cast("int").alias(DROPOFF),
        F.col("l_quantity").alias(DISTANCE),
        (F.col("l_extendedprice") - F.lit(2000.0)).alias(FARE),
        (F.col("l_extendedprice") * F.col("l_tax")).alias(TIP),
        F.col("l_shipdate").alias(PICKUP_TS),
        "l_orderkey",
        "l_linenumber",
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip table of a driver data directory."""
    return trips_from_lineitem(table(spark, sf_dir, "lineitem"))


# SQL text of the same view, for DuckDB oracles (and Spark SQL users).
TRIPS_SQL = """
SELECT CASE WHEN pu = 269 THEN NULL ELSE pu END AS PULocationID,
       CAST(CASE WHEN l_quantity <= 45 THEN pu - pu % 30 + l_orderkey % 30
                 ELSE l_orderkey % 270 END AS INT) AS DOLocationID,
       l_quantity AS trip_distance,
       l_extendedprice - 2000.0 AS fare_amount,
       l_extendedprice * l_tax AS tip_amount,
       l_shipdate AS pickup_ts,
       l_orderkey, l_linenumber
FROM (SELECT CAST(l_partkey % 270 AS INT) AS pu, l_orderkey, l_linenumber, l_quantity,
             l_extendedprice, l_tax, l_shipdate FROM lineitem) b
"""


def months_filter(df: DataFrame, months: Iterable[str], ts: str = PICKUP_TS) -> DataFrame:
    """Keep trips whose pickup month (``'YYYY-MM'``) is listed.

    Expressed as a range predicate on the bare timestamp column per month so
    that it is pushed to the Parquet reader (and prunes partitions when the
    data is partitioned by month).
    """
    cond = None
    for m in sorted(set(months)):
        start = F.to_timestamp_ntz(F.lit(f"{m}-01 00:00:00"))
        end = F.to_timestamp_ntz(F.lit(f"{m}-01 00:00:00")) + F.expr("INTERVAL 1 MONTH")
        c = (F.col(ts) >= start) & (F.col(ts) < end)
        cond = c if cond is None else (cond | c)
    if cond is None:
        return df.limit(0)
    return df.filter(cond)


def write_trips_table(trips: DataFrame, path: str, ts: str = PICKUP_TS) -> str:
    """Store trips as Parquet partitioned by pickup ``year``/``month``.

    A rebalance by month gathers a month's rows in few tasks before the write
    (adaptive execution splits a large month and joins small ones), so the
    number of files follows the data and not tasks times months.
    """
    dated = trips.withColumn("year", F.year(ts)).withColumn("month", F.month(ts))
    (dated.hint("rebalance", "year", "month")
     .write.mode("overwrite").partitionBy("year", "month").parquet(path))
    return path


def read_trips_table(spark: SparkSession, path: str, months: Iterable[str] | None = None,
                     keep: Iterable[str] = ()) -> DataFrame:
    """Read a table written by :func:`write_trips_table`.

    ``months`` (``'YYYY-MM'``) becomes a predicate on the partition columns,
    so only those folders are listed and read (``PartitionFilters``).
    """
    df = spark.read.parquet(path)
    if months is not None:
        cond = None
        for m in sorted(set(months)):
            y, mo = (int(x) for x in m.split("-"))
            c = (F.col("year") == y) & (F.col("month") == mo)
            cond = c if cond is None else (cond | c)
        df = df.filter(cond) if cond is not None else df.limit(0)
    return conform_trips(df, keep=keep)
