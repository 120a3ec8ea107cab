"""Temporal profiles of the cleaned trips and per-period edge lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odgraph.params import DISTANCE, DROPOFF, FARE, PICKUP, PICKUP_TS, TIP


def _profile(df: DataFrame, keys) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum(FARE).alias("total_fare"),
        F.avg(FARE).alias("avg_fare"),
        F.sum(TIP).alias("total_tip"),
        F.avg(DISTANCE).alias("avg_distance"),
    )


def monthly_profile(clean: DataFrame, ts: str = PICKUP_TS) -> DataFrame:
    """Trips and fares per calendar month."""
    return _profile(clean, [F.year(ts).alias("year"), F.month(ts).alias("month")])


def weekday_profile(clean: DataFrame, ts: str = PICKUP_TS) -> DataFrame:
    """Trips and fares per ISO weekday (1 = Monday … 7 = Sunday)."""
    return _profile(clean, [(F.weekday(ts) + 1).alias("iso_weekday")])


def hourly_profile(clean: DataFrame, ts: str = PICKUP_TS) -> DataFrame:
    """Trips and fares per hour of day."""
    return _profile(clean, [F.hour(ts).alias("hour")])


def edges_by_month(clean: DataFrame, ts: str = PICKUP_TS) -> DataFrame:
    """Per-month edge list: the graph of each month, one aggregate."""
    return clean.groupBy(
        F.year(ts).alias("year"), F.month(ts).alias("month"),
        F.col(PICKUP).alias("src"), F.col(DROPOFF).alias("dst"),
    ).agg(F.count(F.lit(1)).alias("trip_count"), F.sum(FARE).alias("total_fare"))


def edges_by_window(clean: DataFrame, duration: str = "7 days", ts: str = PICKUP_TS) -> DataFrame:
    """Edge list per tumbling time window (the batch twin of the stream)."""
    return clean.groupBy(
        F.window(ts, duration).alias("w"), F.col(PICKUP).alias("src"), F.col(DROPOFF).alias("dst")
    ).agg(F.count(F.lit(1)).alias("trip_count"), F.sum(FARE).alias("total_fare")).select(
        F.col("w.start").alias("window_start"), "src", "dst", "trip_count", "total_fare"
    )
