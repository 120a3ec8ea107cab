"""Trip cleaning and its audit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odgraph.functions.exprs import pct, valid_trip
from odgraph.params import DEFAULTS, DROPOFF, FARE, PICKUP, Params


def clean_trips(trips: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """keep trips that can be graph edges (one ``filter``, pushed down).

    64-bit ids become ``int`` after the filter, when they are valid zones.
    """
    kept = trips.filter(valid_trip(p))
    wide = [c for c in (PICKUP, DROPOFF) if kept.schema[c].dataType.simpleString() == "bigint"]
    return kept.withColumns({c: F.col(c).cast("int") for c in wide}) if wide else kept


def _audit_aggs(p: Params):
    pu, do, fare = F.col(PICKUP), F.col(DROPOFF), F.col(FARE)
    in_range = lambda c: c.between(p.min_zone, p.max_zone)
    return [
        F.count(F.lit(1)).alias("original_rows"),
        F.count_if(valid_trip(p)).alias("kept_rows"),
        F.count_if(pu.isNull()).alias("null_pickup"),
        F.count_if(do.isNull()).alias("null_dropoff"),
        F.count_if(~in_range(pu)).alias("pickup_out_of_range"),
        F.count_if(~in_range(do)).alias("dropoff_out_of_range"),
        F.count_if(pu == do).alias("self_loops"),
        F.count_if(fare < 0).alias("negative_fare"),
        F.count_if(fare.isNull()).alias("null_fare"),
    ]


def _audit_row(row: DataFrame) -> DataFrame:
    return row.select(
        "original_rows",
        "kept_rows",
        (F.col("original_rows") - F.col("kept_rows")).alias("removed_rows"),
        pct(F.col("original_rows") - F.col("kept_rows"), "original_rows").alias("removed_pct"),
        "null_pickup",
        "null_dropoff",
        "pickup_out_of_range",
        "dropoff_out_of_range",
        "self_loops",
        "negative_fare",
        "null_fare",
    )


def cleaning_audit(trips: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """one aggregate pass — original, kept, removed, removed % and per rule.

    The reference counts before and after the filter (two scans) and divides
    by zero on empty input; here a single ``agg`` with ``count_if`` returns
    one row, and the percentage is null for an empty table.
    """
    return _audit_row(trips.agg(*_audit_aggs(p)))
