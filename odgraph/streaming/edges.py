"""A live edge list with Structured Streaming.

New trip files arriving in a folder are cleaned and folded into per-window
edge counts, in one of two ways:

* **backlog** (``watermark=None``): every micro-batch is cleaned and
  aggregated by itself and its partial counts are written by ``foreachBatch``
  to ``<out>/batch_id=<n>`` with overwrite (a retried batch replaces its own
  output).  :func:`read_stream_result` adds the partial counts up, so the
  result equals the batch result for any file layout, any order of event
  times and any batch size; :func:`compact_stream_result` folds the batch
  folders into one.  The stream keeps no state.
* **live** (a watermark): windows are stream state; once the watermark passes
  a window its state is released and later trips for it are dropped.  Every
  micro-batch upserts its updated rows into a :class:`~odgraph.streaming.live.LiveTable`.

:mod:`odgraph.streaming.closing` tells every window once, when it closes, and
counts the trips that come later.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odgraph.functions.exprs import ntz_as_utc_instant, valid_trip
from odgraph.params import DEFAULTS, DROPOFF, FARE, PICKUP, PICKUP_TS, Params
from odgraph.streaming.live import LiveTable


def _dated(trips: DataFrame) -> DataFrame:
    """A ``TIMESTAMP_NTZ`` pickup time as the instant with the same UTC wall clock
    (arithmetically, so the windows do not move with the session time zone)."""
    if dict(trips.dtypes).get(PICKUP_TS) == "timestamp_ntz":
        return trips.withColumn(PICKUP_TS, ntz_as_utc_instant(PICKUP_TS))
    return trips


def _window_counts(trips: DataFrame, duration: str) -> DataFrame:
    return (
        trips.groupBy(F.window(PICKUP_TS, duration).alias("w"), F.col(PICKUP).alias("src"), F.col(DROPOFF).alias("dst"))
        .agg(F.count(F.lit(1)).alias("trip_count"), F.sum(FARE).alias("total_fare"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                "src", "dst", "trip_count", "total_fare")
    )


def windowed_edges(trips: DataFrame, duration: str, watermark: str, p: Params = DEFAULTS) -> DataFrame:
    """Per-window edge counts with a watermark on the pickup time.

    Watermarks need a ``TIMESTAMP`` event time (see :func:`_dated`).
    """
    return _window_counts(_dated(trips).filter(valid_trip(p)).withWatermark(PICKUP_TS, watermark), duration)


def run_stream_edges(
    spark: SparkSession,
    source_dir: str,
    out: str,
    checkpoint: str,
    *,
    schema,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    glob: str | None = None,
    duration: str = "7 days",
    watermark: str | None = None,
    max_files_per_trigger: int | None = 1000,
    p: Params = DEFAULTS,
) -> None:
    """Process every file now in ``source_dir`` (``availableNow``) and stop.

    ``source_dir`` is a folder of files; ``max_files_per_trigger`` bounds a
    micro-batch.
    """
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = transform(reader.parquet(source_dir))
    if watermark is None:
        rows, mode = _dated(stream).filter(valid_trip(p)), "append"
    else:
        rows, mode = windowed_edges(stream, duration, watermark, p), "update"

    def sink(batch: DataFrame, batch_id: int) -> None:
        if watermark is None:
            _window_counts(batch, duration).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        else:
            LiveTable(spark, out).upsert(batch, batch_id)

    q = (
        rows.writeStream.outputMode(mode)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def read_stream_result(spark: SparkSession, out: str, live: bool = False) -> DataFrame:
    """Current edge list: a backlog's partial counts added up, or a ``live``
    stream's current row of every (window, src, dst)."""
    if live:
        return LiveTable(spark, out).read()
    return spark.read.parquet(out).groupBy("window_start", "window_end", "src", "dst").agg(
        F.sum("trip_count").alias("trip_count"), F.sum("total_fare").alias("total_fare"))


def compact_stream_result(spark: SparkSession, out: str, target: str) -> str:
    """Fold a finished backlog run's batch folders into one table at ``target``
    (read it with :func:`read_stream_result` too); run it between runs.  A live
    stream's table is folded by :meth:`LiveTable.compact`."""
    read_stream_result(spark, out).write.mode("overwrite").parquet(f"{target}/batch_id=-1")
    return target
