"""A rolling edge list that tells every window of a pair once, when it closes.

A stateful operator keeps, for every (src, dst), the trips of its open windows.
An event-time timer at the end of the earliest one fires once the watermark has
passed it: the window's edge is told and its state goes, so a pair holds no more
windows than the watermark leaves open.  Trips of a window that has closed are
left out by Spark and counted: :func:`run_closing_edges` returns their number.

State is partitioned by pair, so a zone with a third of all trips is as many
groups as it has neighbours, and each of a batch's groups is folded into a few
numbers a window.
"""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from odgraph.functions.exprs import valid_trip
from odgraph.params import DEFAULTS, DROPOFF, FARE, PICKUP, PICKUP_TS, Params
from odgraph.streaming.edges import _dated

OUT = "src int, dst int, window_ms long, trip_count long, total_fare double"
STATE = "ends array<long>, counts array<long>, fares array<double>"


def _teller(size_ms: int):
    """The update function of one pair for windows of ``size_ms`` milliseconds."""

    def tell(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        held = {e: [c, f] for e, c, f in zip(*state.get)} if state.exists else {}
        for frame in [] if state.hasTimedOut else frames:
            for end, fares in frame["fare"].groupby(frame["end_ms"]):
                cell = held.setdefault(int(end), [0, 0.0])
                cell[0] += len(fares)
                cell[1] += float(fares.sum())
        closed = {e: held.pop(e) for e in sorted(held) if e <= watermark}
        if held:
            ends = sorted(held)
            state.update((ends, [held[e][0] for e in ends], [held[e][1] for e in ends]))
            # a timer fires when the watermark is beyond it
            state.setTimeoutTimestamp(max(ends[0] - 1, watermark + 1))
        elif state.exists:
            state.remove()
        rows = [(*key, e - size_ms, c, f) for e, (c, f) in closed.items()]
        if rows:
            yield pd.DataFrame(rows, columns=["src", "dst", "window_ms", "trip_count", "total_fare"])

    return tell


def closing_edges(trips: DataFrame, days: int, watermark: str, p: Params = DEFAULTS) -> DataFrame:
    """The stream of told windows of ``trips``; windows of ``days`` days since the epoch."""
    dated = _dated(trips).filter(valid_trip(p)).withWatermark(PICKUP_TS, watermark)
    # the event time is the window's, so a trip is late only where its window has closed
    rows = dated.withColumn("w", F.window(PICKUP_TS, f"{days} days")).select(
        F.col(PICKUP).cast("int").alias("src"), F.col(DROPOFF).cast("int").alias("dst"), F.window_time("w").alias("told_at"),
        F.unix_millis("w.end").alias("end_ms"), F.col(FARE).cast("double").alias("fare"))
    return rows.groupBy("src", "dst").applyInPandasWithState(
        _teller(days * 86_400_000), OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def run_closing_edges(spark: SparkSession, source_dir: str, out: str, checkpoint: str, *, schema,
                      transform: Callable[[DataFrame], DataFrame] = lambda df: df, glob: str | None = None,
                      days: int = 7, watermark: str = "14 days", max_files_per_trigger: int | None = 1000,
                      p: Params = DEFAULTS) -> int:
    """Process every file now in ``source_dir`` and stop; told rows go to
    ``out/batch_id=<n>`` with overwrite, so a batch that runs again replaces its own.
    Returns the number of late trips, those whose window had closed before."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = closing_edges(transform(reader.parquet(source_dir)), days, watermark, p)

    late: dict[int, int] = {}
    query = None

    def note() -> None:
        done = query.lastProgress if query is not None else None
        if done is not None:
            late[done.batchId] = sum(s.numRowsDroppedByWatermark for s in done.stateOperators)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        note()  # of the batch before

    query = rows.writeStream.outputMode("append").foreachBatch(sink).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    for done in query.recentProgress:
        late[done.batchId] = sum(s.numRowsDroppedByWatermark for s in done.stateOperators)
    return sum(late.values())


def read_closed(spark: SparkSession, out: str) -> DataFrame:
    """``window_start, src, dst, trip_count, total_fare`` of the windows told so far, one row each."""
    return spark.read.parquet(out).select(
        F.timestamp_millis("window_ms").alias("window_start"), "src", "dst", "trip_count", "total_fare")
