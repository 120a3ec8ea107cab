"""The live table over several runs, and windows told once when they close."""

import datetime as dt

from odgraph.operators import clean, temporal
from odgraph.streaming import closing
from odgraph.streaming import edges as sedges
from odgraph.streaming.live import LiveTable

SCHEMA = "PULocationID int, DOLocationID int, trip_distance double, fare_amount double, tip_amount double, pickup_ts timestamp"


def _trip(pu, do, day, fare=10.0):
    return (pu, do, 1.0, fare, 1.0, dt.datetime(2024, 1, 1) + dt.timedelta(days=day))


def _rows(df):
    return sorted(map(tuple, df.select("window_start", "src", "dst", "trip_count", "total_fare").collect()))


def _batch(spark, trips):
    return _rows(temporal.edges_by_window(clean.clean_trips(spark.createDataFrame(trips, SCHEMA)), "7 days"))


def test_live_table_over_two_runs_a_retry_and_compaction(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    first = [_trip(1, 2, d) for d in range(0, 60, 3)] + [_trip(2, 3, d, 5.0) for d in range(1, 60, 7)]
    second, late = [_trip(1, 2, 58), _trip(2, 3, 80)], [_trip(3, 4, -30)]
    live = LiveTable(spark, out)
    assert live.mark == -1 and live.read().count() == 0 and live.compact() == -1
    for trips in (first, second + late):
        spark.createDataFrame(trips, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        sedges.run_stream_edges(spark, src, out, str(tmp_path / "ck"), schema=spark.createDataFrame([], SCHEMA).schema,
                                watermark="14 days", max_files_per_trigger=1)
        assert _rows(live.read()) == _batch(spark, first if trips is first else first + second)
    want = _rows(live.read())
    last = max(int(p.name.split("=")[1]) for p in (tmp_path / "out" / "batches").glob("batch_id=*"))
    again = spark.createDataFrame(live.batch(last).collect(), live.batch(last).schema)
    live.upsert(again, last)
    assert _rows(live.read()) == want
    assert live.compact() == last == live.mark and _rows(live.read()) == want
    live.upsert(again, last)  # below the mark
    assert _rows(live.read()) == want and live.compact() == last
    # counts of 1, then 3: the later batch's row holds, before and after folding
    row = [(dt.datetime(2024, 5, 2), dt.datetime(2024, 5, 9), 7, 8, n, 1.0 * n) for n in (1, 3)]
    for i in (0, 1):
        live.upsert(spark.createDataFrame(row[i:i + 1], live.read().schema), last + 1 + i)
    for _ in range(2):
        assert [r.trip_count for r in live.read().where("src = 7").collect()] == [3]
        live.compact()
    live.drop_folded()
    assert [r.trip_count for r in live.read().where("src = 7").collect()] == [3]
    assert [n for n in live.read().where("src <> 7").collect()] and len(live._names("base/mark=*")) == 1


def test_windows_are_told_once_when_they_close(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    first = [_trip(1, 2, d, 1.0 + d) for d in range(0, 60, 3)] + [_trip(2, 3, d, 5.0) for d in range(1, 60, 7)]
    second = [_trip(1, 2, 58), _trip(2, 3, 45), _trip(4, 5, 120), _trip(1, 1, 121)]
    late = [_trip(3, 4, -30), _trip(1, 2, 3)]
    told = []
    for trips, n_late in ((first, 0), (second + late, 2)):
        spark.createDataFrame(trips, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        assert closing.run_closing_edges(spark, src, out, str(tmp_path / "ck"), schema=spark.createDataFrame([], SCHEMA).schema,
                                         max_files_per_trigger=1) == n_late
        told.append(_rows(closing.read_closed(spark, out)))
    end = lambda r: r[0] + dt.timedelta(days=7)
    day = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    assert told[0] == [r for r in _batch(spark, first) if end(r) <= day(58 - 14)]
    assert told[1] == [r for r in _batch(spark, first + second) if end(r) <= day(120 - 14)]
    assert len({r[:3] for r in told[1]}) == len(told[1])
