"""The table of a live edge list, one row a (window, src, dst).

A live stream emits the updated rows of its windows in every micro-batch.
:class:`LiveTable` keeps them in two folders:

* ``batches/batch_id=<n>``: the rows of a micro-batch, written with overwrite, so
  a batch that runs again replaces its own rows;
* ``base/mark=<n>``: all rows folded up to batch ``n``, the high-water mark.

The latest batch that names a key holds its row, so the current table is the
base with the highest mark and the batches beyond it, folded by key.  A batch at
or below the mark is part of the base already: running it again changes nothing.
:meth:`LiveTable.compact` writes the next base and leaves the old one in place
until the new one is whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = ("window_start", "src", "dst")
VALUE = ("window_end", "trip_count", "total_fare")


class LiveTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _names(self, pattern: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return [s.getPath().toString() for s in found or []]

    @property
    def mark(self) -> int:
        """The last batch that the base holds; -1 without a base."""
        done = self._names("base/mark=*/_SUCCESS")
        return max((int(p.split("mark=")[1].split("/")[0]) for p in done), default=-1)

    def upsert(self, rows: DataFrame, batch_id: int) -> None:
        """Take in a micro-batch's updated rows; safe to run again."""
        rows.select(*KEY, *VALUE).write.mode("overwrite").parquet(f"{self.path}/batches/batch_id={batch_id}")

    def batch(self, batch_id: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/batches/batch_id={batch_id}")

    def _folded(self) -> DataFrame | None:
        mark = self.mark
        parts = []
        if mark >= 0:
            parts.append(self.spark.read.parquet(f"{self.path}/base/mark={mark}"))
        if self._names("batches/batch_id=*/_SUCCESS"):
            rows = self.spark.read.parquet(f"{self.path}/batches").where(F.col("batch_id") > mark)
            parts.append(rows.select(*KEY, *VALUE, F.col("batch_id").cast("long").alias("as_of")))
        if not parts:
            return None
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        last = F.max_by(F.struct(*VALUE, "as_of"), F.col("as_of")).alias("r")
        return rows.groupBy(*KEY).agg(last).select(*KEY, "r.*")

    def read(self) -> DataFrame:
        """The current row of every (window, src, dst)."""
        rows = self._folded()
        if rows is None:
            schema = "window_start timestamp, window_end timestamp, src int, dst int, trip_count long, total_fare double"
            return self.spark.createDataFrame([], schema)
        return rows.select("window_start", "window_end", "src", "dst", "trip_count", "total_fare")

    def compact(self) -> int:
        """Fold the base and all batches beyond it into a new base; returns its mark.

        Run it between runs of the stream.  Without new batches nothing is written."""
        names = self._names("batches/batch_id=*/_SUCCESS")
        last = max((int(p.split("batch_id=")[1].split("/")[0]) for p in names), default=-1)
        if last > self.mark:
            self._folded().write.mode("overwrite").parquet(f"{self.path}/base/mark={last}")
        return self.mark

    def drop_folded(self) -> None:
        """Delete the batches and bases that the newest base has replaced."""
        mark = self.mark
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path
        for name, at in [(n, int(n.rsplit("=", 1)[1])) for n in self._names("base/mark=*")]:
            if at < mark:
                fs_path(name).getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(fs_path(name), True)
        for name, at in [(n, int(n.rsplit("=", 1)[1])) for n in self._names("batches/batch_id=*")]:
            if at <= mark:
                fs_path(name).getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(fs_path(name), True)
