"""Global running position / running sum in descending score order.

A window without ``partitionBy`` runs in one task, so the order is computed
in parallel at every size:

1. ``repartitionByRange`` on (score desc, key) — partition ``i`` holds a
   contiguous slice of the global order;
2. per-partition row counts and score sums (one row per partition) are
   turned into offsets by a window over those few rows;
3. a window partitioned by the slice id gives local positions and sums,
   and the broadcast offsets (one row per partition, bounded by the
   partition count) make them global.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odgraph.plans.iterate import reliable_checkpoint


def ranked_prefix(df: DataFrame, score: str, key: str, places: int = 6,
                  partitions: int | None = None) -> DataFrame:
    """Add ``pos`` (1-based) and ``cum`` (running Σ score) in (round(score) desc, key) order."""
    r = F.round(F.col(score), places)
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sliced = reliable_checkpoint(
        df.withColumn("_r", r)
        .repartitionByRange(parts, F.col("_r").desc(), F.col(key).asc())
        .withColumn("_pid", F.spark_partition_id())
    )
    per = sliced.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.sum(score).alias("_s"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(
        "_pid",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_s").over(before), F.lit(0.0)).alias("_s0"),
    )
    lw = Window.partitionBy("_pid").orderBy(F.col("_r").desc(), F.col(key).asc())
    local = sliced.select(
        "*",
        F.row_number().over(lw).alias("_lpos"),
        F.sum(score).over(lw.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_lcum"),
    )
    out = local.join(F.broadcast(offsets), "_pid")
    cols = [c for c in df.columns]
    return out.select(
        *cols,
        (F.col("_lpos") + F.col("_n0")).alias("pos"),
        (F.col("_lcum") + F.col("_s0")).alias("cum"),
    )
