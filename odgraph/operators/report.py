"""The report tables behind the reference's charts.

The reference draws PNGs from pandas copies of the results; here every
plotted series is a DataFrame, computed in Spark over the whole result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odgraph.plans.prefix import ranked_prefix


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width histogram over [min, max], last bin closed on the right.

    ``bin = least(floor((x - min) / width), bins - 1)``; empty bins appear
    with count 0 (left join from the ``bins``-row range); a constant column
    puts everything into bin 0.
    """
    spark = df.sparkSession
    stats = df.agg(F.min(column).alias("mn"), F.max(column).alias("mx"))
    mn = stats.select(F.col("mn").cast("double")).scalar()
    mx = stats.select(F.col("mx").cast("double")).scalar()
    width = (mx - mn) / F.lit(float(bins))
    x = F.col(column).cast("double")
    b = F.least(
        F.coalesce(F.floor(F.try_divide(x - mn, width)), F.lit(0)).cast("int"), F.lit(bins - 1)
    )
    counts = df.filter(F.col(column).isNotNull()).groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("count")
    )
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        grid.join(F.broadcast(counts), "bin", "left")
        .select(
            "bin",
            (mn + F.col("bin") * width).alias("bin_start"),
            (mn + (F.col("bin") + 1) * width).alias("bin_end"),
            F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
        )
    )


def cumulative_share(ranks: DataFrame) -> DataFrame:
    """Position in descending rank order and cumulative % of Σ rank."""
    total = ranks.agg(F.sum("pagerank")).scalar()
    pref = ranked_prefix(ranks.select("zone_id", "pagerank"), "pagerank", "zone_id")
    return pref.select(
        "pos", "zone_id", "pagerank",
        (F.try_divide(F.col("cum"), total) * 100).alias("cum_pct"),
    )


def rank_loglog(ranks: DataFrame) -> DataFrame:
    """(position, rank) pairs and their base-10 logs for the power-law plot."""
    pref = ranked_prefix(ranks.select("zone_id", "pagerank"), "pagerank", "zone_id")
    return pref.select(
        "pos", "zone_id", "pagerank",
        F.log10(F.col("pos").cast("double")).alias("log_pos"),
        F.log10(F.col("pagerank")).alias("log_pagerank"),
    )


def concentration_crossing(ranks: DataFrame, levels=(50.0, 80.0)) -> DataFrame:
    """First position at which the cumulative share reaches each level."""
    cs = cumulative_share(ranks)
    return cs.agg(
        *[F.min(F.when(F.col("cum_pct") >= lv, F.col("pos"))).alias(f"pos_{int(lv)}pct") for lv in levels],
        F.count(F.lit(1)).alias("num_zones"),
    )


def summary_report(ranks: DataFrame, stats: DataFrame) -> DataFrame:
    """The eight summary metrics as ``(metric, value)`` rows."""
    r = ranks.agg(
        F.count(F.lit(1)).cast("double").alias("total_zones"),
        F.avg("pagerank").alias("avg_pr"),
        F.max("pagerank").alias("max_pr"),
        F.min("pagerank").alias("min_pr"),
    )
    c = stats.agg(
        F.count(F.lit(1)).cast("double").alias("total_comms"),
        F.avg("num_zones").alias("avg_size"),
        F.max("num_zones").cast("double").alias("max_size"),
        F.min("num_zones").cast("double").alias("min_size"),
    )
    wide = r.select(
        "*",
        c.select("total_comms").scalar().alias("total_comms"),
        c.select("avg_size").scalar().alias("avg_size"),
        c.select("max_size").scalar().alias("max_size"),
        c.select("min_size").scalar().alias("min_size"),
    )
    rows = [
        ("Total Zones", "total_zones"),
        ("Total Communities", "total_comms"),
        ("Avg PageRank", "avg_pr"),
        ("Max PageRank", "max_pr"),
        ("Min PageRank", "min_pr"),
        ("Avg Community Size", "avg_size"),
        ("Largest Community", "max_size"),
        ("Smallest Community", "min_size"),
    ]
    return wide.select(
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value")) for m, c in rows])
        ).alias("r")
    ).select("r.*")


def size_rank_scatter(stats: DataFrame) -> DataFrame:
    """The (size, Σ rank) pairs of the scatter plot."""
    return stats.select("community_id", "num_zones", "total_pagerank")


def size_rank_correlation(stats: DataFrame) -> DataFrame:
    """Pearson correlation of community size and Σ rank."""
    return stats.agg(
        F.corr(F.col("num_zones").cast("double"), F.col("total_pagerank")).alias("size_rank_corr"),
        F.count(F.lit(1)).alias("num_communities"),
    )


def write_reports(ranks: DataFrame, stats: DataFrame, out: str, k: int = 50) -> dict[str, str]:
    """``summary_statistics`` and ``top{k}_zones_detailed`` as CSV.

    Both outputs are bounded (8 rows; k rows), so each is one CSV file.
    """
    from odgraph.operators.rank import top_pagerank
    from odgraph.sources import io

    return {
        "summary": io.write_csv(summary_report(ranks, stats), f"{out}/summary_statistics"),
        "top": io.write_csv(top_pagerank(ranks, k).drop("label"), f"{out}/top{k}_zones_detailed"),
    }
