"""K-means clustering of zones on their graph features.

Features per zone: PageRank, in/out degree, in/out strength, hub and authority
score, standardised (sample deviation; a constant feature counts as 0).

The first centres are zones: the one farthest from the mean, then again and
again the one farthest from the centres so far (ties → smaller id), so a run
needs no random numbers.  Lloyd's rounds go on until no zone changes its
cluster, which they reach by themselves, for every change lowers the sum of
squares.  A label is a function of the zone and the k centres, so a round is
one aggregate that ships k rows a task; only centres pass through the driver.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odgraph.plans.iterate import reliable_checkpoint

FEATURES = ("pagerank", "out_degree", "in_degree", "out_strength", "in_strength", "hub", "authority")


def zone_features(ranks: DataFrame, degrees: DataFrame, hits: DataFrame) -> DataFrame:
    return (
        ranks.join(degrees, "zone_id", "left")
        .join(hits, "zone_id", "left")
        .select("zone_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES])
    )


def _standardised(features: DataFrame) -> DataFrame:
    """``zone_id`` and the array ``x`` of standardised features."""
    row = features.agg(*[f(c).alias(f"{n}_{c}") for c in FEATURES for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    scaled = [(F.col(c) - row[f"m_{c}"]) / row[f"s_{c}"] if row[f"s_{c}"] else F.lit(0.0) for c in FEATURES]
    return features.select("zone_id", F.array(*scaled).alias("x"))


def _distance(centre) -> Column:
    """Squared distance of ``x`` from a centre, summed in the order of the features."""
    total = F.lit(0.0)
    for i, c in enumerate(centre):
        total = total + (F.col("x")[i] - F.lit(float(c))) * (F.col("x")[i] - F.lit(float(c)))
    return total


def _nearest(centres: dict[int, list[float]]) -> Column:
    """The nearest centre's number (ties → smaller)."""
    return F.array_min(F.array(*[F.struct(_distance(c).alias("d"), F.lit(k).alias("k")) for k, c in sorted(centres.items())]))["k"]


def first_centres(points: DataFrame, k: int) -> dict[int, list[float]]:
    """Farthest-first centres; fewer than ``k`` where all points are centres."""
    centres: dict[int, list[float]] = {}
    for i in range(k):
        away = F.array_min(F.array(*[_distance(c) for c in centres.values()])) if centres else _distance([0.0] * len(FEATURES))
        far = points.agg(F.max_by(F.struct(away.alias("d"), "x"), F.struct(away, -F.col("zone_id"))).alias("far")).first()["far"]
        if far is None or centres and far["d"] == 0:
            break
        centres[i] = far["x"]
    return centres


def zone_kmeans(features: DataFrame, k: int = 5, max_rounds: int | None = None) -> DataFrame:
    """``zone_id, cluster``, the features and ``converged`` (false only where the
    caller's ``max_rounds`` cut the rounds); a cluster that loses all its zones is gone."""
    points = reliable_checkpoint(_standardised(features))
    centres, old, converged = first_centres(points, k), None, False
    if not centres:
        return features.select("zone_id", F.lit(0).alias("cluster"), *FEATURES).withColumn("converged", F.lit(True))
    for _ in itertools.count() if max_rounds is None else range(max_rounds):
        label = _nearest(centres)
        changed = F.lit(1) if old is None else (label != _nearest(old)).cast("int")
        means = F.array(*[F.avg(F.col("x")[i]) for i in range(len(FEATURES))])
        rows = points.groupBy(label.alias("k")).agg(means.alias("mean"), F.sum(changed).alias("changed"))
        found = rows.agg(F.collect_list(F.struct("k", "mean", "changed")).alias("rows")).first()["rows"]
        if sum(r["changed"] for r in found) == 0:
            converged = True
            break
        old, centres = centres, {r["k"]: r["mean"] for r in found}
    labels = points.select("zone_id", _nearest(centres).alias("cluster"))
    return features.join(labels, "zone_id").select("zone_id", "cluster", *FEATURES).withColumn("converged", F.lit(converged))


def cluster_profile(clusters: DataFrame) -> DataFrame:
    """Size and mean features per k-means cluster."""
    return clusters.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("num_zones"), *[F.avg(c).alias(f"avg_{c}") for c in FEATURES]
    )
