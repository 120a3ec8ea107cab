"""Small hand-made inputs for unit tests (FIXTURES §3, §5).

These are test fixtures only; no registered query runs on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from odgraph.params import TRIP_SCHEMA

TOY_EDGES = [(1, 2), (2, 1), (2, 3), (3, 1), (4, 1), (4, 5), (5, 6), (6, 4), (1, 7), (8, 9), (9, 8), (9, 10)]

# expected PageRank (reset 0.15) after 1, 2 and 20 rounds, ranks sum to 10
TOY_PAGERANK = {
    1: {1: 2.228915663, 2: 0.692771084, 3: 0.692771084, 4: 1.204819277, 5: 0.692771084,
        6: 1.204819277, 7: 0.692771084, 8: 0.692771084, 9: 1.204819277, 10: 0.692771084},
    2: {1: 1.726327945, 2: 1.235565820, 3: 0.520455295, 4: 1.319696470, 5: 0.758825470,
        6: 0.842956120, 7: 1.235565820, 8: 0.758825470, 9: 0.842956120, 10: 0.758825470},
    20: {1: 1.911972261, 2: 1.114599274, 3: 0.775809966, 4: 1.121029838, 5: 0.778200873,
         6: 0.963233935, 7: 1.114599274, 8: 0.673260136, 9: 0.874034308, 10: 0.673260136},
}

# expected labels (smallest label wins ties) after 1, 2, 3 and 10 rounds, ids 1..10
TOY_LABELS = {
    1: [2, 1, 1, 1, 4, 4, 1, 9, 8, 9],
    2: [1, 2, 1, 4, 1, 1, 2, 8, 9, 8],
    3: [2, 1, 1, 1, 1, 1, 1, 9, 8, 9],
    10: [1, 2, 1, 1, 1, 1, 2, 8, 9, 8],
}

DIRTY_TRIPS = [
    (1, 2, 1.0, 10.0, 2.0),
    (1, 2, 3.0, 20.0, None),
    (1, 2, None, 30.0, 1.0),
    (2, 1, 2.0, 5.0, 0.0),
    (2, 3, 4.0, 8.0, 1.5),
    (3, 1, 5.0, 0.0, 0.0),
    (263, 1, 9.0, 50.0, 5.0),
    (1, 263, 9.5, 55.0, None),
    (None, 1, 1.0, 9.0, 1.0),
    (1, None, 1.0, 9.0, 1.0),
    (0, 1, 1.0, 9.0, 1.0),
    (1, 264, 1.0, 9.0, 1.0),
    (4, 4, 1.0, 9.0, 1.0),
    (1, 3, 1.0, -0.01, 1.0),
    (1, 3, 1.0, None, 1.0),
]

DIRTY_EDGES = [
    (1, 2, 3, 60.0, 20.0, 3.0, 2.0),
    (1, 263, 1, 55.0, 55.0, None, 9.5),
    (2, 1, 1, 5.0, 5.0, 0.0, 2.0),
    (2, 3, 1, 8.0, 8.0, 1.5, 4.0),
    (3, 1, 1, 0.0, 0.0, 0.0, 5.0),
    (263, 1, 1, 50.0, 50.0, 5.0, 9.0),
]

METRIC_SCHEMA = T.StructType(
    [
        T.StructField("mode", T.StringType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("test", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("time_seconds", T.DoubleType()),
        T.StructField("memory_delta_gb", T.DoubleType()),
    ]
)

METRICS = [
    ("single", 1, "data_loading", "SUCCESS", 10.0, 0.5),
    ("single", 2, "graph_construction", "SUCCESS", 60.0, 1.5),
    ("single", 3, "graph_construction", "SUCCESS", 90.0, 1.7),
    ("single", 4, "pagerank_simulation", "FAILED", 30.0, None),
    ("cluster", 1, "data_loading", "SUCCESS", 5.0, 0.4),
    ("cluster", 2, "graph_construction", "SUCCESS", 40.0, 1.0),
    ("cluster", 3, "pagerank_simulation", "SUCCESS", 20.0, 0.8),
]


def toy_edge_list(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(s, d, 1) for s, d in TOY_EDGES], "src int, dst int, trip_count bigint"
    )


def dirty_trips(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DIRTY_TRIPS, TRIP_SCHEMA)


def empty_trips(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], TRIP_SCHEMA)


def metrics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(METRICS, METRIC_SCHEMA)
