"""The corpus pipeline: five stages over ``documents``, each on all rows that
the stage before it kept.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, which is written as Parquet and read again
as the next one's ``docs``.  All but the last return the columns of
``documents``; the last returns the training sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from odgraph.llm import curriculum, decontaminate, langid, linededup, simhash
from odgraph.llm.common import cut, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is clear; learns from labelled rows."""
    return langid.keep_identified(docs, langid.train(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops recurring lines; documents that have no other line go."""
    return linededup.without_boilerplate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash group."""
    return simhash.simhash_dedup(docs, shingle=3, radius=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages; documents that are mostly benchmark go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequence: one row for each pass over a document."""
    return curriculum.mix(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", benchmark_decontamination),
    ("mixing", mixing),
]

#: SimHash needs XXH64 and language ID suffix automata, which SQL lacks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
