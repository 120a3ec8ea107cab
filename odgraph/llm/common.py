"""Helpers shared by the corpus operators: tables cut in the shared folder,
Arrow column access and batch slicing."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odgraph.session import scratch_path

#: Native regular expression of a white-space separated word.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back.

    Lineage ends at the written table, so a lost executor never repeats what
    came before it.  The folder is the one in ``spark.checkpoint.dir``;
    :func:`odgraph.session.drop_scratch` deletes an application's tables when
    results are saved.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def valid_text(column: Column) -> Column:
    """A column as a string whose bytes that are not UTF-8 are U+FFFD."""
    return F.make_valid_utf8(column.cast("string"))


def utf8(column: pa.Array) -> list:
    """A string column as ``bytes`` objects (null: ``None``)."""
    return column.cast(pa.large_binary()).to_pylist()


def slices(batch: pa.RecordBatch, text: int, max_bytes: int = 8 << 20):
    """Cut a batch into runs of rows of about ``max_bytes`` of text; a longer
    single text is a run of its own."""
    lengths = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
    start = total = 0
    for i, n in enumerate(lengths):
        if total and total + n > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)
