"""Near-duplicate vectors: learned binary codes, Hamming tables, exact rerank.

Iterative quantisation learns, on a bounded sample, a rotation after which the
signs of the coordinates are balanced and close to the vectors.  The bits of
several such rotations are cut into substrings; every substring is one hash
table over all vectors, and vectors that share a bucket of any table are
compared by cosine in double precision with their original components.

The substring length grows with the logarithm of the number of vectors
(about ``OCCUPANCY`` vectors a bucket), the number of tables with the length,
so that a pair at the threshold is retrieved with probability ``RECALL``; a
sign differs with probability angle / pi.

Equal vectors are one class.  A bucket beyond ``BUCKET`` classes is dealt into
blocks, and each pair of blocks is a group of its own: no group is larger
than two blocks and no pair is missed.  Groups emit link counts and a
spanning forest, never pairs; a pair that meets in several tables is counted
in the first.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odgraph.llm.common import cut
from odgraph.llm.components import connected_components

THRESHOLD = 0.9
RECALL = 0.995
OCCUPANCY = 256
BUCKET = 1024
SAMPLE = 4096
ROUNDS = 30
#: Oversized buckets that are broadcast; more are joined by a shuffle.
HOT = 100_000


def learn_rotation(sample: np.ndarray, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """Iterative quantisation of centred rows: principal axes, then a rotation
    that alternates between signs and the orthogonal matrix nearest to them."""
    d = sample.shape[1]
    random = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0]
    if len(sample) < d:
        return random
    axes = np.linalg.svd(sample, full_matrices=False)[2].T
    projected = sample @ axes
    rotation = random
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.where(projected @ rotation >= 0, 1.0, -1.0).T @ projected)
        rotation = (u @ v).T
    return axes @ rotation


def plan(n: int, threshold: float = THRESHOLD, recall: float = RECALL,
         occupancy: int = OCCUPANCY) -> tuple[int, int]:
    """Bits of a substring and number of tables for ``n`` vectors."""
    bits = max(0, math.ceil(math.log2(max(n, 1) / occupancy)))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, 1 if bits == 0 else math.ceil(math.log(1 - recall) / math.log(1 - agree))


def _unit(rows: list, dtype: str) -> np.ndarray:
    """Vectors of length 1 in double precision, scaled first so that squares neither vanish nor overflow."""
    x = np.stack([np.frombuffer(r, dtype=dtype) for r in rows]).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Index:
    """Rotations by dimension; gives the substrings of vectors."""

    def __init__(self, sample: list[np.ndarray], bits: int, tables: int):
        self.bits, self.tables = bits, tables
        self.learned: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for d in sorted({len(v) for v in sample}):
            self.learned[d] = self._fit(np.stack([v for v in sample if len(v) == d]))

    def _fit(self, x: np.ndarray):
        d = x.shape[1]
        mean = x.mean(axis=0) if len(x) >= d else np.zeros(d)
        number = math.ceil(self.bits * self.tables / d)
        return mean, np.concatenate([learn_rotation(x - mean, seed) for seed in range(number)] or
                                    [np.zeros((d, 0))], axis=1)[:, :self.bits * self.tables]

    def keys(self, x: np.ndarray) -> np.ndarray:
        """``tables`` substrings of each unit vector."""
        d = x.shape[1]
        if d not in self.learned:  # a dimension that the sample lacks
            self.learned[d] = self._fit(np.zeros((0, d)))
        mean, rotation = self.learned[d]
        signs = ((x - mean) @ rotation >= 0).reshape(len(x), self.tables, self.bits)
        return signs @ (1 << np.arange(self.bits, dtype=np.int64))


def _vectors(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, str]:
    """``(id, vec, node)``; ``node`` names the vector's class and is null for a
    vector that links with nothing."""
    wide = df.schema[vec_col].dataType.elementType.simpleString() == "double"
    vec = F.col(vec_col).cast("array<double>" if wide else "array<float>")
    usable = (F.size("vec") > 0) & F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists(
        "vec", lambda x: x != 0)
    node = F.concat(F.hex(F.xxhash64("vec")), F.lit("-"), F.hex(F.xxhash64(F.lit(1), F.col("vec"))))
    rows = df.select(F.col(id_col).alias("id"), vec.alias("vec"))
    return rows.withColumn("node", F.when(usable, node)), "<f8" if wide else "<f4"


def _coded(classes: DataFrame, held, dtype: str) -> DataFrame:
    """``(node, weight, vec binary, keys)`` of every class."""

    def code(batches):
        for batch in batches:
            raw = [np.asarray(v, dtype=dtype).tobytes() for v in batch.column(1).to_pylist()]
            keys: list = [None] * len(raw)
            for size in sorted(set(map(len, raw))):
                mine = [i for i, r in enumerate(raw) if len(r) == size]
                for i, k in zip(mine, held.value.keys(_unit([raw[i] for i in mine], dtype))):
                    keys[i] = k
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(raw, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], ["node", "weight", "vec", "keys"])

    return classes.select("node", "vec", "weight").mapInArrow(
        code, "node string, weight long, vec binary, keys array<long>")


def _compare(rows, dtype: str, threshold: float):
    """Link counts and forest edges of one group: rows of
    ``(table, node, weight, vec, keys, block, low, high)``."""
    table, _, _, _, _, _, low, high = rows[0]
    nodes = [r[1] for r in rows]
    weight = np.array([r[2] for r in rows])
    unit = _unit([r[3] for r in rows], dtype)
    keys = np.array([r[4] for r in rows])
    block = np.array([r[5] for r in rows])
    left = np.flatnonzero(block == low)
    right = np.flatnonzero(block == high)
    a, b = np.nonzero(unit[left] @ unit[right].T >= threshold)
    a, b = left[a], right[b]
    if low == high:
        a, b = a[a < b], b[a < b]
    if not len(a):
        return [], []
    first = (keys[a] == keys[b]).argmax(axis=1) == table
    links = (np.bincount(a[first], weight[b[first]], len(rows)) + np.bincount(b[first], weight[a[first]], len(rows)))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    joined = len(set(a.tolist()) | set(b.tolist()))
    for x, y in zip(a.tolist(), b.tolist()):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            edges.append((nodes[x], nodes[y]))
            if len(edges) == joined - 1:
                break
    return [(nodes[i], int(links[i])) for i in np.flatnonzero(links)], edges


def _grouped(rows: DataFrame, dtype: str, threshold: float) -> DataFrame:
    """``(a, n, b)``: a node's links found in a group, or (``b`` set) an edge."""
    columns = ["table", "node", "weight", "vec", "keys", "block", "low", "high"]

    def compare(batches):
        now, held = None, []

        def done():
            links, edges = _compare(held, dtype, threshold) if len(held) > 1 else ([], [])
            if links or edges:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in links] + [x[0] for x in edges], pa.string()),
                     pa.array([x[1] for x in links] + [None] * len(edges), pa.int64()),
                     pa.array([None] * len(links) + [x[1] for x in edges], pa.string())], ["a", "n", "b"])

        for batch in batches:
            for name, *row in zip(*(batch.column(i).to_pylist() for i in range(9))):
                if name != now:
                    yield from done()
                    now, held = name, []
                held.append(row)
        yield from done()

    group = F.concat_ws(".", "bucket", "low", "high").alias("group")
    return (rows.select(group, *columns).repartition("group").sortWithinPartitions("group")
            .mapInArrow(compare, "a string, n long, b string"))


def embedding_groups(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                     threshold: float = THRESHOLD, recall: float = RECALL, occupancy: int = OCCUPANCY,
                     bucket: int = BUCKET, sample: int = SAMPLE) -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` for every row.

    ``n_links`` counts the other rows with cosine of at least ``threshold``,
    ``component_id`` is the smallest id reachable by links, ``kept`` whether
    it is the row's own.  Null and zero vectors and vectors with null or
    non-finite components link with nothing, vectors of different dimensions
    never link, rows that repeat an id are vectors of their own, a null id
    names no component but its own; columns of other names are not read.
    """
    rows, dtype = _vectors(df, id_col, vec_col)
    classes = rows.where("node is not null").groupBy("node", "vec").agg(
        F.count("*").alias("weight"), F.min("id").alias("first_id"))
    classes = cut(classes, "embedding-classes")
    bits, tables = plan(classes.count(), threshold, recall, occupancy)
    near = [np.asarray(r["vec"], dtype=np.float64) for r in
            classes.select("node", "vec").orderBy("node").limit(sample).collect()]
    near = [v / np.abs(v).max() for v in near]
    index = df.sparkSession.sparkContext.broadcast(Index([v / np.linalg.norm(v) for v in near], bits, tables))
    coded = cut(_coded(classes, index, dtype), "embedding-codes")
    each = coded.select("*", F.posexplode("keys").alias("table", "key")).withColumn(
        "bucket", F.concat_ws(".", F.octet_length("vec"), "table", "key"))
    sizes = each.groupBy("bucket").agg(F.count("*").alias("size")).where(F.col("size") > bucket)
    hot = sizes.select(F.col("bucket").alias("hot_bucket"), F.ceil(F.col("size") / bucket).alias("blocks"))
    hot = cut(hot, "embedding-hot")
    hot = F.broadcast(hot) if hot.count() <= HOT else hot
    blocks = F.coalesce("blocks", F.lit(1))
    dealt = each.join(hot, F.col("bucket") == F.col("hot_bucket"), "left").withColumn(
        "block", F.pmod(F.xxhash64("node", F.lit(7)), blocks)).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    dealt = dealt.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    found = cut(_grouped(dealt, dtype, threshold), "embedding-links")
    links = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    parts = connected_components(found.where("b is not null").select(F.col("a").alias("src"), F.col("b").alias("dst")))
    whole = (classes.select("node", "weight", "first_id")
             .join(links.withColumnRenamed("a", "node"), "node", "left").join(parts, "node", "left")
             .withColumn("component", F.coalesce("component", "node"))
             .withColumn("n_links", F.coalesce("n", F.lit(0)) + F.col("weight") - 1))
    least = whole.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = whole.join(least, "component").select("node", "n_links", "component_id")
    out = rows.select("id", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
