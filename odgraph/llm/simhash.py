"""SimHash near-duplicates found with covering locality-sensitive hashing.

Fingerprint: lower-case A-Z, split at white space, hash every run of
``shingle`` words (XXH64, seed 42); a bit is set when more than half of the
shingles set it.

Search: give each of the 64 bit positions a vector of ``radius + 1`` bits.
For every non-zero vector ``v`` the mask of positions whose vector has an odd
product with ``v`` is one hash table, ``2^(radius+1) - 1`` tables in all.  At
most ``radius`` differing positions span a subspace of dimension ``radius``,
so some ``v`` is orthogonal to all of them: under that mask the two
fingerprints agree.  No pair within the radius is missed.

Copies collapse to one row per fingerprint before the search.  Buckets stream
through tasks in sorted order; a bucket beyond ``BUCKET`` fingerprints is
masked again with other vectors on top of the bits it already shares (the
same guarantee holds inside it), until it is small.  A bucket emits its
components as stars, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odgraph.llm.common import cut, slices, utf8
from odgraph.llm.components import connected_components

BITS = 64
BUCKET = 2048
BLOCK = 1 << 15
DEPTH = 8


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint of a UTF-8 text; 0 without words."""
    import xxhash

    words = text.lower().split() if text else []
    if not words:
        return 0
    width = min(shingle, len(words))
    total = len(words) - width + 1
    ones = np.zeros(BITS, dtype=np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for start in range(0, total, BLOCK):
        part = words[start:min(start + BLOCK, total) + width - 1]
        runs = map(join, zip(*(part[j:] for j in range(width))))
        hashes = np.array([digest(x, 42) for x in runs], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """``(id, fp)`` for every row; ``fp`` is the fingerprint as a signed long."""
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(batches):
        for batch in batches:
            for part in slices(batch, 1):
                values = [fingerprint(x, shingle) for x in utf8(part.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.array(values, dtype="u8").view("i8"))], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")
                       ).mapInArrow(rows, f"id {kind}, fp long")


def masks(radius: int, seed: int = 0) -> list[int]:
    """The covering masks as signed longs."""
    vectors = np.random.default_rng(1000 + seed).integers(1, 1 << (radius + 1), BITS)
    out = []
    for v in range(1, 1 << (radius + 1)):
        mask = sum(1 << i for i in range(BITS) if bin(int(vectors[i]) & v).count("1") % 2)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def _forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Components of distinct fingerprints, each as a star around its first."""
    n = len(values)
    unsigned = values.view(np.uint64)
    left = np.ones(n, dtype=bool)
    edges = []
    while left.any():
        first = int(np.flatnonzero(left)[0])
        queue = [first]
        left[first] = False
        while queue:
            i = queue.pop()
            near = np.flatnonzero(left & (np.bitwise_count(unsigned ^ unsigned[i]) <= radius))
            left[near] = False
            queue += near.tolist()
            edges += [(int(values[first]), int(values[j])) for j in near]
    return edges


def _links(groups: DataFrame, radius: int, limit: int, last: bool) -> DataFrame:
    """Stream sorted buckets: ``a, b`` is a link; ``bucket`` set marks a row
    of an oversized bucket, to be masked again."""
    schema = pa.schema([("bucket", pa.string()), ("a", pa.int64()), ("b", pa.int64())])

    def rows(batches):
        held: list[np.ndarray] = []
        key = None
        size = 0
        over = False

        def close():
            if over or size < 2:
                return None
            edges = _forest(np.concatenate(held), radius)
            return pa.RecordBatch.from_arrays(
                [pa.nulls(len(edges), pa.string()), pa.array([e[0] for e in edges], pa.int64()),
                 pa.array([e[1] for e in edges], pa.int64())], schema=schema) if edges else None

        def spill(name, values):
            return pa.RecordBatch.from_arrays(
                [pa.array([name] * len(values)), pa.array(values), pa.nulls(len(values), pa.int64())],
                schema=schema)

        for batch in batches:
            names = batch.column(0)
            values = batch.column(1).to_numpy(zero_copy_only=False)
            codes = names.dictionary_encode()
            index = codes.indices.to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.r_[True, index[1:] != index[:-1]]) if len(index) else []
            ends = np.r_[starts[1:], len(index)] if len(index) else []
            words = codes.dictionary.to_pylist()
            for s, e in zip(starts, ends):
                name = words[index[s]]
                if name != key:
                    done = close()
                    if done is not None:
                        yield done
                    key, held, size, over = name, [], 0, False
                chunk = values[s:e]
                size += len(chunk)
                if not last and size > limit:
                    if not over:
                        for x in held:
                            yield spill(key, x)
                        held, over = [], True
                    yield spill(key, chunk)
                else:
                    held.append(chunk)
        done = close()
        if done is not None:
            yield done

    return (groups.repartition("bucket").sortWithinPartitions("bucket", "fp")
            .select("bucket", "fp").mapInArrow(rows, "bucket string, a long, b long"))


def near_links(fps: DataFrame, radius: int = 3, limit: int = BUCKET) -> DataFrame:
    """``(src, dst)`` edges between distinct fingerprints (column ``fp``) whose
    components are those of all pairs differing in ``radius`` bits or fewer."""
    found = None
    rest = fps.select("fp", F.lit("").alias("bucket"))
    for level in range(DEPTH):
        tables = F.array(*[
            F.concat_ws(".", F.col("bucket"), F.lit(f"{t:x}"), F.hex(F.col("fp").bitwiseAND(F.lit(m))))
            for t, m in enumerate(masks(radius, level))])
        groups = rest.select("fp", F.explode(tables).alias("bucket"))
        links = cut(_links(groups, radius, limit, level == DEPTH - 1), "simhash-links")
        edges = links.where("bucket is null").select(F.col("a").alias("src"), F.col("b").alias("dst"))
        found = edges if found is None else found.unionAll(edges)
        rest = links.where("bucket is not null").select(F.col("a").alias("fp"), "bucket")
        if rest.isEmpty():
            break
    return found


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = 3, radius: int = 3) -> DataFrame:
    """Return ``(id_col, fp, component_id)`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable through links of at most
    ``radius`` differing bits.  Null and empty texts have fingerprint 0 and
    link with each other; rows with a null id take part and never name a
    component; repeated rows are returned as often as they occur; an empty
    table gives an empty result.  Other columns of ``docs`` are not read.
    """
    each = cut(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    classes = each.groupBy("fp").agg(F.min("id").alias("first_id"))
    parts = connected_components(near_links(classes.select("fp"), radius))
    whole = classes.join(parts.select(F.col("node").alias("fp"), "component"), "fp", "left")
    whole = whole.select("fp", "first_id", F.coalesce("component", "fp").alias("component"))
    least = whole.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = whole.join(least, "component").select("fp", "component_id")
    return each.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the
    smallest id, and of several texts of that id the one with the least hash.

    Of rows that repeat an id and its text the first by all other columns
    counts; a row with a null id stays only where its group has no id; null and
    empty texts are one group; an empty table stays empty.
    """
    key = F.xxhash64(F.col(text_col).cast("string"))
    order = F.struct(*[F.col(f"`{f.name}`") for f in docs.schema.fields if f.dataType.typeName() not in ("map", "variant")])
    # one row of those that repeat an id and its text, folded in every task first
    ones = docs.groupBy(F.col(id_col).alias("_id"), key.alias("_key")).agg(
        F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), order).alias("_row"))
    ones = cut(ones, "simhash-ones")
    texts = ones.select(F.struct("_id", "_key").alias("_name"), F.col(f"_row.`{text_col}`").alias("_text"))
    groups = simhash_groups(texts, "_name", "_text", shingle, radius)
    # the first row of each group: ids before a null id, then the smaller id, then the text's hash
    rank = F.struct(F.col("_name._id").isNull(), "_name._id", "_name._key")
    first = groups.groupBy("component_id").agg(F.min_by("_name", rank).alias("_first")).select("_first._id", "_first._key")
    return ones.join(first.withColumnsRenamed({"_id": "_first_id", "_key": "_first_key"}),
                     F.col("_id").eqNullSafe(F.col("_first_id")) & F.col("_key").eqNullSafe(F.col("_first_key")),
                     "left_semi").select("_row.*")
