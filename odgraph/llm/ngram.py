"""Interpolated modified Kneser-Ney bigram model of a corpus.

Counting, in Spark: words are counted by hash, then bigrams by a pair of word
ids.  Tasks emit sorted, pre-aggregated blocks for each shard; a shard is
merged by one task and stored as sorted arrays in the shared folder.  Workers
memory-map the arrays and look up sorted batches of keys, so the model is
never loaded into memory, broadcast or sent to the driver; the driver sees
one row of totals a shard.

A bigram's shard is chosen by its first word; a first word seen more than
``SPLIT`` times is spread over sub-shards by its second word, so no shard
depends on one frequent word.

The model (``u`` the word before ``w``, ``D`` the discount of a count):

    P(w | u) = (c(uw) - D(c(uw))) / c(u) + gamma(u) * Pc(w)
    gamma(u) = (D1 N1(u.) + D2 N2(u.) + D3 N3+(u.)) / c(u)
    Pc(w)    = (N1+(.w) - D'(N1+(.w))) / N1+(..) + gamma' / (V + 1)

with the last place of V + 1 for all unknown words.  After an unknown word
P(w | u) = Pc(w).  Every text begins after a start mark and ends with an end
token.  Discounts come from counts of counts (Chen and Goodman).

The shared folder must be mounted on the workers (a ``file:`` path), since
memory-mapping needs one; another scheme raises an error.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odgraph.llm.common import cut, utf8
from odgraph.session import scratch_path

SPLIT = 1 << 20
PIECE = 4 << 20
HELD = 1 << 21
IDS = 1 << 18
_SPACE = re.compile(rb"[ \t-\r]")
_LOW = np.uint64(0xFFFFFFFF)
_WORD_BITS = np.uint64(32)


def _pieces(texts: list[bytes | None]):
    """(document, piece, ends): texts cut at white space after ``PIECE`` bytes."""
    for i, text in enumerate(texts):
        text = text or b""
        at = 0
        while len(text) - at > PIECE:
            space = _SPACE.search(text, at + PIECE)
            if space is None:
                break
            yield i, text[at:space.start()], False
            at = space.start()
        yield i, text[at:] if at else text, True


@dataclass
class Tokens:
    """Tokens of a run of pieces: ``codes`` index ``hashes``; ``starts`` and
    ``docs`` give where each piece begins and which document it is of."""

    codes: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    docs: np.ndarray
    ends: np.ndarray


def _tokens(batch_texts: list[bytes | None]):
    import xxhash

    digest = xxhash.xxh64_intdigest

    def made(words, starts, docs, ends):
        unique = list(set(words))
        place = dict(zip(unique, range(len(unique))))
        codes = np.fromiter(map(place.__getitem__, words), dtype=np.int64, count=len(words))
        hashes = np.fromiter(map(digest, unique), dtype=np.uint64, count=len(unique))
        return Tokens(codes, hashes, np.array(starts), np.array(docs), np.array(ends))

    words: list[bytes] = []
    starts, docs, ends = [], [], []
    size = 0
    for doc, piece, last in _pieces(batch_texts):
        mine = piece.lower().split()
        if not mine and not last:
            continue
        starts.append(len(words))
        docs.append(doc)
        ends.append(last)
        words += mine
        if last:
            words.append(b"")  # the end token
        size += len(piece)
        if size > PIECE:
            yield made(words, starts, docs, ends)
            words, starts, docs, ends, size = [], [], [], [], 0
    if words:
        yield made(words, starts, docs, ends)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts[order].astype(np.int64), first)


def _small(values: np.ndarray) -> bytes:
    """Unsigned values in the narrowest type that holds them, its width first."""
    top = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _large(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{data[0]}", offset=1)


def _packed(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Sorted keys as steps of their high half, low half and counts."""
    high, low = keys >> _WORD_BITS, keys & _LOW
    return _small(np.diff(high, prepend=np.uint64(0))), _small(low), _small(counts)


def _unpacked(high: bytes, low: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    keys = (np.cumsum(_large(high).astype(np.uint64), dtype=np.uint64) << _WORD_BITS) | _large(low).astype(np.uint64)
    return keys, _large(counts).astype(np.int64)


def _shard_of_hash(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def _shard_of_pair(first: np.ndarray, second: np.ndarray, seen: np.ndarray, bits: int, split: int) -> np.ndarray:
    """Shard of a bigram; ``seen`` is how often its first word occurs."""
    parts = (seen // split + 1).astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (first + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + (second % parts) * np.uint64(0xC2B2AE3D27D4EB4F)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return _shard_of_hash(x, bits)


class Sorted:
    """A stored shard: sorted keys, one byte of each count, and apart the
    counts of 255 and more."""

    def __init__(self, path: str):
        if not os.path.exists(path):
            self.keys = np.empty(0, np.uint64)
            self.bytes = np.empty(0, np.uint8)
            self.more_at = self.more = np.empty(0, np.int64)
            return
        n, m = np.fromfile(path, dtype="<i8", count=2)
        self.keys = np.memmap(path, dtype="<u8", mode="r", offset=16, shape=(n,)) if n else np.empty(0, np.uint64)
        self.bytes = np.memmap(path, dtype="u1", mode="r", offset=16 + 8 * n, shape=(n,)) if n else np.empty(0, np.uint8)
        self.more_at = np.fromfile(path, dtype="<i8", count=m, offset=16 + 9 * n)
        self.more = np.fromfile(path, dtype="<i8", count=m, offset=16 + 9 * n + 8 * m)

    @staticmethod
    def write(path: str, keys: np.ndarray, counts: np.ndarray) -> None:
        many = np.flatnonzero(counts >= 255)
        _write(path, np.array([len(keys), len(many)], "<i8"), keys.astype("<u8"),
               np.minimum(counts, 255).astype("u1"), many.astype("<i8"), counts[many].astype("<i8"))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions (-1: absent) and counts of sorted keys."""
        if not len(self.keys):
            return np.full(len(keys), -1), np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        there = self.keys[at] == keys
        counts = np.where(there, self.bytes[at], 0).astype(np.int64)
        many = np.flatnonzero(counts == 255)
        counts[many] = self.more[np.searchsorted(self.more_at, at[many])]
        return np.where(there, at, -1), counts


def _write(path: str, *arrays: np.ndarray) -> None:
    """Write arrays to one file at once: a repeated task replaces it whole."""
    context = TaskContext.get()
    part = f"{path}.{context.taskAttemptId() if context else 0}.tmp"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(part, "wb") as out:
        for a in arrays:
            a.tofile(out)
    os.replace(part, path)


@dataclass
class Model:
    """Totals of a stored model; its arrays stay in ``path``."""

    path: str
    bits: int
    offsets: np.ndarray
    tokens: int = 0
    texts: int = 0
    discounts: tuple = (0.5, 1.0, 1.5)
    low_discounts: tuple = (0.5, 1.0, 1.5)
    pairs: int = 0
    low_gamma: float = 1.0
    split: int = SPLIT
    _open: dict = field(default_factory=dict)

    @property
    def words(self) -> int:
        return int(self.offsets[-1])

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    def shard(self, kind: str, number: int) -> Sorted:
        key = (kind, number)
        if key not in self._open:
            self._open[key] = Sorted(f"{self.path}/{kind}/{number:06d}")
        return self._open[key]

    def table(self, block: int) -> np.ndarray:
        """N1+(.w), N1(w.), N2(w.), N3+(w.) of the word ids of a block."""
        key = ("table", block)
        if key not in self._open:
            self._open[key] = np.memmap(f"{self.path}/table/{block:06d}", dtype="<u4", mode="r").reshape(-1, 4)
        return self._open[key]

    def ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word ids (-1: unknown) and counts."""
        order = np.argsort(hashes, kind="stable")
        known, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        shards = _shard_of_hash(hashes[order], self.bits)
        for s, part in _runs(shards, order):
            at, n = self.shard("words", s).find(hashes[part])
            known[part] = np.where(at >= 0, at + self.offsets[s], -1)
            counts[part] = n
        return known, counts

    def pair_counts(self, first: np.ndarray, second: np.ndarray, seen: np.ndarray) -> np.ndarray:
        keys = (first.astype(np.uint64) << _WORD_BITS) | second.astype(np.uint64)
        shards = _shard_of_pair(first.astype(np.uint64), second.astype(np.uint64), seen, self.bits, self.split)
        order = np.lexsort((keys, shards))
        counts = np.zeros(len(keys), np.int64)
        for s, part in _runs(shards[order], order):
            counts[part] = self.shard("pairs", s).find(keys[part])[1]
        return counts

    def table_rows(self, ids: np.ndarray) -> np.ndarray:
        out = np.zeros((len(ids), 4), np.int64)
        order = np.argsort(ids, kind="stable")
        for b, part in _runs(ids[order] // IDS, order):
            out[part] = self.table(b)[ids[part] - b * IDS]
        return out


def _runs(sorted_values: np.ndarray, order: np.ndarray):
    """(value, positions) for each run of equal values."""
    if not len(sorted_values):
        return
    first = np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]])
    for a, b in zip(first, np.r_[first[1:], len(sorted_values)]):
        yield int(sorted_values[a]), order[a:b]


_BLOCKS = pa.schema([("shard", pa.int64()), ("high", pa.binary()), ("low", pa.binary()), ("counts", pa.binary())])
_BLOCKS_DDL = "shard long, high binary, low binary, counts binary"


class _Held:
    """Keys of a task, summed and given out by shard when many are held."""

    def __init__(self, shards, limit):
        self.shards, self.limit, self.keys, self.counts, self.size = shards, limit, [], [], 0

    def add(self, keys, counts):
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)
        if self.size > self.limit:
            yield from self.flush()

    def flush(self):
        if not self.size:
            return
        keys, counts = _summed(np.concatenate(self.keys), np.concatenate(self.counts))
        shards = self.shards(keys)
        order = np.argsort(shards, kind="stable")
        rows = [(s, *_packed(keys[part], counts[part])) for s, part in _runs(shards[order], order)]
        self.keys, self.counts, self.size = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _BLOCKS)], schema=_BLOCKS)


def _by_shard(batches, columns):
    """(shard, lists of column values) of batches sorted by their first column."""
    now, held = None, None
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(columns))):
            if row[0] != now:
                if held:
                    yield now, held
                now, held = row[0], []
            held.append(row[1:])
    if held:
        yield now, held


def _merged(blocks: DataFrame, shards: int, merge, ddl: str) -> DataFrame:
    return (blocks.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(merge, ddl))


def _local(path: str) -> str:
    scheme = re.match(r"([a-z][a-z0-9+.-]+):", path)
    if scheme and scheme[1] != "file":
        raise ValueError(f"{path}: the n-gram model is memory-mapped; spark.checkpoint.dir must be a mounted file: folder")
    return re.sub(r"^file:/+", "/", path)


def _count_words(texts: DataFrame, bits: int, path: str, limit: int):
    def count(batches):
        held = _Held(lambda keys: _shard_of_hash(keys, bits), limit)
        for batch in batches:
            for t in _tokens(utf8(batch.column(0))):
                yield from held.add(t.hashes, np.bincount(t.codes, minlength=len(t.hashes)))
        yield from held.flush()

    def merge(batches):
        for shard, rows in _by_shard(batches, 4):
            parts = [_unpacked(*r) for r in rows]
            keys, counts = _summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
            Sorted.write(f"{path}/words/{shard:06d}", keys, counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard]), pa.array([len(keys)]), pa.array([int(counts.sum())])], ["shard", "n", "total"])

    blocks = texts.mapInArrow(count, _BLOCKS_DDL)
    return _merged(blocks, 1 << bits, merge, "shard long, n long, total long").collect()


def _previous(t: Tokens, ids: np.ndarray, start: int, carried: tuple[int, int]) -> np.ndarray:
    """The id before each token; ``carried`` is (document, last id) of an unfinished text."""
    before = np.r_[start, ids[:-1]]
    before[t.starts] = start
    if len(t.starts) and carried[0] == t.docs[0]:
        before[t.starts[0]] = carried[1]
    follow = np.flatnonzero(t.docs[1:] == t.docs[:-1]) + 1 if len(t.docs) > 1 else np.empty(0, np.int64)
    before[t.starts[follow]] = ids[t.starts[follow] - 1]
    return before


def _walk(model: Model, texts: list[bytes | None]):
    """(tokens, ids, counts, previous ids, previous counts) of runs of pieces."""
    carried = (-1, -1)
    seen_before = 0
    for t in _tokens(texts):
        ids, counts = model.ids(t.hashes)
        ids, counts = ids[t.codes], counts[t.codes]
        before = _previous(t, ids, model.words, carried)
        seen = np.r_[0, counts[:-1]]
        if carried[0] >= 0 and carried[0] == t.docs[0]:
            seen[0] = seen_before
        seen[before == model.words] = model.texts
        carried = (int(t.docs[-1]), int(ids[-1])) if not t.ends[-1] else (-1, -1)
        seen_before = int(counts[-1])
        yield t, ids, counts, before, seen


def _count_pairs(texts: DataFrame, held_model, bits: int, path: str, limit: int) -> DataFrame:
    """Store the pair shards; rows of totals (``block`` null) and of blocks for the word table."""
    schema = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary()),
                        ("n", pa.list_(pa.int64()))])

    def count(batches):
        model = held_model.value
        parts: list = []

        def give():
            first = np.concatenate([p[0] for p in parts])
            counts = np.concatenate([p[2] for p in parts])
            keys, counts = _summed(first, counts)
            seen = np.concatenate([p[1] for p in parts])
            # how often the first word occurs is the same for every copy of a key
            order = np.argsort(first, kind="stable")
            seen = seen[order][np.flatnonzero(np.r_[True, np.diff(first[order]) != 0])]
            shards = _shard_of_pair(keys >> _WORD_BITS, keys & _LOW, seen, bits, model.split)
            by = np.argsort(shards, kind="stable")
            rows = [(s, *_packed(keys[part], counts[part])) for s, part in _runs(shards[by], by)]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _BLOCKS)], schema=_BLOCKS)

        size = 0
        for batch in batches:
            for t, ids, _, before, seen in _walk(model, utf8(batch.column(0))):
                keys = (before.astype(np.uint64) << _WORD_BITS) | ids.astype(np.uint64)
                order = np.argsort(keys, kind="stable")
                keys = keys[order]
                first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                parts.append((keys[first], seen[order][first], np.diff(np.r_[first, len(keys)])))
                size += len(first)
                if size > limit:
                    yield give()
                    parts, size = [], 0
        if parts:
            yield give()

    def merge(batches):
        for shard, rows in _by_shard(batches, 4):
            parts = [_unpacked(*r) for r in rows]
            keys, counts = _summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
            del parts, rows
            Sorted.write(f"{path}/pairs/{shard:06d}", keys, counts)
            totals = [len(keys), *(int((counts == k).sum()) for k in (1, 2, 3, 4))]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                 pa.array([totals], pa.list_(pa.int64()))], schema=schema)
            first, second = (keys >> _WORD_BITS).astype(np.int64), (keys & _LOW).astype(np.int64)
            at = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
            table = [(first[at], np.stack([np.zeros(len(at), np.int64)] + [
                np.add.reduceat(x.astype(np.int64), at) for x in (counts == 1, counts == 2, counts > 2)], axis=1))]
            words, times = np.unique(second, return_counts=True)
            table.append((words, np.stack([times] + [np.zeros(len(words), np.int64)] * 3, axis=1)))
            for ids, values in table:
                for block, part in _runs(ids // IDS, np.arange(len(ids))):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block]), pa.array([_small(np.diff(ids[part] - block * IDS, prepend=0))]),
                         pa.array([b"".join(len(x).to_bytes(8, "little") + x for x in
                                            (_small(values[part, k]) for k in range(4)))]),
                         pa.nulls(1, pa.list_(pa.int64()))], schema=schema)

    blocks = texts.mapInArrow(count, _BLOCKS_DDL)
    return _merged(blocks, 1 << bits, merge, "block long, ids binary, counts binary, n array<long>")


def _store_table(rows: DataFrame, words: int, path: str) -> list:
    """Store the word table; a row of counts of N1+(.w) for each block."""
    def merge(batches):
        for block, parts in _by_shard(batches, 3):
            table = np.zeros((IDS, 4), np.int64)
            for ids, values in parts:
                at = np.cumsum(_large(ids).astype(np.int64))
                place = 0
                for k in range(4):
                    n = int.from_bytes(values[place:place + 8], "little")
                    table[at, k] += _large(values[place + 8:place + 8 + n]).astype(np.int64)
                    place += 8 + n
            _write(f"{path}/table/{block:06d}", table.astype("<u4"))
            mine = table[:max(0, min(IDS, words - block * IDS)), 0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([[int((mine == k).sum()) for k in (1, 2, 3, 4)] + [int((mine > 2).sum())]],
                                             pa.list_(pa.int64()))], ["block", "n"])

    blocks = words // IDS + 1
    return (rows.repartition(blocks, "block").sortWithinPartitions("block")
            .mapInArrow(merge, "block long, n array<long>").collect())


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """D1, D2, D3+ from counts of counts; 0.5, 1 and 1.5 where one is missing."""
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    each = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.0), k) for k, d in zip((1.0, 2.0, 3.0), each))


def train(docs: DataFrame, text_col: str = "text", split: int = SPLIT, held_keys: int = HELD) -> Model:
    """Count ``docs`` and store a model; null and empty texts are an end token alone.

    ``split`` and ``held_keys`` bound a shard and a task; results do not depend on them.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    bits = max(4, (2 * texts.rdd.getNumPartitions() - 1).bit_length())
    path = _local(scratch_path(spark, "ngram"))
    rows = _count_words(texts, bits, path, held_keys)
    sizes = np.zeros(1 << bits, np.int64)
    for r in rows:
        sizes[r["shard"]] = r["n"]
    model = Model(path, bits, np.r_[0, np.cumsum(sizes)], tokens=sum(r["total"] for r in rows), split=split)
    if not model.words:
        return model
    if model.words >= 1 << 32:
        raise ValueError("more than 2^32 distinct words")
    import xxhash

    end = np.array([xxhash.xxh64_intdigest(b"")], np.uint64)
    model.texts = int(model.ids(end)[1][0])
    held = spark.sparkContext.broadcast(model)
    found = cut(_count_pairs(texts, held, bits, path, held_keys), "ngram-table")
    totals = found.where("block is null").select(
        *[F.sum(F.col("n")[i]).alias(f"n{i}") for i in range(5)]).first()
    model.pairs = totals["n0"]
    model.discounts = discounts(*(totals[f"n{i}"] for i in range(1, 5)))
    low = np.sum([r["n"] for r in _store_table(found.where("block is not null").select("block", "ids", "counts"),
                                                model.words, path)], axis=0)
    model.low_discounts = discounts(*map(int, low[:4]))
    model.low_gamma = sum(d * n for d, n in zip(model.low_discounts, (low[0], low[1], low[4]))) / model.pairs
    return model


def _discount(counts: np.ndarray, d: tuple) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3)]


def log_probabilities(model: Model, ids, before, seen) -> np.ndarray:
    """log10 P of tokens given the ids before them (-1: unknown, ``words``: start)."""
    n = len(ids)
    known, after = ids >= 0, before >= 0
    low = np.zeros(n)
    if known.any():
        words, code = np.unique(ids[known], return_inverse=True)
        times = model.table_rows(words)[:, 0]
        low[known] = ((times - _discount(times, model.low_discounts)) / model.pairs)[code]
    low += model.low_gamma / (model.words + 1)
    p = low.copy()
    if after.any():
        words, code = np.unique(before[after], return_inverse=True)
        mass = model.table_rows(words)[:, 1:] @ np.array(model.discounts)
        p[after] = mass[code] / seen[after] * low[after]
        both = np.flatnonzero(known & after)
        counts = model.pair_counts(before[both], ids[both], seen[both])
        p[both] += (counts - _discount(counts, model.discounts)) / seen[both]
    return np.log10(p)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          carry: tuple = ()) -> DataFrame:
    """``(id_col, *carry, n_tokens, n_known, train_tokens, base_score, score, perplexity)``
    for every row.

    ``base_score`` is the add-one unigram log10 probability, ``score`` the
    model's.  Null and empty texts are scored as an end token alone; repeated
    rows and null ids are returned as they are; ``carry`` are extra columns.
    A model of no documents gives every token the probability 1.
    """
    rows = docs.select(F.struct(F.col(id_col), *carry).alias("payload"), F.col(text_col).cast("string").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = rows.schema["payload"].dataType.names

    def read(batches):
        model = held.value
        for batch in batches:
            n = batch.num_rows
            tokens, known = np.zeros(n, np.int64), np.zeros(n, np.int64)
            base, high = np.zeros(n), np.zeros(n)
            for t, ids, counts, before, seen in _walk(model, utf8(batch.column(1))):
                sums = lambda x: np.add.reduceat(x, t.starts)
                np.add.at(tokens, t.docs, np.diff(np.r_[t.starts, len(ids)]))
                np.add.at(known, t.docs, sums((counts > 0).astype(np.int64)))
                np.add.at(base, t.docs, sums(np.log10((counts + 1) / (model.tokens + model.words + 1))))
                if model.words:
                    np.add.at(high, t.docs, sums(log_probabilities(model, ids, before, seen)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tokens), pa.array(known), pa.array(np.full(n, model.tokens)),
                 pa.array(base), pa.array(high), pa.array(10 ** (-high / np.maximum(tokens, 1)))],
                ["payload", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    out = T.StructType([rows.schema["payload"],
                        *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")],
                        *[T.StructField(c, T.DoubleType()) for c in ("base_score", "score", "perplexity")]])
    found = rows.mapInArrow(read, out)
    return found.select(*[F.col("payload")[c].alias(c) for c in names], *out.names[1:])
