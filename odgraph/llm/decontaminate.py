"""Benchmark decontamination: hashed n-grams of benchmark items are broadcast,
the windows of every document are looked up, hits are verified word by word,
and the hit spans (or whole documents) are removed.

The benchmark travels in blocks of at most ``MAX_WORDS`` words; a larger one
is scanned block by block over the marks that earlier blocks left, with the
same result.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odgraph.llm.common import cut, slices, utf8, valid_text

WINDOW = 10
#: Words of benchmark text that one broadcast holds at most.
MAX_WORDS = 2_000_000
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


#: Lower-cases A-Z and blanks every byte that is no part of a word.
_FOLD = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b > 127 else b + 32 if 65 <= b < 91 else 32
              for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased runs of digits, Latin letters and non-ASCII characters."""
    return text.translate(_FOLD).split() if text else []


class WindowSet:
    """Windows of the items of one block: ids of words, and for each window
    length the sorted hashes and the items of each verified window."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.ids: dict[bytes, int] = {}
        self.items: dict[tuple, set[str]] = {}
        for name, text in items:
            words = words_of(text)
            if not words:
                continue
            ids = [self.ids.setdefault(w, len(self.ids) + 1) for w in words]
            width = min(window, len(ids))
            for i in range(len(ids) - width + 1):
                self.items.setdefault(tuple(ids[i:i + width]), set()).add(name)
        self.hashes = {}
        for width in sorted({len(k) for k in self.items}):
            keys = np.array([k for k in self.items if len(k) == width], dtype=np.uint64)
            self.hashes[width] = np.unique(self._hash(keys))

    @staticmethod
    def _hash(columns: np.ndarray) -> np.ndarray:
        out = np.zeros(len(columns), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for j in range(columns.shape[1]):
                out = (out + columns[:, j]) * _BASE
                out ^= out >> np.uint64(29)
        return out

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words lie in an occurrence of a window, and whose windows occur."""
        hit = np.zeros(len(words), dtype=bool)
        found: set[str] = set()
        n = len(words)
        if not n or not self.hashes:
            return hit, found
        ids = np.fromiter(map(self.ids.get, words, repeat(0)), dtype=np.uint64, count=n)
        misses = np.r_[0, np.cumsum(ids == 0)]
        for width, hashes in self.hashes.items():
            if n < width:
                continue
            starts = np.flatnonzero(misses[width:] == misses[:-width])
            if not len(starts):
                continue
            columns = np.lib.stride_tricks.sliding_window_view(ids, width)[starts]
            mine = self._hash(columns)
            at = np.minimum(np.searchsorted(hashes, mine), len(hashes) - 1)
            for i in np.flatnonzero(hashes[at] == mine):
                owners = self.items.get(tuple(columns[i].tolist()))
                if owners:
                    found |= owners
                    hit[starts[i]:starts[i] + width] = True
        return hit, found


def _blocks(bench: DataFrame, id_col: str, text_col: str, limit: int) -> tuple[DataFrame, int]:
    """The items with a block number; a block has about ``limit`` bytes / 6 words."""
    items = bench.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"),
                         valid_text(F.col(text_col)).alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + int(total // (6 * limit))
    return items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks))), blocks


def _marker(held):
    """Adds one block's hits to the marks; a mark byte stands for a word."""

    def rows(batches):
        for batch in batches:
            for part in slices(batch, 1):
                hits = held.value.hits
                marks, names = [], []
                old = part.column(2).to_pylist()
                for text, mark, had in zip(utf8(part.column(1)), old, part.column(3).to_pylist()):
                    hit, found = hits(words_of(text))
                    if mark:
                        hit |= np.frombuffer(mark, dtype=bool)
                    marks.append(hit.tobytes() if hit.any() else None)
                    names.append(sorted(found.union(had or ())))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(marks, pa.binary()),
                     pa.array(names, pa.list_(pa.string()))], ["payload", "text", "marks", "items"])

    return rows


def without_spans(text: bytes, hit: np.ndarray) -> str:
    """The text without each run of hit words, from the first letter of its
    first word to the last of its last; white space around a cut is one space."""
    spans = [m.span() for m in _WORD.finditer(text.lower())]
    edge = np.flatnonzero(np.diff(np.r_[0, hit.view(np.int8), 0]))
    out, at = [], 0
    for first, end in zip(edge[::2], edge[1::2]):
        out.append(text[at:spans[first][0]])
        at = spans[end - 1][1]
    out.append(text[at:])
    return " ".join(x for x in (p.decode().strip() for p in out) if x)


def _finisher(keep_text: bool):
    def rows(batches):
        for batch in batches:
            for part in slices(batch, 1):
                n_words, n_hit, clean = [], [], []
                for text, mark in zip(utf8(part.column(1)), part.column(2).to_pylist()):
                    hit = np.frombuffer(mark, dtype=bool) if mark else None
                    n_words.append(len(words_of(text)) if hit is None else len(hit))
                    n_hit.append(0 if hit is None else int(hit.sum()))
                    if not keep_text or text is None:
                        clean.append(None)
                    else:
                        clean.append(text.decode() if hit is None else without_spans(text, hit))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                     part.column(3), pa.array(clean, pa.string())],
                    ["payload", "n_words", "n_hit", "items", "clean"])

    return rows


def _scanned(docs: DataFrame, payload: list[str], text_col: str, bench: DataFrame, item_col: str,
             item_text: str, window: int, max_words: int, keep_text: bool) -> DataFrame:
    """``(payload, n_words, n_hit, items, clean)``; ``payload`` is a struct of columns."""
    spark = docs.sparkSession
    items, blocks = _blocks(bench, item_col, item_text, max_words)
    state = docs.select(F.struct(*[F.col(f"`{c}`") for c in payload]).alias("payload"),
                        valid_text(F.col(text_col)).alias("text"),
                        F.lit(None).cast("binary").alias("marks"),
                        F.array().cast("array<string>").alias("items"))
    marked = T.StructType([T.StructField(f.name, f.dataType) for f in state.schema.fields])
    for block in range(blocks):
        rows = [(r["item"], r["text"].encode()) for r in items.where(F.col("block") == block).collect()]
        held = spark.sparkContext.broadcast(WindowSet(rows, window))
        if block:
            state = cut(state, "decontaminate")
        state = state.mapInArrow(_marker(held), marked)
    out = T.StructType([marked["payload"], T.StructField("n_words", T.LongType()),
                        T.StructField("n_hit", T.LongType()), marked["items"],
                        T.StructField("clean", T.StringType())])
    return state.mapInArrow(_finisher(keep_text), out)


def scan(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
         max_words: int = MAX_WORDS) -> DataFrame:
    """``(id_col, n_words, n_hit, items)`` of every row of ``docs``.

    ``items`` is the sorted list of item ids (as strings) that have a window
    in the document.  Null and empty texts have no words, items without words
    no window; a null item id is named ``null``; items that share an id are
    one item; an empty benchmark leaves every document clean.  Repeated
    documents are scanned each, columns of other names are not read; bytes that
    are not UTF-8 are U+FFFD, a part of words.
    """
    found = _scanned(docs, [id_col], text_col, bench, item_col, item_text, window, max_words, False)
    return found.select(F.col("payload")[id_col].alias(id_col), "n_words", "n_hit", "items")


def decontaminate(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, max_words: int = MAX_WORDS,
                  max_hit_share: float = 0.5) -> DataFrame:
    """``docs`` without benchmark passages: hit spans are cut out of the text,
    documents with more than ``max_hit_share`` of their words hit go.

    All columns stay as they are, except that a cut row's ``n_chars``, where
    there is one, is counted again; rows without hits are unchanged, but for bytes
    that are not UTF-8, which become U+FFFD.  Null and empty texts have no words
    and stay; repeated rows are treated each; an empty benchmark cuts nothing.
    """
    others = [c for c in docs.columns if c != text_col]
    found = _scanned(docs, others, text_col, bench, item_col, item_text, window, max_words, True)
    kept = found.where(F.col("n_hit") <= max_hit_share * F.col("n_words"))

    def column(name):
        if name == text_col:
            return F.col("clean").alias(name)
        value = F.col("payload")[name]
        if name == "n_chars":
            value = F.when(F.col("n_hit") > 0, F.char_length("clean").cast(docs.schema[name].dataType)).otherwise(value)
        return value.alias(name)

    return kept.select(*map(column, docs.columns))
