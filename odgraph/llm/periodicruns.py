"""Runs of repeated words, found with longest common extensions.

A *run* is a stretch of words with smallest period q (words q apart are equal)
of at least ``max(min_length, 2 * q)`` words that no neighbouring word extends
with that period.

**Grid.**  A run of period q holds a pair of neighbouring multiples of q, so
for every q the pairs ``(i, i + q)`` with q dividing i are enough: n ln n pairs
of a text of n words.  A pair whose words are equal is extended as far as the
words q apart agree, to the right and to the left; the stretch is kept if it
is long enough.  All multiples of the smallest period give the same stretch,
so the least q of a stretch is its period.

**Extensions.**  Most pairs differ after few words, which are compared.  The
texts in which some pair does not are put into :class:`CoverLCE`, forwards and
backwards: of their suffixes only those at the positions of a difference cover
(4 of 13) are sorted, by doubling; any two positions reach a pair of covered
ones within 12 words, and the common prefix of two covered suffixes is the
minimum of the adjacent ones between them, kept in a sparse table.

Many texts go through each step at once, each closed by a word of its own.  A
text is handled whole in one task and takes about 150 bytes of memory a word.
"""

from __future__ import annotations

from collections import defaultdict
from functools import lru_cache
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odgraph.llm.common import slices, utf8

#: A perfect difference cover: every distance modulo 13 is the difference of two members.
PERIOD, COVER = 13, (0, 1, 3, 9)
_PER = len(COVER)
_SLOT = np.full(PERIOD, -1, dtype=np.int64)
_SLOT[list(COVER)] = np.arange(_PER)
#: _REACH[d]: the member c of the cover for which c + d is a member as well.
_REACH = np.array([next(c for c in COVER if (c + d) % PERIOD in COVER) for d in range(PERIOD)], dtype=np.int64)
#: Grid pairs of texts up to this many words come from one table.
TABLE = 1 << 14
#: Pairs that are extended at once.
PAIRS = 1 << 20


def _matches(text: np.ndarray, i: np.ndarray, j: np.ndarray, limit: np.ndarray, step: int = 1) -> np.ndarray:
    """How many words from ``i`` and ``j`` on (backwards for ``step`` -1) are
    equal, up to ``limit``."""
    out = np.zeros(len(i), dtype=np.int64)
    live = np.arange(len(i))
    for t in range(int(limit.max()) if len(i) else 0):
        live = live[limit[live] > t]
        live = live[text[i[live] + step * t] == text[j[live] + step * t]]
        if not len(live):
            break
        out[live] += 1
    return out


class CoverLCE:
    """Longest common extensions of positions in ``text``, an array whose words
    that close a text occur once each; the last word is one of them."""

    def __init__(self, text: np.ndarray):
        self.size = len(text)
        self.text = np.concatenate([text, np.full(2 * PERIOD, -1, text.dtype)])
        blocks = -(-self.size // PERIOD)
        at = (np.arange(blocks)[:, None] * PERIOD + np.array(COVER)).ravel()
        at = at[at < self.size]
        n = len(at)
        windows = self.text[at[:, None] + np.arange(PERIOD)].astype(">i4")
        _, rank = np.unique(windows.view(f"V{4 * PERIOD}").ravel(), return_inverse=True)
        levels = [rank.astype(np.int64)]
        while levels[-1].max() + 1 < n:  # closing words make all suffixes differ
            rank, ahead = levels[-1], _PER << (len(levels) - 1)
            follow = np.full(n, -1, dtype=np.int64)
            follow[:n - ahead] = rank[ahead:]
            levels.append(np.unique(rank * (n + 1) + follow + 1, return_inverse=True)[1])
        self.rank = levels[-1]
        order = np.empty(n, dtype=np.int64)
        order[self.rank] = np.arange(n)
        # common prefixes of neighbours in the order: down the levels, then the last words
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), dtype=np.int64)
        for k in range(len(levels) - 2, -1, -1):
            level = np.append(levels[k], [-1, -2])
            same = level[np.minimum(a, n)] == level[np.where(b < n, b, n + 1)]
            common += same * (PERIOD << k)
            a += same * (_PER << k)
            b += same * (_PER << k)
        i, j = at[order[:-1]] + common, at[order[1:]] + common
        common += _matches(self.text, i, j, np.full(len(i), PERIOD))
        self.table = [common]
        while 2 << (len(self.table) - 1) <= len(common):
            half, low = 1 << (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(low[:-half], low[half:]))

    def query(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from ``i`` and ``j`` on, for arrays of positions ``i < j``."""
        ahead = (_REACH[(j - i) % PERIOD] - i) % PERIOD
        out = _matches(self.text, i, j, ahead)
        far = np.flatnonzero(out == ahead)
        if len(far):
            a, b = ((p // PERIOD) * _PER + _SLOT[p % PERIOD] for p in (i[far] + ahead[far], j[far] + ahead[far]))
            a, b = self.rank[a], self.rank[b]
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp(high - low)[1] - 1
            for k in np.unique(level):
                pick = level == k
                row = self.table[k]
                out[far[pick]] += np.minimum(row[low[pick]], row[high[pick] - (1 << int(k))])
        return out


def _grid(first: int, last: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``(m, q)``: q up to ``most`` divides m, ``first <= m < last``."""
    q = np.arange(1, most + 1)
    low = -(-first // q)
    number = np.maximum((last - 1) // q - low + 1, 0)
    each = np.repeat(q, number)
    k = np.arange(len(each)) - np.repeat(np.cumsum(number) - number - low, number)
    return each * k, each


@lru_cache(maxsize=1)
def _table():
    m, q = _grid(1, TABLE, TABLE - 1)
    order = np.argsort(m, kind="stable")
    m, q = m[order].astype(np.int32), q[order].astype(np.int32)
    return m, q, np.searchsorted(m, np.arange(TABLE + 1))


def _equal_pairs(words: np.ndarray):
    """Blocks ``(m, q)`` of the grid pairs of one text with equal words at m - q and m."""
    n = len(words)
    m, q, ends = _table()
    end = ends[min(n, TABLE)]
    m, q = m[:end], q[:end]
    hit = np.flatnonzero(words[m] == words[m - q])
    hit = hit[q[hit] <= n // 2]
    yield m[hit].astype(np.int64), q[hit].astype(np.int64)
    step = max(TABLE, n // 16)
    for first in range(TABLE, n, step):
        m, q = _grid(first, min(first + step, n), n // 2)
        hit = np.flatnonzero(words[m] == words[m - q])
        yield m[hit], q[hit]


def _least(start, end, q):
    """Distinct stretches with their least period."""
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[new], end[new], q[new]


def runs_of(texts: list[np.ndarray], min_length: int) -> list[np.ndarray]:
    """Runs of every text (an array of word numbers from 0 on): rows ``start,
    length, period`` in the order of start, then period."""
    base = np.cumsum([1] + [len(t) + 1 for t in texts])
    whole = np.empty(base[-1], dtype=np.int32)
    closing = np.append(0, base[1:] - 1)
    words = 1 + max((int(t.max()) for t in texts if len(t)), default=-1)
    whole[closing] = words + np.arange(len(closing))
    for b, t in zip(base, texts):
        whole[b:b + len(t)] = t
    kept: list[tuple] = []
    far: list[tuple] = []

    def keep(start, end, q):
        long = end - start >= np.maximum(min_length, 2 * q)
        kept.append(_least(start[long], end[long], q[long]))

    def near(m, q):
        # a few words in both directions settle most pairs
        some = np.full(len(m), PERIOD)
        right = _matches(whole, m - q, m, some)
        left = _matches(whole, m - q - 1, m - 1, some, -1)
        done = (right < PERIOD) & (left < PERIOD)
        keep((m - q - left)[done], (m + right)[done], q[done])
        if not done.all():
            far.append((m[~done], q[~done]))

    held, total = [], 0
    for b, t in zip(base, texts):
        if len(t) >= min_length:
            for m, q in _equal_pairs(t):
                for at in range(0, len(m), PAIRS):
                    held.append((m[at:at + PAIRS] + b, q[at:at + PAIRS]))
                    total += len(held[-1][0])
                    if total >= PAIRS:
                        near(*map(np.concatenate, zip(*held)))
                        held, total = [], 0
    if held:
        near(*map(np.concatenate, zip(*held)))
    if far:
        # only the texts with a long extension, each after its closing word
        owners = np.unique(np.concatenate([np.searchsorted(base, m, "right") - 1 for m, _ in far]))
        ends = base[owners + 1] - 1
        starts = base[owners] - 1
        part = np.concatenate([whole[s:e] for s, e in zip(starts, ends)] + [whole[ends[-1]:ends[-1] + 1]])
        shift = np.cumsum(np.append(0, ends - starts))[:-1] - starts
        forward, backward = CoverLCE(part), CoverLCE(part[::-1])
        for m, q in far:
            for at in range(0, len(m), PAIRS):
                mm, qq = m[at:at + PAIRS], q[at:at + PAIRS]
                p = mm + shift[np.searchsorted(starts, mm, "right") - 1]
                right = forward.query(p - qq, p)
                left = backward.query(len(part) - p, len(part) - p + qq)
                keep(mm - qq - left, mm + right, qq)
    out = [np.empty((0, 3), dtype=np.int64)] * len(texts)
    if kept:
        start, end, q = _least(*map(np.concatenate, zip(*kept)))
        order = np.lexsort((q, start))
        start, end, q = start[order], end[order], q[order]
        owner = np.searchsorted(base, start, "right") - 1
        for k, a, b in zip(*_spans(owner)):
            out[k] = np.stack([start[a:b] - base[k], end[a:b] - start[a:b], q[a:b]], axis=1)
    return out


def _spans(owner: np.ndarray):
    owners, first = np.unique(owner, return_index=True)
    return owners, first, np.append(first[1:], len(owner))


def extra_words(n: int, runs: np.ndarray) -> np.ndarray:
    """True for each of ``n`` words that some run holds after its first period."""
    depth = np.zeros(n + 1, dtype=np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth[:-1]) > 0


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 12,
              carry: tuple[Column, ...] = ()) -> DataFrame:
    """For every row of ``docs`` its id, the columns in ``carry``, ``n_words``,
    ``runs`` (array of start, length and period in words, by start, then
    period) and ``collapsed``: the words that no run holds after its first
    period, joined by one space.

    Null and empty texts have no words, no runs and an empty ``collapsed``;
    null ids and repeated rows stay; an empty table gives an empty one; bytes
    that are not UTF-8 count as U+FFFD; other columns may have any names.
    """
    rows = docs.select(F.col(id_col), *carry, F.col(text_col).cast("string").alias("_text"))
    last = len(rows.columns) - 1
    run = T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")])
    added = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(run)),
                          T.StructField("collapsed", T.StringType())])

    def work(batches):
        for batch in batches:
            for part in slices(batch, last):
                numbers = defaultdict(count().__next__)
                texts = [[] if x is None else x.decode("utf-8", "replace").encode().split() for x in utf8(part.column(last))]
                found = runs_of([np.fromiter(map(numbers.__getitem__, t), np.int32, len(t)) for t in texts], min_length)
                collapsed = [b" ".join(compress(t, ~extra_words(len(t), r)) if len(r) else t).decode()
                             for t, r in zip(texts, found)]
                flat = np.concatenate([*found, np.empty((0, 3), np.int64)])
                structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], run.names)
                ends = pa.array(np.cumsum([0] + [len(r) for r in found]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:last], pa.array([len(t) for t in texts], pa.int64()),
                     pa.ListArray.from_arrays(ends, structs), pa.array(collapsed, pa.string())],
                    [*part.schema.names[:last], *added.names])

    return rows.mapInArrow(work, T.StructType([*rows.schema.fields[:last], *added.fields]))
