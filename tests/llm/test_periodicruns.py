"""Runs of repeated words against a direct search."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from odgraph.llm import periodicruns
from odgraph.llm.catalog import QUERIES
from tests.llm.helpers import SF001


def _brute(words, least=12):
    """Every maximal stretch of every period, with its least period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            s = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(least, 2 * q):
                found.setdefault((s, i + q), q)
            i += 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def _words(rng):
    n, kind = rng.randint(0, 150), rng.random()
    if kind < 0.3:
        return [rng.randrange(2) for _ in range(n)]
    if kind < 0.6:
        w = ([rng.randrange(5) for _ in range(rng.randint(1, 40))] * 150)[:n]
        for _ in range(rng.randint(0, 3) if w else 0):
            w[rng.randrange(n)] = 9
        return w
    if kind < 0.8:
        a, b = [0], [0, 1]
        for _ in range(10):
            a, b = b, b + a
        return b[rng.randint(0, 20):][:n]
    return [rng.randrange(100) for _ in range(n)]


@pytest.mark.parametrize("table,pairs", [(1 << 14, 1 << 20), (64, 50)])
def test_runs_equal_direct_search(monkeypatch, table, pairs):
    monkeypatch.setattr(periodicruns, "TABLE", table)
    monkeypatch.setattr(periodicruns, "PAIRS", pairs)
    periodicruns._table.cache_clear()
    rng = random.Random(table)
    for _ in range(150):
        texts = [_words(rng) for _ in range(rng.randint(1, 9))]
        got = periodicruns.runs_of([np.array(t, dtype=np.int32) for t in texts], 12)
        assert [[tuple(r) for r in g.tolist()] for g in got] == [_brute(t) for t in texts]
    periodicruns._table.cache_clear()


def test_extensions_equal_word_by_word_comparison():
    rng = random.Random(1)
    once = [w for _ in range(10) for w in _words(rng)]
    text = np.array(once * 3 + [1000], dtype=np.int32)
    lce = periodicruns.CoverLCE(text)
    i = np.array([rng.randrange(len(text) - 1) for _ in range(4000)])
    j = np.array([rng.choice([rng.randrange(a + 1, len(text)), min(a + len(once), len(text) - 1)]) for a in i])
    i = np.minimum(i, j - 1)
    want = [next(t for t in range(len(text)) if text[a + t] != text[b + t]) for a, b in zip(i, j)]
    assert lce.query(i, j).tolist() == want
    assert max(want) > 20 * periodicruns.PERIOD


def test_query_equals_direct_search(spark):
    want, planted = {}, 0
    for r in spark.read.parquet(f"{SF001}/documents.parquet").collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            planted += 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
        runs = _brute(w) if n < 700 else [tuple(x) for x in periodicruns.runs_of(
            [np.unique(w, return_inverse=True)[1].astype(np.int32)], 12)[0].tolist()]
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want[r.doc_id] = (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                          sha("".join("%d,%d,%d\n" % x for x in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_runs"](spark, SF001).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()}
    assert got == want and planted > 10 and sum(x[0] > 0 for x in got.values()) > 10


def test_edge_rows(spark):
    rows = [(None, None), (1, ""), (2, " \n"), (3, "a b " * 6), (3, "a b " * 6), (4, "a " * 11), (5, "x" * 100_000), (6, "a " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit("clash")).withColumn("start", F.lit(1))
    got = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], len(r.collapsed)) for r in periodicruns.find_runs(docs).collect())
    assert got == [(0, 0, [], 0), (1, 0, [], 0), (2, 0, [], 0), (3, 12, [(0, 12, 2)], 3), (3, 12, [(0, 12, 2)], 3), (4, 11, [], 21),
                   (5, 1, [], 100_000), (6, 50_000, [(0, 50_000, 1)], 1)]
    assert periodicruns.find_runs(docs.limit(0)).collect() == []
    bad = spark.sql("select 1L as doc_id, cast(x'61ff' as string) as text")
    assert periodicruns.find_runs(bad).first().collapsed == "a�"
