"""Vector groups against brute force: recall, counts, components, odd rows."""

import numpy as np
import pytest

from odgraph.llm import embeddings


def _brute(vectors, threshold=0.9):
    n = len(vectors)
    ok = [i for i, v in enumerate(vectors) if v and None not in v and np.isfinite(v).all() and any(v)]
    link = np.zeros((n, n), bool)
    for i in ok:
        for j in ok:
            if i != j and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], float), np.array(vectors[j], float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                link[i, j] = a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold
    return link


def _components(link, ids):
    n = len(ids)
    out = list(range(n))
    for i in range(n):
        seen, queue = {i}, [i]
        while queue:
            for j in np.flatnonzero(link[queue.pop()]):
                if j not in seen:
                    seen.add(int(j))
                    queue.append(int(j))
        out[i] = min((ids[j] for j in seen if ids[j] is not None), default=None)
    return out


@pytest.mark.parametrize("bucket", [1024, 20])
def test_groups_equal_brute_force(spark, bucket):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(150, 24))
    rows = [b for b in base]
    for k in range(12):
        rows += [base[k] + rng.normal(size=24) * rng.choice([0.05, 0.2, 0.3]) for _ in range(rng.integers(1, 9))]
    rows += [base[0] + rng.normal(size=24) * 0.02 for _ in range(60)]  # one large group
    vectors = [[float(x) for x in r] for r in rows] + [[float(x) for x in base[3]]] * 5
    vectors += [None, [], [0.0] * 24, [float("nan")] * 24, [1.0, None], [float("inf")] + [1.0] * 23,
                [1e-200] * 24, [3e-200] * 24, [1.0, 2.0], [2.0, 4.0], [1.0] * 24]
    ids = list(range(1000, 1000 + len(vectors)))
    ids[5], ids[6], ids[7] = None, ids[8], 3
    df = spark.createDataFrame([(i, v, 0) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>, node int")
    got = embeddings.embedding_groups(df, bucket=bucket, occupancy=16).collect()
    link = _brute(vectors)
    want_component = _components(link, ids)
    counts = sorted((i or -1, int(n), -1 if c is None else c) for i, n, c in zip(ids, link.sum(axis=1), want_component))
    assert sorted((r.vec_id or -1, r.n_links, -1 if r.component_id is None else r.component_id) for r in got) == counts
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert embeddings.embedding_groups(df.where("false")).count() == 0


def test_recall_at_the_threshold():
    """Pairs at cosine 0.9 exactly: the tables retrieve at least 0.9 of them."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=x.shape)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    y = 0.9 * x + np.sqrt(1 - 0.81) * y
    bits, tables = embeddings.plan(50_000)
    index = embeddings.Index(list(x[:2000]), bits, tables)
    assert (index.keys(x) == index.keys(y)).any(axis=1).mean() >= 0.98


def test_rotation_is_orthogonal_and_lowers_the_quantisation_error():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 16)) * np.linspace(0.2, 2, 16)
    rotation = embeddings.learn_rotation(x, 0)
    assert np.allclose(rotation @ rotation.T, np.eye(16), atol=1e-8)
    error = lambda r: np.square(np.where(x @ r >= 0, 1, -1) - x @ r).sum()
    assert error(rotation) < error(embeddings.learn_rotation(x, 0, rounds=0))
