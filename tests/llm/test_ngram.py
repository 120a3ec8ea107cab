"""The n-gram model against a direct computation from dictionaries."""

import math
import random
from collections import Counter, defaultdict

import pytest

from odgraph.llm import ngram


def _tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + [""]


class Direct:
    def __init__(self, texts):
        self.c1, self.c2, self.c0 = Counter(), Counter(), Counter()
        for t in texts:
            w = _tokens(t)
            self.c1.update(w)
            pairs = list(zip(["<s>"] + w[:-1], w))
            self.c2.update(pairs)
            self.c0.update(a for a, _ in pairs)
        self.cont = Counter(b for _, b in self.c2)
        self.follow = defaultdict(list)
        for (a, _), n in self.c2.items():
            self.follow[a].append(n)
        self.d = ngram.discounts(*(sum(n == k for n in self.c2.values()) for k in (1, 2, 3, 4)))
        self.dl = ngram.discounts(*(sum(n == k for n in self.cont.values()) for k in (1, 2, 3, 4)))

    def p(self, u, w):
        disc = lambda n, d: (0.0, *d)[min(n, 3)]
        pairs = len(self.c2)
        gamma = sum(disc(n, self.dl) for n in self.cont.values()) / pairs
        low = (self.cont[w] - disc(self.cont[w], self.dl)) / pairs + gamma / (len(self.c1) + 1)
        if not self.c0[u]:
            return low
        back = sum(disc(n, self.d) for n in self.follow[u]) / self.c0[u]
        return (self.c2[u, w] - disc(self.c2[u, w], self.d)) / self.c0[u] + back * low


@pytest.fixture
def corpus():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(30)] + ["Ärm", "B"]
    return [" ".join(rng.choice(words[:rng.randrange(2, 32)]) for _ in range(rng.randrange(0, 40))) for _ in range(120)] + [
        None, "", "  \n\t"]


@pytest.mark.parametrize("options", [{}, {"split": 10, "held_keys": 50}])
def test_scores_equal_direct_computation(spark, corpus, options):
    direct = Direct(corpus[:80])
    train = spark.createDataFrame([(t,) for t in corpus[:80]], "text string").repartition(5)
    model = ngram.train(train, **options)
    assert model.tokens == sum(direct.c1.values()) and model.words == len(direct.c1)
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(corpus)] + [(None, "new words w1", 1.0)],
                                 "doc_id long, text string, score double")
    rows = ngram.score(docs, model).collect()
    assert len(rows) == len(corpus) + 1
    texts = dict(enumerate(corpus)) | {None: "new words w1"}
    for r in rows:
        w = _tokens(texts[r.doc_id])
        assert r.n_tokens == len(w) and r.n_known == sum(direct.c1[x] > 0 for x in w)
        base = sum(math.log10((direct.c1[x] + 1) / (model.tokens + model.words + 1)) for x in w)
        want = sum(math.log10(direct.p(u, x)) for u, x in zip(["<s>"] + w[:-1], w))
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(want, rel=1e-9)
    for u in ("<s>", "w1", "ärm", "unseen"):
        total = sum(direct.p(u, w) for w in direct.c1) + direct.p(u, "unseen")
        assert total == pytest.approx(1.0)


def test_a_text_cut_in_pieces_is_walked_as_one(spark, corpus, monkeypatch):
    import numpy as np

    model = ngram.train(spark.createDataFrame([(t,) for t in corpus], "text string"))
    texts = [" ".join(t or "" for t in corpus).encode(), b"w1 w2", None, b"w3 " * 30]

    def walked():
        out = [np.concatenate(x) for x in zip(*(w[1:] for w in ngram._walk(model, texts)))]
        return [x.tolist() for x in out]

    whole = walked()
    monkeypatch.setattr(ngram, "PIECE", 40)
    assert walked() == whole


def test_empty_training_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    rows = ngram.score(docs, ngram.train(docs.where("false"))).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in sorted(rows)] == [
        (3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0)]
    model = ngram.train(docs)
    assert ngram.score(docs.where("false"), model).count() == 0


def test_model_beats_the_unigram_baseline(spark):
    from odgraph.llm.catalog import op7_lm_score

    rows = op7_lm_score(spark, "/root/testdata/sf0.001").collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
