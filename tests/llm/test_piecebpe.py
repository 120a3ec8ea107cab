"""Encoding and decoding against the sentencepiece library."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from odgraph.llm import piecebpe
from odgraph.llm.catalog import QUERIES, tokenizer_path
from tests.llm.helpers import SF001

PATH = tokenizer_path("piece_bpe_32k.model")
PARTS = ["a", "b", "the", "ing", " ", "  ", "    ", "\n", "\t", "\0", "▁", "é", "ß", "́", "梦", "한", "\U0001f600",
         "�", "0", "12", "<s>", "</s>", "<0x0A>", "http://", "=====", "e" * 9]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return piecebpe.Vocabulary.read(PATH)


def test_encoding_equals_the_library(library, vocabulary):
    encoder = piecebpe.Encoder(vocabulary)
    rng = random.Random(11)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 50))) for _ in range(3000)]
    texts += ["", " ", "▁", " " * 70_000 + "x", "ab" * 40_000, "梦" * 5_000, "".join(rng.choice("etaoins") for _ in range(90_000))]
    want = library.encode(texts, num_threads=1)
    for _ in range(2):  # new and remembered cuts
        ids, number = encoder.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(number)[:-1])] == want


def test_backtracking_gives_up_positions(vocabulary):
    """Greedy longest matches alone differ from merging for some text."""
    encoder = piecebpe.Encoder(vocabulary)
    rng = random.Random(3)
    greedy = 0
    for _ in range(500):
        text = "".join(rng.choice("aeinrst") for _ in range(12))
        longest = encoder.find.longest(encoder.find.letter[list(map(ord, text))], np.array([0]), np.array([12]), 12)
        path = [encoder.texts[k] for k in encoder.one(longest, 0, 12)[1]]
        beside = encoder.covered(longest, np.array([0]), np.array([12]))
        assert [encoder.texts[k] for k in beside if k >= 0] == path
        assert path == encoder.merged(text)
        greedy += any(text.startswith(longer, at) for at, p in zip(_starts(path), path)
                      for longer in encoder.texts if len(longer) > len(p))
    assert greedy


def _starts(path):
    at = 0
    for p in path:
        yield at
        at += len(p)


def test_decoding_equals_the_library(library, vocabulary):
    decoder = piecebpe.Decoder(vocabulary)
    rng = random.Random(5)
    for _ in range(5000):
        ids = [rng.randrange(32_000) if rng.random() < 0.5 else rng.randrange(300) for _ in range(rng.randint(0, 12))]
        assert decoder.decode(ids) == library.decode(ids)
    assert decoder.decode([99_999]) == vocabulary.unknown


def test_models_of_other_kinds_are_refused():
    with pytest.raises(ValueError):
        piecebpe.Vocabulary(b"")


def test_query_equals_the_library(spark, library):
    want = {}
    for r in spark.read.parquet(f"{SF001}/documents.parquet").collect():
        ids = library.encode(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256(library.decode(ids).encode()).hexdigest())
    got = QUERIES["op11_sentencepiece"](spark, SF001).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want


def test_edge_rows(spark, library, vocabulary):
    rows = [(None, None, "x"), (1, "", "y"), (1, "", "y"), (2, "two words", None), (3, " " * 9, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").withColumn("decoded", F.lit(1))
    bad = spark.sql("select 4L as doc_id, cast(x'61ff62' as string) as text, 'a' as ids, 1 as decoded")
    got = piecebpe.decode(piecebpe.encode(docs.unionAll(bad), vocabulary), vocabulary).collect()
    assert sorted(((r.doc_id or 0), r.ids, r.decoded) for r in got) == [
        (0, [], ""), (1, [], ""), (1, [], ""), (2, library.encode("two words"), "two words"),
        (3, library.encode(" " * 9), " " * 9), (4, library.encode("a�b"), "a�b")]
    assert piecebpe.decode(piecebpe.encode(docs.limit(0), vocabulary), vocabulary).collect() == []
    loose = spark.createDataFrame([(1, None), (2, []), (3, [None, 5])], "decoded int, ids array<int>")
    assert [r.decoded for r in piecebpe.decode(loose, vocabulary).collect()] == [None, "", vocabulary.unknown + "\x02"]


def test_cuts_that_come_often_stay_in_a_full_memo(library, vocabulary, monkeypatch):
    monkeypatch.setattr(piecebpe, "MEMO", 16)
    encoder = piecebpe.Encoder(vocabulary)
    texts = [" ".join(f"w{i}" for i in range(30)) + " the and the  and and", " ▁ two▁ parts  "]
    want = library.encode(texts, num_threads=1)
    for _ in range(3):
        ids, number = encoder.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(number)[:-1])] == want
        assert {" the", " and"} <= set(encoder.memo) and len(encoder.memo) <= 8
