"""Contract columns and brute-force checks of the registered queries."""

import itertools
import zlib

from odgraph.llm import simhash
from odgraph.llm.catalog import QUERIES
from tests.llm.helpers import SF001
from tests.llm.test_kernels import _union

COLUMNS = {
    "op1_simhash": {"doc_id", "fingerprint", "component_id"},
    "op2_embedding": {"vec_id", "n_links", "component_id", "kept"},
    "op4_url_filter": {"page_id", "host", "path", "rule", "verdict"},
    "op5_language_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op7_lm_score": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op8_mixing": {"doc_id", "size", "source_size", "target", "taken"},
    "op9_html_text": {"page_id", "url", "text", "n_chars"},
    "op10_decontaminate": {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
    "op11_sentencepiece": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op12_whitening": {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"},
    "op13_runs": {"doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"},
}


def test_one_query_for_each_operator():
    import __spark_entry__ as entry

    assert [n for n in range(1, 14) if sum(k.startswith(f"op{n}_") for k in QUERIES) != 1] == []
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


def test_queries_return_the_columns_of_their_contract(spark):
    for name, want in COLUMNS.items():
        assert want <= set(QUERIES[name](spark, SF001).columns), name


def test_simhash_query_equals_all_pairs(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    prints = {d: simhash.fingerprint(t.encode()) for d, t in docs.items()}
    want = _union([(a, b) for a, b in itertools.combinations(sorted(prints), 2)
                   if (prints[a] ^ prints[b]).bit_count() <= 3], sorted(prints))
    got = QUERIES["op1_simhash"](spark, SF001).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
        d: (f"{prints[d]:016x}", want[d]) for d in docs}


def test_held_out_rows(spark):
    for name, modulus in (("op5_language_id", 4), ("op7_lm_score", 7)):
        for r in QUERIES[name](spark, SF001).select("doc_id", "held_out").collect():
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == 2)
