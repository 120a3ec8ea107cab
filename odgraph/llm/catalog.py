"""Registered queries of the corpus operators and their DuckDB SQL.

Each query applies one operator with production parameters to its whole
table and derives the digest columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odgraph.llm import curriculum, decontaminate, embeddings, htmltext, langid, licenses, linededup, ngram, periodicruns, piecebpe, simhash, urlfilter, whitening
from odgraph.llm.common import WORD, cut, table

URL_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def held_out(id_col: str, modulus: int):
    """The documents whose crc32(id as text) leaves 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(modulus)) == 2, F.lit(False))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents: 3-word shingles, 3 bits."""
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of vectors with cosine of at least 0.9."""
    return embeddings.embedding_groups(table(spark, sf_dir, "embeddings"))


def document_paths(docs: DataFrame) -> DataFrame:
    """``documents`` as files: ``source/lang/hundreds/doc_id``."""
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 100).cast("string"), F.col("doc_id").cast("string"))
    return docs.select("doc_id", path.alias("path"), "text")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License of every document: its own, or that of the nearest directory in
    which a document opens with a license statement (the table names no files)."""
    files = document_paths(table(spark, sf_dir, "documents"))
    found = licenses.scan_licenses(files, openers_declare=True)
    return found.select(F.substring_index("path", "/", -1).cast("long").alias("doc_id"), "path", "own_license",
                        "own_score", "license", "inherited_from")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url."""
    return urlfilter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~held_out("doc_id", 4)))
    return langid.identify(docs, model, carry=(held_out("doc_id", 4).alias("held_out"),))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of recurring templates."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs)


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under a Kneser-Ney model of those not held out."""
    docs = table(spark, sf_dir, "documents")
    model = ngram.train(docs.where(~held_out("doc_id", 7)))
    return ngram.score(docs, model, carry=(held_out("doc_id", 7).alias("held_out"),)).drop("perplexity")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the training sequence reads of every document, summed over its passes."""
    placed = cut(curriculum.assign(table(spark, sf_dir, "documents")), "mix-rows")
    # written in training order: a sort that only feeds a sum would be dropped from the plan
    order = cut(curriculum.sequence(placed), "mix-sequence")
    read = order.groupBy("row").agg(F.sum("words").alias("taken"))
    return placed.drop("taken").join(read, "row", "left").select(
        F.col("id").alias("doc_id"), "size", "source_size", F.round("target", 6).alias("target"),
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and the text that they decode to."""
    vocabulary = piecebpe.Vocabulary.read(tokenizer_path("piece_bpe_32k.model"))
    encoded = piecebpe.encode(table(spark, sf_dir, "documents"), vocabulary)
    return piecebpe.decode(encoded, vocabulary).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the four leading components of the covariance, whitened."""
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


def repeated_texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; in the texts that the contract names, the words
    from word a on repeat with period p."""
    words = F.regexp_extract_all(F.col("text"), F.lit(f"({WORD})"))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(w):
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        rest = F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(w, 1, a), F.slice(rest, 1, n - a)), " ")

    # one lambda over a single element, so that the words are taken once
    text = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)))[0]
    return docs.select("doc_id", F.when(h % 10 == 0, text).otherwise(F.col("text")).alias("text"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in every document, and the text without the repeats."""
    found = periodicruns.find_runs(repeated_texts(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                               r["period"].cast("string")), F.lit("\n")))
    best = found.withColumn("best", longest)
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_embedding": op2_embedding,
    "op3_license_scan": op3_license_scan,
    "op4_url_filter": op4_url_filter,
    "op5_language_id": op5_language_id,
    "op6_line_dedup": op6_line_dedup,
    "op7_lm_score": op7_lm_score,
    "op8_mixing": op8_mixing,
    "op9_html_text": op9_html_text,
    "op10_decontaminate": op10_decontaminate,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_whitening": op12_whitening,
    "op13_runs": op13_runs,
}
