"""Strings whose bytes are not UTF-8, and clashing columns, in operators that read texts."""

from pyspark.sql import functions as F

from odgraph.llm import decontaminate, linededup, urlfilter

BAD = "cast(concat(cast({} as binary), X'FF', cast({} as binary)) as string)"


def test_urls(spark):
    df = spark.range(2).selectExpr("id as page_id", BAD.format("'http://a.net/'", "'x'") + " url")
    rows = urlfilter.judge_urls(df, [("block", "net", "/")]).collect()
    assert [(r.host, r.path, r.verdict) for r in rows] == [("a.net", "/\ufffdx", "block")] * 2
    assert urlfilter.filter_urls(df, [("block", "net", "/")]).count() == 0


def test_longest_begun_segment_wins():
    trie = urlfilter.RuleTrie([("block", "a.b", "/x"), ("allow", "a.b", "/xyz"), ("block", "a.b", "/xyz/"), ("allow", "a.b", "/")])
    got = [trie.match("a.b", p) for p in ("/", "/xy", "/xyzz", "/xyz/q", "/q", "")]
    assert got == [("a.b/", "allow"), ("a.b/x", "block"), ("a.b/xyz", "allow"), ("a.b/xyz/", "block"), ("a.b/", "allow"), None]


def test_lines_and_clashing_columns(spark):
    df = spark.range(7).selectExpr("id as doc_id", BAD.format("concat('own line number ', chr(cast(97 + id as int)), '\nshared line ')", "' of all'") + " text",
                                   "id as _gone", "1 as `_id`", "2 as key", "3 as row", "4 as `_key`")
    got = {r.doc_id: r for r in linededup.dedup_lines(df, similarity=1.0).collect()}
    assert len(got) == 7 and got[0].text.endswith("\nshared line \ufffd of all") and got[0].n_dropped == 0
    assert all(got[i].text == f"own line number {chr(97 + i)}" and got[i]["_gone"] == i and got[i].row == 3 for i in range(1, 7))
    assert linededup.without_boilerplate(df, similarity=1.0).columns == df.columns


def test_benchmark_passages(spark):
    words = " ".join(f"w{i}" for i in range(10))
    bench = spark.range(1).select(F.lit("q").alias("item_id"), F.lit(words).alias("text"))
    df = spark.range(1).selectExpr("id as doc_id", BAD.format("'before " + " ".join(f"b{i}" for i in range(20)) + " '", f"' {words} after'") + " text")
    row = decontaminate.scan(df, bench).first()
    assert (row.n_words, row.n_hit, row["items"]) == (33, 10, ["q"])
    text = decontaminate.decontaminate(df, bench).first().text
    assert text.startswith("before b0") and text.endswith("b19 \ufffd after")
