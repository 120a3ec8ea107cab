"""The registered mixing query sums the training sequence itself."""

from odgraph.llm import curriculum
from odgraph.llm.catalog import QUERIES


def test_query_sums_the_scheduled_passes(spark, tmp_path, monkeypatch):
    rows = [(i % 50, " ".join(["w"] * (i % 23)), "abc"[i % 3]) for i in range(120)] + [(None, None, "b"), (7, "w w", None)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    want = sorted(((r.id, r.size, r.source_size, round(r.target, 6), r.taken) for r in curriculum.assign(docs).collect()), key=str)
    assert len(want) == len(rows) and any(w[4] == 0 < w[1] for w in want) and any(w[4] > w[1] for w in want)
    plain, seen = curriculum.positions, []

    def recorded(assigned):
        seen.append(plain(assigned))
        return seen[-1]

    monkeypatch.setattr(curriculum, "positions", recorded)
    got = QUERIES["op8_mixing"](spark, str(tmp_path))
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert len(seen) == 1 and seen[0].agg({"words": "sum"}).first()[0] == sum(w[4] for w in want)
    assert all(0 <= r.position <= 1 for r in seen[0].collect())


def test_query_writes_the_passes_in_training_order(spark, tmp_path, monkeypatch):
    from odgraph.llm import catalog

    written = {}
    plain = catalog.cut

    def kept(df, name):
        written[name] = plain(df, name)
        return written[name]

    rows = [(i, " ".join(["w"] * (1 + i % 23)), "abc"[i % 3]) for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(catalog, "cut", kept)
    assert catalog.QUERIES["op8_mixing"](spark, str(tmp_path)).count() == len(rows)
    parts = {}
    for path, position in written["mix-sequence"].selectExpr("_metadata.file_name", "position").collect():
        parts.setdefault(path, []).append(position)
    each = [parts[k] for k in sorted(parts)]
    assert [p for part in each for p in part] == sorted(p for part in each for p in part)
