"""What language ID sends to Python."""

from pyspark.sql import functions as F

from odgraph.llm import langid


def test_language_stage_sends_each_text_to_python_once(spark):
    """The text of a row travels within the row; rows come out as they went in."""
    en, de = "the cat sat on the mat and then it ran away from the dog ", "der hund lief schnell durch den wald und dann nach hause "
    rows = [(i, t, f"s{i}", lang) for i, (t, lang) in enumerate([(en * 6, "en"), (de * 6, "de"), (None, "en"), ("12 34", None), (en, None), (de * 9, None)])]
    docs = spark.createDataFrame(rows + rows[:1], "doc_id long, text string, `a.b` string, lang string").coalesce(1)
    model = langid.train(docs)
    kept = langid.keep_identified(docs, model)
    assert "_text" not in kept._jdf.queryExecution().optimizedPlan().toString()
    judged = model.predict([r[1] for r in rows])
    want = [r for r, (name, score) in zip(rows, judged) if name != "und" and (score >= 0.02 or len(r[1]) < 200)]
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == sorted(want + rows[:1]) and len(want) == 4
    # a text column of another type is read as a string
    data = docs.withColumn("text", F.col("text").cast("binary"))
    assert sorted((r.doc_id, bytes(r.text).decode()) for r in langid.keep_identified(data, model).collect()) == sorted((r[0], r[1]) for r in want + rows[:1])
