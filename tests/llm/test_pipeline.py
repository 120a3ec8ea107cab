"""The whole pipeline against a plain Python version of every stage, and the guard."""

import hashlib
import itertools
import re

import pytest

import corpus_pipeline
from odgraph.llm import curriculum, decontaminate, langid, linededup, simhash
from tests.llm.helpers import SF001
from tests.llm.test_kernels import _fill, _union
from tests.llm.test_linededup import _brute as brute_lines


def _mix(docs):
    sized = [(d.doc_id, d.source, len(d.text.encode().split())) for d in docs]
    names = sorted({s for _, s, _ in sized})
    sizes = [sum(n for _, s, n in sized if s == name) for name in names]
    targets = _fill(sizes, [curriculum.WEIGHTS[i % 3] for i in range(len(names))], curriculum.SHARE, curriculum.MOST)
    out = []
    for i, (name, whole, target) in enumerate(zip(names, sizes, targets)):
        slope = curriculum.SLOPES[i % 3]
        stream = sorted((hashlib.md5(str(d).encode()).hexdigest(), d, n) for d, s, n in sized if s == name)
        at, goal = 0, round(target)
        for epoch in range(3):
            for _, doc, n in stream:
                words = min(n, goal - at)
                if words > 0:
                    y = at / target
                    b = 1 - slope
                    t = 2 * y / (b + (b * b + 4 * slope * y) ** 0.5)
                    out.append((doc, name, n, epoch, words, round(t, 9), round(target, 6)))
                at += n
    return sorted(out)


def test_every_stage_equals_its_direct_computation(spark):
    docs = sorted(spark.read.parquet(f"{SF001}/documents.parquet").collect())
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "near_dedup", "decontamination", "mixing"]
    stage = dict(corpus_pipeline.STAGES)

    def run(name, frame):
        got = stage[name](spark, frame, SF001)
        assert got.columns == df.columns
        return sorted(got.collect())

    def frame(rows):
        return spark.createDataFrame(rows, df.schema)

    found = langid.train(df).predict([d.text for d in docs])
    kept = [d for d, (lang, score) in zip(docs, found) if lang != "und" and (score >= 0.02 or len(d.text) < 200)]
    assert run("language_id", df) == kept and len(kept) >= 0.95 * len(docs)

    lines = {r[0]: r for r in brute_lines([(d.doc_id, d.text) for d in kept], linededup.MIN_DOCS, linededup.SIMILARITY)}
    cut = [d if not lines[d.doc_id][3] else type(d)(**{**d.asDict(), "text": lines[d.doc_id][1],
                                                       "n_chars": len(lines[d.doc_id][1])}) for d in kept]
    cut = sorted(d for d in cut if not lines[d.doc_id][3] or re.search(r"[^\x20\x09-\x0D]", d.text))
    assert run("line_dedup", frame(kept)) == cut

    prints = {d.doc_id: simhash.fingerprint(d.text.encode()) for d in cut}
    groups = _union([(a, b) for a, b in itertools.combinations(prints, 2)
                     if (prints[a] ^ prints[b]).bit_count() <= 3], prints)
    single = [d for d in cut if groups[d.doc_id] == d.doc_id]
    assert run("near_dedup", frame(cut)) == single and len(single) < len(cut)

    bench = spark.read.parquet(f"{SF001}/benchmark.parquet").collect()
    grams = {tuple(w[i:i + 10]) for b in bench for w in [decontaminate.words_of(b.text.encode())]
             for i in range(max(len(w) - 9, 1))}
    clean = run("decontamination", frame(single))
    left = {d.doc_id: d for d in clean}
    for d in single:
        w = decontaminate.words_of(d.text.encode())
        hit = {k for i in range(len(w)) for n in {len(g) for g in grams} if tuple(w[i:i + n]) in grams for k in range(i, i + n)}
        if len(hit) > 0.5 * len(w):
            assert d.doc_id not in left
        elif not hit:
            assert left[d.doc_id] == d
        else:
            assert decontaminate.words_of(left[d.doc_id].text.encode()) == [x for k, x in enumerate(w) if k not in hit]
            assert left[d.doc_id].n_chars == len(left[d.doc_id].text)

    mixed = corpus_pipeline.mixing(spark, frame(clean), SF001).collect()
    got = sorted((r.doc_id, r.source, r.size, r.epoch, r.words, round(r.position, 9), round(r.target, 6)) for r in mixed)
    want = _mix(clean)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(g[5:] == pytest.approx(w[5:], abs=1e-6) for g, w in zip(got, want))

    whole = corpus_pipeline.run(spark, SF001).collect()
    assert sorted(tuple(r) for r in whole) == sorted(tuple(r) for r in mixed)


def test_stages_take_nulls_repeats_and_an_empty_table(spark):
    schema = spark.read.parquet(f"{SF001}/documents.parquet").schema
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, "the cat sat on the mat", "en", None, 22),
            (2, "the cat sat on the mat", "en", None, 22), (3, "der hund und die katze", "de", "a", 22), (4, "!!", None, "b", 2)]
    for data in (rows, []):
        df = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, SF001)
            assert out.count() <= 2 * len(data), name
            if name != "mixing":
                assert out.columns == df.columns


def test_driver_reads_are_the_bounded_ones():
    """Every read into the driver in the subpackage is one of these."""
    import pathlib

    root = pathlib.Path(simhash.__file__).parent
    reads = {f.name: len(re.findall(r"\.collect\(\)|toPandas\(", f.read_text())) for f in root.glob("*.py")}
    assert {k: n for k, n in reads.items() if n} == {
        "decontaminate.py": 1,  # one block of the benchmark, MAX_WORDS at most
        "embeddings.py": 1,     # the sample that rotations are learned on, SAMPLE vectors
        "langid.py": 1,         # training samples, TRAIN_DOCS * MAX_LANGUAGES texts
        "ngram.py": 2,          # one row of totals a shard, one row a block of words
        "whitening.py": 2,      # sums by place (dims ** 2 at most), and by component
    }
    assert not [f for f in root.glob("*.py") if "localCheckpoint" in f.read_text()]


def test_nothing_else_imports_the_subpackage():
    import pathlib

    top = pathlib.Path(simhash.__file__).parents[2]
    users = [f.name for f in top.rglob("*.py") if "llm" not in f.parts and re.search(r"odgraph\.llm|corpus_pipeline", f.read_text())]
    assert sorted(users) == ["__spark_entry__.py", "corpus_pipeline.py"]
