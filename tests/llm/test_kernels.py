"""Brute-force checks of SimHash, URL filter, language ID, mixing and decontamination."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from odgraph.llm import components, curriculum, decontaminate, langid, simhash, urlfilter


def _union(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(i, i + 1) for i in range(1000, 1030)] + [(5, 5), (5, None)]  # a long chain
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r.node: r.component for r in components.connected_components(df).collect()}
    real = [e for e in edges if None not in e]
    assert got == _union(real, {n for e in real for n in e})
    empty = spark.createDataFrame([], "src long, dst long")
    assert components.connected_components(empty).count() == 0


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_cover_every_pair_in_the_radius(radius):
    masks = simhash.masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    rng = random.Random(radius)
    for _ in range(3000):
        diff = sum(1 << b for b in rng.sample(range(64), radius))
        assert any((m & ((1 << 64) - 1)) & diff == 0 for m in masks)


def test_fingerprint_is_the_majority_of_shingle_hashes(spark):
    import xxhash

    text = "The quick BROWN fox\tjumps over the lazy dog the quick brown fox Ärger\n"
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text.encode()) == want
    # the hash is Spark's xxhash64
    from pyspark.sql import functions as F
    row = spark.range(1).select(F.xxhash64(F.lit(shingles[0].decode())).alias("h")).first()
    assert row.h % (1 << 64) == hashes[0]
    assert simhash.fingerprint(None) == simhash.fingerprint(b" \n ") == 0
    assert simhash.fingerprint(b"One two") == xxhash.xxh64_intdigest(b"one two", 42)


@pytest.mark.parametrize("limit", [2048, 40])
def test_near_links_equal_all_pairs(spark, limit):
    rng = random.Random(11)
    base = [rng.getrandbits(64) for _ in range(60)]
    values = set(base)
    for b in base[:20]:
        for _ in range(6):
            for bit in rng.sample(range(64), rng.randrange(1, 6)):
                b ^= 1 << bit
            values.add(b)
    dense = rng.getrandbits(64)  # a crowd in which every bucket is oversized
    values |= {dense ^ 1 << i for i in range(64)}
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    edges = simhash.near_links(df, 3, limit)
    rows = edges.collect()
    got = _union([(r.src, r.dst) for r in rows], signed)
    want = _union([(a, b) for a, b in itertools.combinations(signed, 2)
                   if bin((a ^ b) & (1 << 64) - 1).count("1") <= 3], signed)
    assert got == want
    assert len(rows) < 225 * len(signed)


def test_simhash_groups_with_nulls_copies_and_clashing_columns(spark):
    long = " ".join(f"word{i}" for i in range(400))
    rows = [(5, long, 1), (3, long.upper(), 2), (9, long + " tail", 3), (7, "other words entirely here", 4),
            (8, None, 5), (2, "", 6), (None, long, 7), (7, "other words entirely here", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp long")
    got = sorted((r.doc_id is None, r.doc_id, r.component_id) for r in simhash.simhash_groups(df).collect()
                 if r.doc_id is not None)
    near = bin(simhash.fingerprint(long.encode()) ^ simhash.fingerprint((long + " tail").encode())).count("1") <= 3
    nine = 3 if near else 9
    assert got == [(False, 2, 2), (False, 3, 3), (False, 5, 3), (False, 7, 7), (False, 7, 7), (False, 8, 2), (False, 9, nine)]
    kept = sorted(r.doc_id for r in simhash.simhash_dedup(df).collect())
    assert kept == [2, 3, 7] + ([] if near else [9])
    a, b = "one two three four five six", "quite other words in this one here"
    twice = [(3, a, "x"), (5, a, "y"), (5, b, "z"), (7, b, "w"), (7, b, "w"), (None, a, "n"), (None, "alone is this text", "n")]
    again = spark.createDataFrame(twice, "doc_id long, text string, _id string")
    assert sorted((r.doc_id or 0, r.text, r._id) for r in simhash.simhash_dedup(again).collect()) == [
        (0, "alone is this text", "n"), (3, a, "x"), (5, b, "z")]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_groups(empty).count() == simhash.simhash_dedup(empty).count() == 0


RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"), ("block", "a.b.org", "/fr"), ("allow", "b.org", "/fr/x/y/"))


def _brute(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    for c in "?#":
        rest = rest.split(c, 1)[0]
    host, slash, path = rest.partition("/")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = slash + path
    fits = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    if not fits:
        return host, path, None, "allow"
    best = max(fits, key=lambda r: (r[1].count("."), len(r[2])))
    return host, path, best[1] + best[2], best[0]


def test_url_verdicts_equal_brute_force(spark):
    urls = ["http://x.example.net/en/1", "https://EXAMPLE.net/en", "http://net", "http://net/", "http://anet/q",
            "http://a.net?x=/en/", "https://a.example.com/de/9#t", "x://example.com/den/", None, "", "no scheme/net/",
            "http://b.org/fr/x/y/z", "http://q.a.b.org/fr/x/y/z", "http://q.a.b.org/french", "http://b.org/fr/x/y",
            "a://b://c.net/", "http://x.NET./", "http:///fr/", "http://Ä.org/fr/?", "http://a.b.org/fr"]
    df = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge_urls(df, RULES).collect()}
    assert got == {i: _brute(u) for i, u in enumerate(urls)}
    kept = {r.page_id for r in urlfilter.filter_urls(df, RULES).collect()}
    assert kept == {i for i, u in enumerate(urls) if _brute(u)[3] == "allow"}


def _phrases(sample, text):
    count = 0
    for at in range(0, len(text), langid.BLOCK):
        block = text[at:at + langid.BLOCK]
        i = 0
        while i < len(block):
            n = 1
            while i + n <= len(block) and block[i:i + n] in sample:
                n += 1
            i += max(n - 1, 1)
            count += 1
    return count


def test_cross_parsing_equals_longest_matches(spark):
    samples = {"aa": langid.fold("the cat sat on the mat and the hat " * 3),
               "bb": langid.fold("der Hund und die Katze über Stock und Stein " * 3)}
    model = langid.Model(samples)
    texts = ["the hat of a cat", "Über den HUND!", None, "123 --", "x", "q" * 1500 + " und die katze",
             "the cat und die katze " * 300, ""]
    for text, (lang, score) in zip(texts, model.predict(texts)):
        if text is None or not any(c.isalpha() for c in text):
            assert (lang, score) == ("und", 0.0)
            continue
        counts = {k: _phrases(v, langid.fold(text)) for k, v in samples.items()}
        assert lang == min(counts, key=lambda k: (counts[k], k))
        assert score == pytest.approx(1 - min(counts.values()) / max(counts.values()))


def test_language_of_held_out_documents(spark):
    from odgraph.llm.catalog import op5_language_id
    from tests.llm.helpers import SF001

    rows = op5_language_id(spark, SF001).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(docs) and held
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_id_edge_cases(spark):
    df = spark.createDataFrame([(1, "the cat", "en", 0.5), (None, None, None, None), (2, "42", "en", 1.0),
                                (1, "the cat", "en", 0.5)], "doc_id long, text string, lang string, score double")
    model = langid.train(df)
    got = sorted((r.doc_id or 0, r.lang_pred) for r in langid.identify(df, model).collect())
    assert got == [(0, "und"), (1, "en"), (1, "en"), (2, "und")]
    assert langid.keep_identified(df, model).columns == df.columns
    none = langid.train(df.where("false"))
    assert {r.lang_pred for r in langid.identify(df, none).collect()} == {"und"}
    signs = spark.createDataFrame([(1, "\u00bd \u00b2"), (2, "\u2167"), (3, "\u00bd a")], "doc_id long, text string")
    assert [r.lang_pred for r in langid.identify(signs, model).orderBy("doc_id").collect()] == ["und", "und", "en"]
    clash = df.withColumn("lang_pred", F.lit("x")).withColumn("_text", F.lit("y"))
    assert sorted(map(tuple, langid.keep_identified(clash, model).collect())) == [(1, "the cat", "en", 0.5, "x", "y")] * 2
    bad = spark.sql("select 1L as doc_id, cast(x'74686520ff636174' as string) as text")
    assert langid.identify(bad, model).first().lang_pred == "en"
    # a language whose texts are all long is learned from windows of them
    long = spark.createDataFrame([(7, "wort an wort " * 2000, "de"), (8, "the cat", "en")], "doc_id long, text string, lang string")
    assert sorted(langid.train(long).samples) == ["de", "en"]
    assert langid.train(long).predict(["wort an wort"])[0][0] == "de"
    assert langid.identify(df.where("false"), model).count() == 0


def _fill(sizes, weights, share, most):
    total = share * sum(sizes)
    full = set()
    while True:
        left = total - sum(most * sizes[i] for i in full)
        w = sum(weights[i] for i in range(len(sizes)) if i not in full)
        target = [most * s if i in full else (left * weights[i] / w if w else 0) for i, s in enumerate(sizes)]
        over = {i for i in range(len(sizes)) if i not in full and target[i] >= most * sizes[i]}
        if not over:
            return target
        full |= over


def test_targets_equal_repeated_sharing(spark):
    rng = random.Random(5)
    for n in (1, 2, 3, 7, 20):
        sizes = [rng.choice([0, 1, 10, 1000, rng.randrange(5000)]) for _ in range(n)]
        df = spark.createDataFrame([(f"s{i:02d}" if i < n - 1 else None, s) for i, s in enumerate(sizes)],
                                   "source string, source_size long")
        got = {r.source: r.target for r in curriculum.source_targets(df).collect()}
        want = _fill(sizes, [(5.0, 2.0, 1.0)[i % 3] for i in range(n)], 1.5, 2.0)
        for i in range(n):
            assert got[f"s{i:02d}" if i < n - 1 else None] == pytest.approx(want[i], abs=1e-6)


def test_mix_positions_follow_the_demand(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 60)), rng.choice(["a", "a", "a", "b", None])) for i in range(400)]
    rows += [(None, None, "b"), (3, rows[3][1], rows[3][2])]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    each = curriculum.assign(df).collect()
    assert len(each) == len(rows)
    for source in ("a", "b", None):
        mine = [r for r in each if r.source == source]
        assert sum(r.taken for r in mine) == round(mine[0].target)
        assert all(0 <= r.taken <= 2 * r.size for r in mine)
    passes = curriculum.positions(curriculum.assign(df)).collect()
    for r in passes:
        t, y = r.position, (r.epoch * r.source_size + r.start) / r.target
        assert 0 <= t <= 1 and t + r.slope * (t * t - t) == pytest.approx(y, abs=1e-9)
    got = curriculum.mix(df).collect()
    assert [r.position for r in got] == sorted(r.position for r in got)
    assert sum(r.words for r in got) == sum(r.taken for r in each)
    assert curriculum.mix(df.where("false")).count() == 0


def test_decontamination_equals_brute_force_in_one_and_many_blocks(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(12)] + ["Äx", "b2"]
    bench = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 4, 12, 14])))) for i in range(12)]
    bench += [(None, " ".join(words)), (3, "a b c d e f g h i j k"), (20, None)]
    docs = [(i, ", ".join(rng.choice(words) for _ in range(rng.randrange(0, 80)))) for i in range(80)]
    docs += [(100, "x " * 5 + bench[-3][1].upper() + "! y y y y y y y y y y y y y y"), (101, None), (102, ""), (100, "A-b/c")]
    docs_df = spark.createDataFrame([(*d, "q", 7) for d in docs], "doc_id long, text string, items string, n_chars long")
    bench_df = spark.createDataFrame(bench, "item_id long, text string")

    def tokens(t):
        return decontaminate.words_of((t or "").encode())

    want = []
    for doc_id, text in docs:
        w = tokens(text)
        hit, items = set(), set()
        for item, body in bench:
            b = tokens(body)
            n = min(10, len(b))
            grams = {tuple(b[i:i + n]) for i in range(len(b) - n + 1)} if b else set()
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in grams:
                    hit |= set(range(i, i + n))
                    items.add("null" if item is None else str(item))
        want.append((doc_id, len(w), len(hit), sorted(items)))
    for limit in (2_000_000, 20):
        got = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in
               decontaminate.scan(docs_df, bench_df, max_words=limit).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    only = spark.createDataFrame(bench[-3:], "item_id long, text string")
    kept = decontaminate.decontaminate(docs_df, only)
    assert kept.columns == docs_df.columns
    row = {r.doc_id: r for r in kept.collect() if r.doc_id == 100 and "y" in r.text}[100]
    assert row.text.startswith("x x x x x ! y") and row.n_chars == len(row.text)
    assert decontaminate.scan(docs_df, bench_df.where("false")).where("n_hit > 0").count() == 0
