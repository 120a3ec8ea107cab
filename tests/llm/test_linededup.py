"""Line dedup against a direct computation of templates."""

import random
from collections import defaultdict

import pytest

from odgraph.llm import linededup


def _mask(line):
    tokens = line.encode().split()
    return " ".join("<*>" if any(48 <= b < 58 for b in t) else t.decode() for t in tokens)


def _brute(docs, min_docs, similarity):
    owners = defaultdict(set)
    for r, (_, text) in enumerate(docs):
        for line in (text or "").split("\n"):
            if _mask(line):
                owners[_mask(line)].add(r)
    lines = sorted(owners)
    parent = {x: x for x in lines}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in lines:
        for b in lines:
            s, t = a.split(" "), b.split(" ")
            if a < b and len(s) == len(t) and s[:3] == t[:3] and sum(x != y for x, y in zip(s, t)) <= linededup.differing(
                    len(s), similarity):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    groups = defaultdict(list)
    for x in lines:
        groups[find(x)].append(x)
    first = {}
    for members in groups.values():
        ids = [docs[r][0] for x in members for r in owners[x] if docs[r][0] is not None]
        need = linededup.LONG_DOCS if len(members[0].split(" ")) >= linededup.LONG_WORDS else min_docs
        if sum(len(owners[x]) for x in members) >= need and ids and min(ids) != max(ids):
            first |= {x: min(ids) for x in members}
    out = []
    for doc_id, text in docs:
        parts = [] if text is None else text.split("\n")
        kept = [x for x in parts if _mask(x) not in first or first[_mask(x)] == doc_id]
        out.append((doc_id, None if text is None else "\n".join(kept), len(parts), len(parts) - len(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [512, 12])
def test_dedup_equals_direct_computation(spark, limit):
    rng = random.Random(6)
    words = "alpha beta gamma delta epsilon zeta".split()
    heads = ["user logged in", "the quick brown", "alpha beta gamma"]
    docs = []
    for i in range(90):
        lines = []
        for _ in range(rng.randrange(0, 6)):
            lines.append(" ".join([rng.choice(heads), *(rng.choice(words) for _ in range(rng.choice([0, 1, 7, 12])))]))
            if rng.random() < 0.3:
                lines.append(f"at 10:{i:02d}  the job\t{rng.randrange(99)} ended")
            if rng.random() < 0.2:
                lines.append(rng.choice(["", "  ", "Ünique line x%d" % i]))
        docs.append((i // 2 * 2 if i > 80 else i, "\n".join(lines)))
    docs += [(200, None), (201, ""), (None, docs[0][1]), (None, "user logged in"), docs[3]]
    df = spark.createDataFrame([(*d, 5) for d in docs], "doc_id long, text string, n_lines int")
    got = linededup.dedup_lines(df, min_docs=4, limit=limit)
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == _brute(docs, 4, linededup.SIMILARITY)


def test_documents_of_boilerplate_alone_go(spark):
    line = "this very page is served by host 12 of our cluster today"
    rows = [(i, f"{line}\nown words of {chr(97 + i)}" if i < 5 else line, 9) for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = {r.doc_id: r for r in linededup.without_boilerplate(df).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4]
    assert got[0].text == rows[0][1] and got[0].n_chars == 9
    assert got[1].text == "own words of b" and got[1].n_chars == 14
    assert linededup.without_boilerplate(df.where("false")).count() == 0


@pytest.mark.parametrize("limit", [30])
def test_crowds_of_variants(spark, limit):
    """Two dense crowds in one leaf, a bridge between them, and lines of no crowd."""
    rng = random.Random(12)
    a = ["to", "all", "who"] + [f"a{chr(97 + i)}" for i in range(22)]
    b = ["to", "all", "who"] + [f"b{chr(97 + i)}" for i in range(22)]
    bridge = [a[:3 + 22 - k] + b[3 + 22 - k:] for k in range(0, 23, 5)] + [b]
    far = [["to", "all", "who"] + [f"{chr(97 + k)}{chr(97 + i)}x" for i in range(22)] for k in range(40)]
    lines = set()
    for base in (a, b):
        for _ in range(60):
            x = list(base)
            for i in rng.sample(range(3, 25), rng.choice([1, 2, 3, 7])):
                x[i] = "v" + "".join(rng.choice("abcdef") for _ in range(4))
            lines.add(" ".join(x))
    for bridged in (True,):
        pool = sorted(lines | {" ".join(x) for x in far} | ({" ".join(x) for x in bridge} if bridged else set()))
        docs = [(i, "\n".join(rng.sample(pool, 3))) for i in range(150)]
        df = spark.createDataFrame(docs, "doc_id long, text string")
        got = linededup.dedup_lines(df, min_docs=20, limit=limit)
        assert sorted((tuple(r) for r in got.collect()), key=str) == _brute(docs, 20, linededup.SIMILARITY)
