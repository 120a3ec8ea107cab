"""License scan against direct cosines and a direct walk up the directories."""

import math
from collections import Counter

import pytest

from odgraph.llm import licenses


def _best(line, threshold=licenses.THRESHOLD):
    w = licenses.Weights()
    bag = Counter(licenses.words_of(line))
    x = {t: n * w.idf.get(t, w.unknown) for t, n in bag.items()}
    norm = math.sqrt(sum(v * v for v in x.values()))
    scores = [(round(sum(x.get(t, 0) * y for t, y in v.items()) / norm, 6), name) for name, v in w.vectors.items()] if x else []
    top = max(scores, key=lambda s: (s[0], [-ord(c) for c in s[1]]), default=(0, None))
    return top if top[0] >= threshold else (None, None)


def _own(text):
    lines = [x for x in (text or "").split("\n") if licenses.words_of(x)]
    found = [_best(x) for x in [text or "", *lines]]
    real = [f for f in found if f[1]]
    return max(real, key=lambda f: (f[0], [-ord(c) for c in f[1]]), default=(None, None)), bool(found[0][1])


FILES = [
    ("a/LICENSE", "Licensed under the Apache License, Version 2.0."),
    ("a/x.py", "code here\nand more"),
    ("a/b/c/y.py", "# Released under the MIT License.\ncode"),
    ("a/b/c/z.py", None),
    ("a/b/COPYING.txt", "Copying\n\nThis work is licensed under the GNU General Public License, version 3.\n"),
    ("a/b/c/d/e/w.py", ""),
    ("ab/v.py", "the license of the apache people under the general public"),
    ("ab/all.txt", "all RIGHTS reserved"),
    ("ab/n/u.py", "nothing"),
    ("top.md", "Licensed under CC BY-NC-SA 4.0"),
    ("LICENSE.md", "Released under the MIT License, friends."),
    (None, "Released under the ISC License."),
    (None, "none"),
    ("a/x.py", "code here\nand more"),
    ("/abs/p.py", "p"),
    ("q/LICENSE", "Released under the ISC License."),
    ("q/NOTICE", "Released under the MIT License."),
    ("q/r/s", "s"),
]


def test_scan_equals_direct_computation(spark):
    df = spark.createDataFrame([(*f, "x", "y") for f in FILES], "path string, text string, license string, dir string")
    got = sorted((tuple(r) for r in licenses.scan_licenses(df).collect()), key=str)
    given = {}
    import re
    for path, text in FILES:
        (score, name), whole = _own(text)
        if path is not None and name and (whole or re.search(licenses.LICENSE_FILE, path)):
            d = path.rpartition("/")[0]
            given[d] = min(given.get(d, (9,)), (-score, path, name))
    want = []
    for path, text in FILES:
        (score, name), _ = _own(text)
        near = None
        if name is None and path is not None:
            d = path.rpartition("/")[0]
            while True:
                if d in given:
                    near = d
                    break
                if not d:
                    break
                d = d.rpartition("/")[0]
        want.append((path, name, score, name or (given[near][2] if near is not None else None), near))
    assert got == sorted(want, key=str)
    assert licenses.scan_licenses(df.where("false")).count() == 0


def test_the_filter_passes_every_match():
    w = licenses.Weights()
    for name, text in licenses.TEMPLATES:
        kept = [t for t in w.vectors[name] if t not in w.filter]
        assert sum(w.vectors[name][t] ** 2 for t in kept) < licenses.THRESHOLD ** 2
        assert _best(text) == (pytest.approx(1.0), name)
