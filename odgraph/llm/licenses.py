"""License scan: TF-IDF cosine to license templates, and inheritance from the
nearest ancestor directory.

Every line of a file (a header statement) and the whole file (a license file)
is a unit.  Units and templates are sparse vectors of term count times inverse
document frequency over the templates; a term that no template has weighs
most.  A file's own license is the best template over its units with a cosine
of at least ``THRESHOLD``.  License files give their license to their
directory; a file without one of its own takes that of its nearest ancestor
directory that has one.

Beside the statements there are license texts and headers of several lines
(:mod:`odgraph.llm.licensetexts`), compared with whole texts, paragraphs, runs
of comment lines and windows of up to ``WINDOW`` adjacent lines, and titles and
SPDX tags, compared with lines and windows; a title or tag counts where all its
words are there.  They have document frequencies of their own, so they change no
score of a statement.  A text or header outranks a statement, title or tag, those
a title without version, and that `All rights reserved`.

Only DataFrame functions are used.  Before terms are counted a prefix filter
drops units that cannot match: for each template some terms are set aside
until the rest is shorter than the threshold, so a unit without any of the
terms set aside stays below it.  The filter is exact and passes over most
text.  Paths are joined by directory: a file's directory, not the file, is
joined with its ancestors.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odgraph.llm import licensetexts
from odgraph.llm.common import cut

THRESHOLD = 0.8
#: Most adjacent lines of a window.
WINDOW = 4

# Statements by which files name a license, by SPDX identifier.
TEMPLATES = (
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause Simplified License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("EPL-2.0", "Made available under the terms of the Eclipse Public License 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("LicenseRef-All-Rights-Reserved", "All rights reserved."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

# Words of the templates that are common in any English text.
COMMON = frozenset("all and by form free into is of subject terms the this to under v work".split())

#: Names of files that give their license to their directory.
LICENSE_FILE = r"(?i)(^|/)(licen[sc]e|copying|unlicense|notice)([.-][^/]*)?$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str) -> list[str]:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in low).split()


class Weights:
    """Inverse document frequencies, unit template vectors and the filter terms."""

    def __init__(self, templates=TEMPLATES, threshold: float = THRESHOLD, stop=frozenset()):
        bags = {name: Counter(t for t in words_of(text) if t not in stop) for name, text in templates}
        df = Counter(t for bag in bags.values() for t in bag)
        self.unknown = math.log(1 + len(bags)) + 1
        self.idf = {t: math.log((1 + len(bags)) / (1 + n)) + 1 for t, n in df.items()}
        self.vectors, self.filter = {}, set()
        for name, bag in bags.items():
            vector = {t: n * self.idf[t] for t, n in bag.items()}
            norm = math.sqrt(sum(x * x for x in vector.values()))
            self.vectors[name] = {t: x / norm for t, x in vector.items()}
            rest = sum(x * x for x in self.vectors[name].values())
            # long terms are rare in text, so they are set aside first, common words last
            for t in sorted(bag, key=lambda t: (t in COMMON, -len(t), t)):
                if rest < (threshold - 1e-9) ** 2:
                    break
                rest -= self.vectors[name][t] ** 2
                self.filter.add(t)


def _plain(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def _together(likely: DataFrame) -> DataFrame:
    """Likely texts dealt by key: the words of a text are then counted, weighed and
    summed where the text is, for a grouping by key and more needs no exchange.
    The number of partitions is given, for every text grows to many words."""
    parts = int(likely.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return likely.repartition(parts, "key")


def own_licenses(files: DataFrame, key: str, text_col: str, templates=TEMPLATES,
                 threshold: float = THRESHOLD) -> DataFrame:
    """``(key, own_license, own_score, opens, is_license)`` of the files that state
    a license; files that share a ``key`` share their text, which scales counts
    and changes no cosine.

    ``opens``: the first line that is not blank states it; ``is_license``: the
    whole text is like a template.  Scores are rounded to six digits; a tie
    goes to the template that is first by name.
    """
    spark = files.sparkSession
    w = Weights(templates, threshold)
    pattern = r"(?<![a-z0-9])(?:" + "|".join(sorted(w.filter)) + r")(?![a-z0-9])"
    text = _plain(F.col(text_col).cast("string"))
    likely = files.select(F.col(key).alias("key"), text.alias("text")).where(F.col("text").rlike(pattern))
    likely = _together(likely)
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[a-z0-9]"))
    # unit 0 is the whole text, unit n its n-th line with a letter or digit
    units = likely.select("key", F.posexplode(F.concat(F.array("text"), lines)).alias("unit", "line"))
    units = units.where(F.col("line").rlike(pattern))
    terms = units.select("key", "unit", F.explode(F.split("line", "[^a-z0-9]+")).alias("term")).where("term <> ''")
    counts = terms.groupBy("key", "unit", "term").agg(F.count("*").alias("n"))
    idf = F.broadcast(spark.createDataFrame(sorted(w.idf.items()), "term string, idf double"))
    weighed = counts.join(idf, "term", "left").withColumn("x", F.col("n") * F.coalesce("idf", F.lit(w.unknown)))
    pairs = [(name, t, x) for name, v in sorted(w.vectors.items()) for t, x in sorted(v.items())]
    by_term = F.broadcast(spark.createDataFrame(pairs, "template string, term string, weight double").groupBy("term").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("template", "weight")))).alias("weights")))
    dots = [F.sum(F.col("x") * F.coalesce(F.col("weights")[name], F.lit(0.0))).alias(f"d{i}")
            for i, name in enumerate(sorted(w.vectors))]
    scored = weighed.join(by_term, "term", "left").groupBy("key", "unit").agg(
        F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"), *dots)
    best = F.array_max(F.array(*[
        F.struct(F.round(F.col(f"d{i}") / F.col("norm"), 6).alias("score"), F.lit(-i).alias("rank"), F.lit(name).alias("name"))
        for i, name in enumerate(sorted(w.vectors))]))
    found = scored.select("key", "unit", best.alias("best")).where(F.col("best.score") >= threshold)
    return found.groupBy("key").agg(
        F.max("best").alias("best"), F.bool_or(F.col("unit") == 1).alias("opens"),
        F.bool_or(F.col("unit") == 0).alias("is_license"),
    ).select("key", F.col("best.name").alias("own_license"), F.col("best.score").alias("own_score"), "opens", "is_license")


#: Starts of comment lines.
_COMMENT = r"^\s*(#|//|/?\*|;|--|%|<!--|\"\"\"|dnl |rem )"
_BREAK = "\u0001"


def _runs(raw: Column, kept: str) -> Column:
    """Maximal runs of the adjacent lines that match ``kept``, each as one text."""
    marked = F.transform(raw, lambda x: F.when(x.rlike(kept), x).otherwise(F.lit(_BREAK)))
    return F.filter(F.split(F.array_join(marked, "\n"), _BREAK), lambda x: x.rlike("[a-z0-9]"))


def _needed(vector: dict, threshold: float) -> tuple[list[str], int]:
    """Terms that carry most of a template, and how many of them a match has at least."""
    heavy, mass = [], 0.0
    for t in sorted(vector, key=lambda t: (-vector[t], t)):
        if mass >= 0.8:
            break
        heavy.append(t)
        mass += vector[t] ** 2
    missing, n = (threshold - 1e-9) ** 2 - (sum(x * x for x in vector.values()) - mass), 0
    for t in heavy:
        if missing <= 0:
            break
        missing -= vector[t] ** 2
        n += 1
    return heavy, n


def _possible(words: Column, w: Weights, threshold: float, whole: bool) -> Column:
    """Whether a text with these distinct words, or a part of it, can match a
    template: the terms it has carry at most their share of the template."""
    out = F.lit(False)
    for _, v in sorted(w.vectors.items()):
        heavy, n = (sorted(v), len(v)) if whole else _needed(v, threshold)
        if whole or n > 3:
            out = out | (F.size(F.array_intersect(words, F.array(*map(F.lit, heavy)))) >= n)
        else:
            left = sum(x * x for x in v.values()) - sum(v[t] ** 2 for t in heavy)
            mass = sum((F.when(F.array_contains(words, t), v[t] ** 2).otherwise(0.0) for t in heavy), F.lit(0.0))
            out = out | (mass >= (threshold - 1e-9) ** 2 - left - 1e-9)
    return out


def _terms_asked(w: Weights, threshold: float, whole: bool) -> set:
    return {t for v in w.vectors.values() for t in (v if whole else _needed(v, threshold)[0])}


def _matches(units: DataFrame, w: Weights, threshold: float, whole: bool, stop) -> DataFrame:
    """``(key, unit, opens, is_whole, template, score)`` of the units that match a
    template; ``whole``: only templates all of whose words the unit has."""
    words = F.filter(F.split("line", "[^a-z0-9]+"), lambda t: t != "")
    asked = F.array(*map(F.lit, sorted(_terms_asked(w, threshold, whole))))
    units = units.withColumn("words", words).withColumn("hit", F.array_intersect("words", asked))
    units = units.where(_possible(F.col("hit"), w, threshold, whole))
    spark = units.sparkSession
    terms = units.select("key", "unit", "opens", "is_whole", F.explode("words").alias("term"))
    if stop:
        terms = terms.where(~F.col("term").isin(sorted(stop)))
    counts = terms.groupBy("key", "unit", "opens", "is_whole", "term").agg(F.count("*").alias("n"))
    idf = F.broadcast(spark.createDataFrame(sorted(w.idf.items()), "term string, idf double"))
    weighed = counts.join(idf, "term", "left").withColumn("x", F.col("n") * F.coalesce("idf", F.lit(w.unknown)))
    weighed = weighed.withColumn("norm", F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy("key", "unit"))))
    pairs = [(name, t, x, len(v)) for name, v in sorted(w.vectors.items()) for t, x in sorted(v.items())]
    pairs = F.broadcast(spark.createDataFrame(pairs, "template string, term string, weight double, size int"))
    dots = weighed.join(pairs, "term").groupBy("key", "unit", "opens", "is_whole", "template").agg(
        F.sum(F.col("x") * F.col("weight")).alias("dot"), F.count("*").alias("n"), F.any_value("size").alias("size"),
        F.any_value("norm").alias("norm"))
    scored = dots.withColumn("score", F.round(F.col("dot") / F.col("norm"), 6))
    scored = scored.where(F.col("score") >= threshold)
    return scored.where("n = size") if whole else scored


def text_licenses(files: DataFrame, key: str, text_col: str, threshold: float = THRESHOLD) -> DataFrame:
    """The columns of :func:`own_licenses` with ``rank`` for files that hold a
    license text, a header of several lines, a title or an SPDX tag."""
    stop = licensetexts.STOP
    long = Weights(licensetexts.long_templates(), threshold, stop)
    short = Weights(licensetexts.short_templates([n for n, _ in TEMPLATES]), threshold)
    reserved = r"\ball rights reserved\b"
    text = _plain(F.col(text_col).cast("string"))
    likely = files.select(F.col(key).alias("key"), text.alias("text"))
    asked = F.array(*map(F.lit, sorted(
        _terms_asked(long, threshold, False) | _terms_asked(short, threshold, True))))
    likely = likely.withColumn("hit", F.array_intersect(F.split("text", "[^a-z0-9]+"), asked))
    # what no part of the whole text can match is not cut into units
    likely = likely.where(_possible(F.col("hit"), long, threshold, False) | _possible(F.col("hit"), short, threshold, True)
                          | F.col("text").rlike(reserved)).drop("hit")
    likely = _together(cut(likely, "license-texts"))
    raw = F.split("text", "\n")
    likely = likely.withColumn("raw", raw).withColumn("lines", F.filter("raw", lambda x: x.rlike("[a-z0-9]")))

    def unit(line, opens, whole=False):
        return F.struct(opens.alias("opens"), F.lit(whole).alias("is_whole"), line.alias("line"))

    def windows(n):
        starts = F.when(F.size("lines") >= n, F.sequence(F.lit(1), F.size("lines") - (n - 1))).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, lambda i: unit(F.array_join(F.slice("lines", i, n), "\n"), i == 1))

    several = [windows(n) for n in range(2, WINDOW + 1)]
    blocks = [F.transform(_runs(F.col("raw"), "[a-z0-9]"), lambda x, i: unit(x, i == 0)),
              F.transform(_runs(F.col("raw"), _COMMENT),
                          lambda x, i: unit(x, (i == 0) & F.element_at("lines", 1).rlike(_COMMENT)))]
    whole = F.array(unit(F.col("text"), F.lit(False), True))

    def units(*parts):
        return likely.select("key", F.posexplode(F.concat(*parts)).alias("unit", "u")).select("key", "unit", "u.*")

    found = _matches(units(whole, *blocks, *several), long, threshold, False, stop).withColumn("rank", F.lit(3))
    named = _matches(units(whole, windows(1), *several), short, threshold, True, ()).withColumn(
        "rank", F.when(F.col("template").endswith("/bare"), 1).otherwise(2))
    notice = units(windows(1)).where(F.col("line").rlike(r"(^|[^a-z0-9])(copyright|\(c\)|©)") & F.col("line").rlike(reserved))
    notice = notice.select("key", "unit", "opens", "is_whole", F.lit(licensetexts.RESERVED).alias("template"),
                           F.lit(1.0).alias("score"), F.lit(0).alias("rank"))
    columns = ["key", "template", "score", "opens", "is_whole", "rank"]
    every = found.select(columns).unionAll(named.select(columns)).unionAll(notice.select(columns))
    every = every.withColumn("name", F.substring_index("template", "/", 1))
    return every.groupBy("key").agg(
        F.min(F.struct((-F.col("rank")).alias("r"), (-F.col("score")).alias("s"), "name")).alias("best"), F.bool_or("opens").alias("opens"),
        F.bool_or("is_whole").alias("is_license"),
    ).select("key", F.col("best.name").alias("own_license"), (-F.col("best.s")).alias("own_score"), "opens",
             "is_license", (-F.col("best.r")).alias("rank"))


def stated_licenses(files: DataFrame, key: str, text_col: str, templates=TEMPLATES,
                    threshold: float = THRESHOLD) -> DataFrame:
    """:func:`own_licenses` and :func:`text_licenses` of every file, the better rank first."""
    lines = own_licenses(files, key, text_col, templates, threshold).withColumn(
        "rank", F.when(F.col("own_license") == licensetexts.RESERVED, 0).otherwise(2))
    both = lines.unionByName(text_licenses(files, key, text_col, threshold))
    return both.groupBy("key").agg(
        F.min(F.struct((-F.col("rank")).alias("r"), (-F.col("own_score")).alias("s"), "own_license")).alias("best"),
        F.bool_or("opens").alias("opens"), F.bool_or("is_license").alias("is_license"),
    ).select("key", F.col("best.own_license").alias("own_license"), (-F.col("best.s")).alias("own_score"), "opens",
             "is_license")


def _ancestors(directory: str) -> Column:
    """The directory and all above it, '' last."""
    parts = F.split(F.col(directory), "/")
    return F.when(F.col(directory) == "", F.array(F.lit(""))).otherwise(F.transform(
        F.sequence(F.size(parts), F.lit(0)), lambda n: F.array_join(F.slice(parts, 1, n), "/")))


def scan_licenses(files: DataFrame, path_col: str = "path", text_col: str = "text", templates=TEMPLATES,
                  threshold: float = THRESHOLD, openers_declare: bool = False) -> DataFrame:
    """``(path_col, own_license, own_score, license, inherited_from)`` for every file.

    ``license`` is the file's own, else that of the nearest ancestor directory
    with a license file, whose directory is ``inherited_from``.  License files
    are those named like one or whose whole text is a template; with
    ``openers_declare`` also those that open with a statement.  Of several in
    a directory the best score counts, then the first path.

    Paths are split at ``/``; a null path lies in no directory and inherits
    nothing.  Null and empty texts state nothing.  Files that share a path and
    text are one file returned as often as it occurs; columns of other names
    are not read.
    """
    path, text = F.col(path_col).cast("string"), F.col(text_col).cast("string")
    key = F.concat_ws(":", F.hex(F.xxhash64(path, text)), F.hex(F.xxhash64(F.lit(1), path, text)))
    keyed = files.select(path.alias("path"), text.alias("text"), key.alias("key"))
    own = stated_licenses(keyed, "key", "text", templates, threshold)
    directory = F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).when(
        F.col("path").isNotNull(), F.lit(""))
    stated = cut(keyed.select("path", "key", directory.alias("dir")).join(own, "key", "left"), "licenses")
    declares = F.col("path").rlike(LICENSE_FILE) | F.col("is_license")
    declares = declares | F.col("opens") if openers_declare else declares
    declared = (stated.where(F.col("own_license").isNotNull() & F.col("dir").isNotNull() & declares)
                .groupBy(F.col("dir").alias("above"))
                .agg(F.min(F.struct(-F.col("own_score"), "path", "own_license"))["own_license"].alias("given")))
    directories = stated.where("dir is not null").select("dir").distinct()
    climbed = directories.select("dir", F.posexplode(_ancestors("dir")).alias("steps", "above"))
    nearest = climbed.join(declared, "above").groupBy("dir").agg(
        F.min(F.struct("steps", "above", "given")).alias("near"))
    out = stated.join(nearest, "dir", "left")
    inherits = F.col("own_license").isNull()
    return out.select(
        F.col("path").alias(path_col), "own_license", "own_score",
        F.coalesce("own_license", "near.given").alias("license"),
        F.when(inherits, F.col("near.above")).alias("inherited_from"))
