"""Line dedup with a tree of log templates.

A line is a sequence of white-space separated tokens; a token with a digit is
a variable field ``<*>``.  The tree has a fixed depth: the first level is the
number of tokens, the next ``DEPTH`` levels are the leading tokens.  Inside a
leaf, lines that agree in at least ``SIMILARITY`` of their positions belong to
one template (transitively), whose differing positions are fields as well.  A
template that recurs across documents is boilerplate: its lines are dropped
from every document but the first.  ``min_docs`` documents make a template
recur; lines of ``long_words`` tokens and more may have a bound of their own,
``long_docs``, as a long passage seldom recurs by chance.

Distinct lines are counted with one aggregate.  Only leaves that hold several
lines and enough documents are looked into again, as buckets of lines:

* a bucket of up to ``LEAF`` lines is searched by one task;
* a larger one streams past its first lines that are not linked to each other
  (pivots, ``LEAF`` at most).  Each line is linked to the pivots it agrees
  with, so a crowd of variants becomes one component in one pass.  Links
  between lines of different components may be left: the bucket streams again
  with the lines outside its largest component first, and every line is
  compared with each of those;
* a bucket with more than ``LEAF`` lines outside its largest component is split
  exactly: two lines of n tokens with at most k differing positions agree in
  all positions of one of any k + 1 groups, so each group gives a smaller
  bucket, which goes the same way.  Buckets whose lines are in one component
  already are dropped.

Buckets emit stars of linked lines or links to pivots, never all pairs.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odgraph.llm.common import cut, slices, utf8, valid_text
from odgraph.llm.components import connected_components

FIELD = b"<*>"
DEPTH = 3
SIMILARITY = 0.8
#: Documents from which a template counts as recurring.
MIN_DOCS = 5
#: Lines of so many tokens recur from so many documents on.
LONG_WORDS, LONG_DOCS = 51, 2
LEAF = 512
LEVELS = 12
#: Rows of a list that is broadcast; a longer one is joined by a shuffle.
LISTED = 500_000


_DIGIT = re.compile(rb"[0-9]")
_VARIABLE = re.compile(rb"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+")


def masked(line: bytes) -> bytes:
    """The line with one blank between tokens and tokens with digits as fields."""
    plain = b" ".join(line.split())
    return _VARIABLE.sub(FIELD, plain) if _DIGIT.search(plain) else plain


def _names(line: bytes) -> tuple[int, str]:
    """Leaf and name of a masked line."""
    tokens = line.count(b" ") + 1
    lead = b" ".join(line.split(b" ", DEPTH)[:DEPTH])
    return _signed(xxhash.xxh64_intdigest(b"%d %s" % (tokens, lead))), xxhash.xxh3_128_hexdigest(line)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


_LINE = pa.struct([("leaf", pa.int64()), ("line", pa.string()), ("need", pa.int32())])


def _named_lines(docs: DataFrame, id_col: str, text_col: str, min_docs: int, long_words: int | None,
                 long_docs: int) -> DataFrame:
    """``(id, key, lines)`` of every row: ``key`` is the hash of the text, ``lines`` the
    leaf and name of each of its lines (null for blank ones) and the documents its
    template needs."""
    text = valid_text(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))

    def read(batches):
        for batch in batches:
            for part in slices(batch, 2):
                offsets, leaves, names, needs = [0], [], [], []
                for value in utf8(part.column(2)):
                    for raw in value.split(b"\n") if value is not None else ():
                        line = masked(raw)
                        leaf, name = _names(line) if line else (None, None)
                        leaves.append(leaf)
                        names.append(name)
                        long = long_words is not None and line.count(b" ") + 1 >= long_words
                        needs.append(long_docs if long else min_docs)
                    offsets.append(len(leaves))
                lines = pa.StructArray.from_arrays(
                    [pa.array(leaves, pa.int64()), pa.array(names, pa.string()), pa.array(needs, pa.int32())],
                    fields=list(_LINE))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), lines)],
                    ["id", "key", "lines"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(read, f"id {kind}, key long, lines array<struct<leaf: long, line: string, need: int>>")


def _masked_lines(docs: DataFrame, text_col: str) -> DataFrame:
    """``(leaf, line, masked)`` of the lines, each once for a run of documents."""

    def read(batches):
        for batch in batches:
            for part in slices(batch, 0):
                lines = {masked(raw) for value in utf8(part.column(0)) if value is not None for raw in value.split(b"\n")}
                lines = sorted(lines - {b""})
                named = [_names(x) for x in lines]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n[0] for n in named], pa.int64()), pa.array([n[1] for n in named], pa.string()),
                     pa.array([x.decode() for x in lines], pa.string())], ["leaf", "line", "masked"])

    return docs.select(valid_text(F.col(text_col)).alias("text")).mapInArrow(
        read, "leaf long, line string, masked string")


def _listed(df: DataFrame) -> DataFrame:
    """A written list, marked for broadcast where it is short."""
    return F.broadcast(df) if df.limit(LISTED + 1).count() <= LISTED else df


def differing(tokens: int, similarity: float = SIMILARITY) -> int:
    """Most positions in which two lines of a template differ."""
    return int(tokens * (1 - similarity) + 1e-9)


def _forest(names: list[str], lines: list[str], similarity: float) -> list[tuple[str, str]]:
    """Components of distinct lines of one length, each as a star around its first line."""
    rows = _token_rows(lines, {})
    most = differing(rows.shape[1], similarity)
    left = np.ones(len(rows), dtype=bool)
    edges = []
    while left.any():
        first = int(np.flatnonzero(left)[0])
        queue = [first]
        left[first] = False
        while queue:
            i = queue.pop()
            rest = np.flatnonzero(left)
            near = rest[(rows[rest] != rows[i]).sum(axis=1) <= most]
            left[near] = False
            queue += near.tolist()
            edges += [(names[first], names[j]) for j in near]
    return edges


def _token_rows(lines: list[str], numbers: dict[str, int]) -> np.ndarray:
    return np.array([[numbers.setdefault(t, len(numbers)) for t in x.split(" ")] for x in lines])


class _Crowd:
    """Links of the lines of a large bucket to pivots."""

    def __init__(self, similarity: float, limit: int):
        self.similarity, self.limit = similarity, limit
        self.names: list[str] = []
        self.numbers: dict[str, int] = {}
        self.pivots: np.ndarray | None = None
        self.joined: list[int] = []  # pivots that lines have linked to each other

    def add(self, names: list[str], lines: list[str], outside: list[int]) -> list[tuple[str, str]]:
        """``outside`` 1: a line outside the largest component, always a pivot; 0: one
        inside, never; -1: components are not known, a pivot if no other is near."""
        edges = []
        for name, line, out in zip(names, lines, outside):
            row = np.array([self.numbers.get(t, -1) for t in line.split(" ")])
            near = []
            if self.pivots is not None:
                most = differing(len(row), self.similarity)
                near = np.flatnonzero((self.pivots != row).sum(axis=1) <= most)
            if len(near):
                edges.append((self.names[near[0]], name))
                for i in near[1:]:
                    self._join(near[0], i)
            if len(self.names) < self.limit and (out == 1 or out == -1 and not len(near)):
                new = _token_rows([line], self.numbers)
                self.pivots = new if self.pivots is None else np.concatenate([self.pivots, new])
                self.joined.append(len(self.names))
                self.names.append(name)
        return edges

    def _top(self, x: int) -> int:
        while self.joined[x] != x:
            x = self.joined[x]
        return x

    def _join(self, i: int, j: int) -> None:
        i, j = self._top(i), self._top(j)
        self.joined[max(i, j)] = min(i, j)

    def finish(self) -> list[tuple[str, str]]:
        """Links among pivots that some line agrees with at once."""
        return [(self.names[self._top(i)], name) for i, name in enumerate(self.names) if self._top(i) != i]


def _links(rows: DataFrame, similarity: float, limit: int, last: bool) -> DataFrame:
    """Stream sorted buckets of ``(bucket, line, masked, outside)``: ``a, b`` is a
    link; a row with ``masked`` belongs to a bucket that is not done."""
    schema = pa.schema([("a", pa.string()), ("b", pa.string()), ("bucket", pa.string()), ("masked", pa.string())])

    def compare(batches):
        now, names, lines, outside, crowd = None, [], [], [], None

        def linked(edges):
            return pa.RecordBatch.from_arrays(
                [pa.array([e[0] for e in edges], pa.string()), pa.array([e[1] for e in edges], pa.string()),
                 pa.nulls(len(edges), pa.string()), pa.nulls(len(edges), pa.string())], schema=schema)

        def done(ended=True):
            if crowd is not None:
                yield linked(crowd.add(names, lines, outside) + (crowd.finish() if ended else []))
                # lines whose components are known come in buckets that one pass settles
                left = [i for i, out in enumerate(outside) if out == -1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[i] for i in left], pa.string()), pa.nulls(len(left), pa.string()),
                     pa.array([now] * len(left), pa.string()), pa.array([lines[i] for i in left], pa.string())],
                    schema=schema)
            elif len(names) > 1:
                yield linked(_forest(names, lines, similarity))

        for batch in batches:
            for key, name, line, out in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if key != now:
                    yield from done()
                    now, names, lines, outside, crowd = key, [], [], [], None
                names.append(name)
                lines.append(line)
                outside.append(out)
                if len(names) > limit and not last:
                    crowd = crowd or _Crowd(similarity, limit)
                    yield from done(ended=False)
                    names, lines, outside = [], [], []
        yield from done()

    ordered = rows.repartition("bucket").sortWithinPartitions("bucket", F.desc("outside"), "line")
    return ordered.select("bucket", "line", "masked", "outside").mapInArrow(
        compare, "a string, b string, bucket string, masked string")


def _regrouped(rows: DataFrame, similarity: float, level: int) -> DataFrame:
    """Buckets of lines that agree in one of ``differing + 1`` groups of positions;
    the leading tokens, which a leaf shares, are in no group."""
    tokens = F.split("masked", " ")
    groups = F.floor(F.size(tokens) * (1 - similarity) + 1e-9).cast("int") + 1
    part = lambda g: F.xxhash64(F.filter(
        tokens, lambda t, i: (i >= DEPTH) & (F.pmod(F.xxhash64(i, F.lit(level)), groups) == g)), g)
    keys = F.transform(F.sequence(F.lit(0), groups - 1), lambda g: F.concat_ws(".", F.col("bucket"), F.hex(part(g))))
    return rows.select("line", "masked", "label", F.explode(keys).alias("bucket"))


def template_links(lines: DataFrame, similarity: float = SIMILARITY, limit: int = LEAF) -> DataFrame:
    """``(src, dst)`` edges whose transitive closure gives the templates of
    ``(bucket, line, masked)``; ``bucket`` is the leaf."""
    found = None
    lines = lines.withColumn("outside", F.lit(-1))
    for level in range(LEVELS):
        out = cut(_links(lines, similarity, limit, level == LEVELS - 1), "line-links")
        edges = out.where("b is not null").select(F.col("a").alias("src"), F.col("b").alias("dst"))
        found = edges if found is None else found.unionAll(edges)
        rest = out.where("b is null").select("bucket", F.col("a").alias("line"), "masked")
        if rest.isEmpty():
            break
        parts = connected_components(found).select(F.col("node").alias("line"), F.col("component").alias("label"))
        rest = cut(rest.join(parts, "line", "left").withColumn("label", F.coalesce("label", "line")), "line-rest")
        sized = _sized(rest, limit)
        split = _regrouped(sized.where(~F.col("few")), similarity, level)
        lines = cut(_directed(sized.where("few")).unionByName(_directed(_sized(split, limit))), "line-buckets")
        if lines.isEmpty():
            break
    return found


def _sized(rows: DataFrame, limit: int) -> DataFrame:
    """The rows of buckets with several components, with the ``largest`` component
    and whether ``few`` lines, ``limit`` at most, are outside it."""
    counts = rows.groupBy("bucket", "label").agg(F.count("*").alias("n")).groupBy("bucket").agg(
        F.count("*").alias("labels"), F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("top"))
    several = counts.where("labels > 1").select(
        "bucket", F.col("top.label").alias("largest"), (F.col("n") - F.col("top.n") <= limit).alias("few"))
    return rows.select("bucket", "line", "masked", "label").join(several, "bucket")


def _directed(rows: DataFrame) -> DataFrame:
    """``outside``: 1 and 0 by the largest component where few lines are outside it,
    else -1."""
    side = F.when(F.col("few"), F.when(F.col("label") == F.col("largest"), 0).otherwise(1)).otherwise(-1)
    return rows.select("bucket", "line", "masked", side.alias("outside"))


def _recurring(docs: DataFrame, named: DataFrame, text_col: str, similarity: float, limit: int) -> DataFrame:
    """``(line, template, first_id)`` of every line whose template recurs.

    A template recurs when its lines, each counted once a document, occur
    ``need`` times and in two documents at least; ``first_id`` is the
    smallest id among them.
    """
    each = named.select("id", F.explode(F.array_distinct("lines")).alias("x")).where("x.line is not null")
    lines = cut(each.groupBy("x.leaf", "x.line").agg(
        F.count("*").alias("docs"), F.min("id").alias("first_id"), F.max("id").alias("last_id"),
        F.any_value("x.need").alias("need")), "lines")
    # lines of a leaf are of one length, so they need the same number
    leaves = cut(lines.groupBy("leaf").agg(
        F.sum("docs").alias("docs"), F.count("*").alias("n"), F.any_value("need").alias("need"))
        .where("n > 1 and docs >= need").select("leaf"), "line-leaves")
    again = _masked_lines(docs, text_col).join(_listed(leaves), "leaf", "left_semi").groupBy("leaf", "line").agg(
        F.any_value("masked").alias("masked"))
    links = template_links(again.select(F.hex("leaf").alias("bucket"), "line", "masked"), similarity, limit)
    parts = connected_components(links).select(F.col("node").alias("line"), F.col("component").alias("template"))
    whole = lines.join(parts, "line", "left").withColumn("template", F.coalesce("template", "line"))
    counted = whole.groupBy("template").agg(
        F.sum("docs").alias("docs"), F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id"),
        F.any_value("need").alias("need"))
    often = counted.where((F.col("docs") >= F.col("need")) & ~F.col("first_id").eqNullSafe(F.col("last_id")))
    return whole.select("line", "template").join(often.select("template", "first_id"), "template").select(
        "line", "template", "first_id")


@F.pandas_udf(T.StringType())
def _without(texts: pd.Series, gone: pd.Series) -> pd.Series:
    """Texts without the lines at the positions in ``gone``; null where that is null."""
    def cut_lines(text, places):
        if places is None:
            return None
        lines = text.split("\n")
        for i in places:
            lines[i] = None
        return "\n".join(x for x in lines if x is not None)

    return pd.Series([cut_lines(t, g) for t, g in zip(texts, gone)], dtype=object)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                similarity: float = SIMILARITY, limit: int = LEAF, long_words: int | None = LONG_WORDS,
                long_docs: int = LONG_DOCS) -> DataFrame:
    """``docs`` with the lines of recurring templates dropped from every document
    but the template's first (smallest id), and with ``n_lines``, ``n_dropped``.

    A template recurs from ``min_docs`` documents on, one of lines of at least
    ``long_words`` tokens (None: no line is long) from ``long_docs`` on.
    A column of either name is replaced.  Texts without dropped lines are
    unchanged; of the others the remaining lines are joined by line feeds.
    Null texts stay null and have no lines, blank lines are never dropped,
    documents with a null id are never first, rows that repeat an id lose the
    same lines each, an empty table gives an empty result; bytes that are not
    UTF-8 are U+FFFD in what is compared and returned.
    """
    named = cut(_named_lines(docs, id_col, text_col, min_docs, long_words, long_docs), "line-names")
    drop = cut(_recurring(docs, named, text_col, similarity, limit), "line-drop")
    places = named.select(F.col("id").alias("_id"), F.col("key").alias("_key"), F.posexplode("lines"))
    places = places.select("_id", "_key", "pos", F.col("col.line").alias("line")).where("line is not null")
    gone = (places.join(_listed(drop), "line").where(~F.col("_id").eqNullSafe(F.col("first_id")))
            .groupBy("_id", "_key").agg(F.collect_set("pos").alias("_gone")))
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(id_col).alias("id"),
                       F.xxhash64(valid_text(F.col(text_col))).alias("key"))
    out = rows.join(gone, F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    text = valid_text(F.col("row")[text_col])
    kept = _without(F.when(F.col("_gone").isNotNull(), text), F.col("_gone"))
    out = out.select(
        "row", F.when(F.col("_gone").isNull(), text).otherwise(kept).alias("kept"),
        F.coalesce(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.array_size("_gone"), F.lit(0)).cast("long").alias("n_dropped"))
    order = [F.col("kept").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in names]
    return out.select(*order, "n_lines", "n_dropped")


def without_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` after :func:`dedup_lines`, without documents of which only blank
    lines are left; ``n_chars``, where there is one, is counted again for cut texts.
    Null and empty texts, which have no line to lose, stay; rows that repeat an id
    and empty tables are as in :func:`dedup_lines`."""
    out = dedup_lines(docs, id_col, text_col, **options)
    out = out.where((F.col("n_dropped") == 0) | F.col(text_col).rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length(text_col).cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
