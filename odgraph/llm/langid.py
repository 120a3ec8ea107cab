"""Language identification by cross-parsing.

For every language a bounded sample of its labelled text is kept as a suffix
automaton.  A document is parsed against it greedily: the next phrase is the
longest match with the sample from where the last phrase ended.  Text of the
same language falls into few long phrases, so the language that needs the
fewest phrases per character wins.

Text is folded first: lower case, UTF-8 bytes, every run of bytes that is not
a letter is one blank.  It is parsed in blocks of ``BLOCK`` bytes that are
walked side by side: one table look-up moves all of them by a byte.  Every
byte of every text is parsed; a block boundary ends a phrase.

The automata are bounded by ``TRAIN_BYTES`` a language and ``MAX_LANGUAGES``.
The sample of a language is its labelled documents in the order of
xxhash64(id), up to ``TRAIN_DOCS`` documents of at most ``DOC_BYTES`` bytes; of
a longer one a window of ``DOC_BYTES / 4`` characters whose place is hashed.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odgraph.llm.common import slices, utf8

UNKNOWN = "und"
TRAIN_DOCS = 64
DOC_BYTES = 8_000
TRAIN_BYTES = 24_000
MAX_LANGUAGES = 200
BLOCK = 512
_GAP = re.compile(rb"[^a-z\x80-\xff]+")
_LETTER = re.compile(r"[^\W\d_]")


def fold(text: str) -> bytes:
    """Lower-cased UTF-8 with one blank for every run of other bytes than letters."""
    return _GAP.sub(b" ", text.lower().encode("utf-8", "replace"))


def has_letter(text: str) -> bool:
    """Whether a character is a letter by its Unicode category (numeric signs are not)."""
    return any(m.group().isalpha() for m in _LETTER.finditer(text))


class Parser:
    """The complete walk table of a suffix automaton.

    ``table[state * width + class]`` is twice the next state, plus 1 where the
    phrase ended before this byte.
    """

    def __init__(self, sample: bytes):
        edges, link, length = [{}], [-1], [0]
        last = 0
        for c in sample:
            new = len(edges)
            edges.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and c not in edges[p]:
                edges[p][c] = new
                p = link[p]
            if p >= 0:
                q = edges[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    copy = len(edges)
                    edges.append(dict(edges[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    while p >= 0 and edges[p].get(c) == q:
                        edges[p][c] = copy
                        p = link[p]
                    link[q] = link[new] = copy
            last = new
        letters = sorted(edges[0])
        self.classes = np.zeros(256, dtype=np.uint8)  # 0: a byte the sample lacks
        self.classes[letters] = np.arange(1, len(letters) + 1)
        self.width = len(letters) + 1
        # a byte that the sample lacks is a phrase of its own: it leads to a last,
        # dead state in which every byte begins a phrase
        dead = len(edges)
        table = np.zeros((dead + 1, self.width), dtype=np.int32)
        for c in letters:
            table[:, self.classes[c]] = 2 * edges[0][c] + 1
        table[:, 0] = 2 * dead + 1
        table[0, 0] = 2 * dead
        for state, out in enumerate(edges):
            for c, to in out.items():
                table[state, self.classes[c]] = 2 * to
        self.table = table.ravel()

    def phrases(self, blocks: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases of each block.  ``blocks[i, j]`` is byte i of block j; the
        blocks are in falling order of their lengths."""
        cells = self.classes[blocks]
        state = np.zeros(blocks.shape[1], dtype=np.int64)
        count = (lengths > 0).astype(np.int64)
        alive = np.searchsorted(-lengths, -np.arange(blocks.shape[0]), side="left")
        for i in range(blocks.shape[0]):
            n = alive[i]
            to = self.table[state[:n] * self.width + cells[i, :n]]
            count[:n] += to & 1
            state[:n] = to >> 1
        return count


class Model:
    """Samples by language; parsers are built once in each worker."""

    _built: dict[str, dict[str, Parser]] = {}

    def __init__(self, samples: dict[str, bytes]):
        self.samples = samples
        self.key = hashlib.sha256(repr(sorted(samples.items())).encode()).hexdigest()

    def parsers(self) -> dict[str, Parser]:
        if self.key not in self._built:
            type(self)._built = {self.key: {k: Parser(v) for k, v in sorted(self.samples.items())}}
        return self._built[self.key]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of every text.

        The score is 1 - (fewest phrases) / (next fewest), so 0 for a tie (the
        alphabetically first language is named).  With one language it is 1.
        ``und`` with score 0: null, no letter, or no language learned.
        """
        out = [(UNKNOWN, 0.0)] * len(texts)
        parsers = self.parsers()
        rows = [i for i, t in enumerate(texts) if t and parsers and has_letter(t)]
        if not rows:
            return out
        folded = [fold(texts[i]) for i in rows]
        sizes = np.array([len(x) for x in folded])
        number = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(rows)), number)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        lengths = np.minimum(sizes[owner] - place * BLOCK, BLOCK)
        order = np.argsort(-lengths, kind="stable")
        flat = np.frombuffer(b"".join(folded) + bytes(BLOCK), dtype=np.uint8)
        starts = np.repeat(np.cumsum(sizes) - sizes, number) + place * BLOCK
        lengths, owner = lengths[order], owner[order]
        windows = np.lib.stride_tricks.sliding_window_view(flat, BLOCK)
        blocks = np.ascontiguousarray(windows[starts[order]].T[:lengths[0]])
        names = list(parsers)
        counts = np.stack([
            np.bincount(owner, parser.phrases(blocks, lengths), minlength=len(rows))
            for parser in parsers.values()])
        best = counts.argmin(axis=0)
        least = counts.min(axis=0)
        rest = np.sort(counts, axis=0)[1] if len(names) > 1 else np.full(len(rows), np.inf)
        score = 1 - least / np.maximum(rest, 1)
        for j, i in enumerate(rows):
            out[i] = (names[best[j]], float(min(max(score[j], 0.0), 1.0)))
        return out


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Model:
    """Learn from ``labelled``: rows with null language and null or empty text are
    passed over.  The driver receives at most ``MAX_LANGUAGES`` samples of
    ``TRAIN_DOCS * DOC_BYTES`` bytes."""
    lang, text = F.col(lang_col).cast("string"), F.col(text_col).cast("string")
    fits = lang.isNotNull() & (F.octet_length(text) > 0)
    window = DOC_BYTES // 4
    place = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(1)), F.greatest(F.char_length(text) - window + 1, F.lit(1))) + 1
    text = F.when(F.octet_length(text) <= DOC_BYTES, text).otherwise(F.substr(text, place.cast("int"), F.lit(window)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id", "text"))
    sample = (labelled.where(fits)
              .select(lang.alias("lang"), F.col(id_col).cast("string").alias("id"), text.alias("text"),
                      F.xxhash64(F.col(id_col).cast("string")).alias("h"))
              .withColumn("rank", rank).where(F.col("rank") <= TRAIN_DOCS))
    rows = sample.select("lang", "rank", "text").limit(TRAIN_DOCS * (MAX_LANGUAGES + 1)).collect()
    if len({r["lang"] for r in rows}) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    texts: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["rank"])):
        texts.setdefault(r["lang"], []).append(fold(r["text"]))
    return Model({k: b" ".join(v)[:TRAIN_BYTES] for k, v in texts.items()})


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
             carry: tuple[Column, ...] = ()) -> DataFrame:
    """``docs``' id, the columns in ``carry``, ``lang_pred`` and ``score`` for
    every row (repeated rows, null ids and null texts included)."""
    return _identified(docs.select(F.col(id_col), *carry, F.col(text_col).cast("string").alias("_text")), model
                       ).drop("_text")


def _identified(rows: DataFrame, model: Model, field: int | None = None) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to rows whose text is the last column, or
    the ``field`` of that struct."""
    from pyspark.sql import types as T

    held = rows.sparkSession.sparkContext.broadcast(model)
    last = len(rows.columns) - 1

    def predict(batches):
        for batch in batches:
            text = batch.column(last) if field is None else pc.struct_field(batch.column(last), [field])
            whole = pa.RecordBatch.from_arrays([*batch.columns, text], [*batch.schema.names, "_text"])
            for part in slices(whole, last + 1, 4 << 20):
                found = held.value.predict([None if x is None else x.decode("utf-8", "replace") for x in utf8(part.column(last + 1))])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array([f[0] for f in found], pa.string()),
                     pa.array([f[1] for f in found], pa.float64())],
                    [*batch.schema.names, "lang_pred", "score"])

    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(predict, schema)


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", min_score: float = 0.02,
                    min_chars: int = 200) -> DataFrame:
    """``docs`` without the documents that have no language: no letters, or text of
    ``min_chars`` characters and more that no language parses in clearly fewer
    phrases than the next.  Shorter texts may tie by chance and stay.

    Null and empty texts go; rows with null ids and repeated rows are judged one
    by one; an empty table stays empty; other columns may have any names; bytes
    that are not UTF-8 count as U+FFFD.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    if dict(docs.dtypes).get(text_col) == "string":  # the text goes to Python once, within its row
        text, field = F.col(f"_row.`{text_col}`"), docs.columns.index(text_col)
    else:
        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                           F.col(text_col).cast("string").alias("_text"))
        text, field = F.col("_text"), None
    clear = (F.col("score") >= min_score) | (F.char_length(text) < min_chars)
    return _identified(rows, model, field).where((F.col("lang_pred") != UNKNOWN) & clear).select("_row.*")
