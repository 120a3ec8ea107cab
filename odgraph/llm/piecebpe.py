"""Encoding and decoding with a merge-type (BPE) SentencePiece model.

The model file gives pieces with scores.  The encoding of a text is what
merging yields: begin with single characters and join, again and again, the
neighbours whose concatenation is the piece of the highest score (the leftmost
of equal ones).  It is found here without merging the text.  A sequence of
pieces is that encoding exactly when every two neighbours are *compatible*,
that is when merging their concatenation alone gives the two back: the first
join across a border would happen in the two alone as well.  So the text is
covered from the left by backtracking:

* one Aho-Corasick pass leaves the longest piece that begins at each position,
  and a table gives each piece its longest proper prefix that is a piece;
* the longest piece compatible with the one before it is taken; where none is,
  the last piece gives way to its next shorter prefix;
* the pieces before a position are the encoding of the text before it, so a
  position that fails once fails for ever: it is marked in a bitfield.

Characters that are in no piece stand alone as their UTF-8 bytes.  Where no
piece of the model has a blank after another character, a join never crosses
such a place, so the text is cut there.  The short cuts of many texts are
covered side by side, one step of all of them at a time, and kept in a bounded
memo; a long cut is covered by itself.

Nulls and texts that are empty encode to no ids; bytes that are not UTF-8
count as U+FFFD.  Texts of any length are encoded whole.
"""

from __future__ import annotations

import struct
from array import array
from collections import defaultdict
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odgraph.llm.common import slices, utf8

BLANK = "▁"
#: Kinds of pieces in a model file (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: A model file is sent to every worker whole, so its size is bounded.
MAX_MODEL_BYTES = 64 << 20
#: Bounds of what a worker remembers: cuts, characters a cut on average, pairs of pieces.
MEMO, MEMO_CHARS, PAIRS = 1 << 18, 16, 1 << 19
#: Longest cut that is covered side by side with others, and characters of them at once.
SHORT, TOGETHER = 64, 1 << 18


def _fields(message: bytes):
    """``(number, value)`` of the fields of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            n = varint() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
            yield key >> 3, message[at:at + n]
            at += n


class Vocabulary:
    """The pieces, scores and kinds of a model file, by id."""

    def __init__(self, model: bytes):
        if len(model) > MAX_MODEL_BYTES:
            raise ValueError(f"model file of more than {MAX_MODEL_BYTES} bytes")
        self.pieces, self.scores, self.kinds = [], [], []
        trainer, normalizer = {}, {}
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        self.prefix = bool(normalizer.get(3, 1))
        self.unknown = trainer.get(44, " ⁇ ".encode()).decode()
        if trainer.get(3, 1) != 2 or not trainer.get(35, 0) or trainer.get(24, 0):
            raise ValueError("not a merge-type model with byte fallback and blanks before words")
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("the model rewrites its text (normalisation rules or removal of blanks)")
        if {USER, UNUSED} & set(self.kinds):
            raise ValueError("the model has user-defined or unused pieces")

    @classmethod
    def read(cls, path: str) -> "Vocabulary":
        with open(path, "rb") as f:
            return cls(f.read(MAX_MODEL_BYTES + 1))


class Matcher:
    """An Aho-Corasick automaton that is walked over many texts side by side.

    Its transitions are an open-addressed hash table of (state, letter)."""

    def __init__(self, texts: list[str]):
        letters = sorted({c for t in texts for c in t})
        self.letter = np.zeros(0x110000, dtype=np.int32)  # 0: in no text
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.width = len(letters) + 1
        number = {c: i + 1 for i, c in enumerate(letters)}
        goto: dict[int, int] = {}
        out, level = [-1], [(0, 0, list(range(len(texts))))]
        fail, link = [0], [0]  # link: the longest shorter state that ends a text
        while level:
            following = []
            for state, depth, members in level:
                children: dict[str, list] = {}
                for k in members:
                    if len(texts[k]) > depth:
                        children.setdefault(texts[k][depth], []).append(k)
                for c, group in children.items():
                    new, key = len(out), number[c]
                    back = fail[state]
                    while back and back * self.width + key not in goto:
                        back = fail[back]
                    back = goto.get(back * self.width + key, 0) if state else 0
                    out.append(next((k for k in group if len(texts[k]) == depth + 1), -1))
                    fail.append(back)
                    link.append(back if out[back] >= 0 else link[back])
                    goto[state * self.width + key] = new
                    following.append((new, depth + 1, group))
            level = following
        self.out, self.fail, self.link = np.array(out), np.array(fail), np.array(link)
        self.sizes = np.array([len(t) for t in texts])
        self.longest_text = int(self.sizes.max()) if len(texts) else 0
        self.mask = (1 << max(4, (4 * len(goto)).bit_length())) - 1
        self.keys = np.full(self.mask + 1, -1, dtype=np.int64)
        self.states = np.zeros(self.mask + 1, dtype=np.int32)
        keys, states = np.array(list(goto), dtype=np.int64), np.array(list(goto.values()), dtype=np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[free]  # of several for one slot the last one gets it
            won = self.keys[slot] == keys
            self.states[slot[won]] = states[won]
            keys, states, slot = keys[~won], states[~won], (slot[~won] + 1) & self.mask

    def _slot(self, keys):
        return (keys * 0x9E3779B1 >> 15) & self.mask

    def _goto(self, state, letter):
        """The states after a letter each; 0 where no text goes on."""
        state = np.where(letter > 0, state, 0)
        to = np.zeros(len(state), dtype=np.int64)
        todo = np.flatnonzero(letter > 0)
        while len(todo):
            keys = state[todo] * self.width + letter[todo]
            slot = self._slot(keys)
            live = np.arange(len(todo))
            missing = []
            while len(live):
                there = self.keys[slot[live]]
                hit = there == keys[live]
                to[todo[live[hit]]] = self.states[slot[live[hit]]]
                missing.append(live[there < 0])
                live = live[~hit & (there >= 0)]
                slot[live] = (slot[live] + 1) & self.mask
            todo = todo[np.concatenate(missing)]
            todo = todo[state[todo] > 0]
            state[todo] = self.fail[state[todo]]
        return to

    def longest(self, letters: np.ndarray, start: np.ndarray, size: np.ndarray, own: int) -> np.ndarray:
        """The longest text that begins at each position of ``letters`` (-1: none),
        walking the stretches ``start, size`` side by side; a stretch answers for its
        first ``own`` positions and reads on to see the texts that begin there."""
        out = np.full(len(letters), -1, dtype=np.int32)
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        state = np.zeros(len(start), dtype=np.int64)
        for t in range(int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -t, side="left"))
            here = start[:n] + t
            state = self._goto(state[:n], letters[here])
            found = np.where(self.out[state] >= 0, state, self.link[state])
            live = np.flatnonzero(found)
            while len(live):  # ends rise, so the last text found at a position is its longest
                k = self.out[found[live]]
                at = here[live] + 1 - self.sizes[k]
                mine = at < start[live] + own
                out[at[mine]] = k[mine]
                found[live] = self.link[found[live]]
                live = live[found[live] > 0]
        return out


class Encoder:
    """Encodes texts with a :class:`Vocabulary`; one is built in each worker.

    Inside, pieces are numbered ``0..``: the pieces that merging can reach,
    and the characters of pieces that are no piece themselves.
    """

    _built: dict[str, "Encoder"] = {}

    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        self.prefix = v.prefix
        self.bytes = {v.pieces[i]: i for i, k in enumerate(v.kinds) if k == BYTE}
        if len(self.bytes) != 256:
            raise ValueError("not one piece for each byte")
        ids = {v.pieces[i]: i for i, k in enumerate(v.kinds) if k == NORMAL and v.pieces[i]}
        self.score = {text: v.scores[i] for text, i in ids.items()}
        single = {c: -1 for text in ids for c in text if c not in ids}
        self.texts = [t for t in {**ids, **single} if len(t) == 1 or self.merged(t) == [t]]
        number = {t: k for k, t in enumerate(self.texts)}
        self.ids = [(ids[t],) if t in ids else self._fallback(t) for t in self.texts]
        self.size = [len(t) for t in self.texts]
        self.shorter = [next((number[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in number), -1)
                        for t in self.texts]
        self.sizes, self.shorters = np.array(self.size), np.array(self.shorter)
        self.find = Matcher(self.texts)
        inner = any(BLANK in t.lstrip(BLANK) for t in ids)
        self.cutting = not inner
        # pairs of pieces whose border is known to stay or not: sorted keys and answers
        self.keys, self.fits = np.empty(0, dtype=np.int64), np.empty(0, dtype=bool)
        self.pairs: dict[int, bool] = {}
        self._forget([], np.empty(0, dtype=np.int32), np.zeros(1, dtype=np.int64))

    def _forget(self, words: list[str], ids: np.ndarray, first: np.ndarray):
        """Remember these cuts, and no others: their ids are ``ids[first[i]:first[i + 1]]``."""
        self.memo: defaultdict[str, int] = defaultdict(count(len(words)).__next__, zip(words, range(len(words))))
        self.flat, self.first = ids, first
        self.chars = sum(map(len, words))

    @classmethod
    def of(cls, vocabulary: Vocabulary, key: str) -> "Encoder":
        if key not in cls._built:
            cls._built = {key: cls(vocabulary)}
        return cls._built[key]

    def _fallback(self, text: str) -> tuple:
        return tuple(self.bytes[f"<0x{b:02X}>"] for b in text.encode())

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging."""
        parts, none, score = list(text), float("-inf"), self.score.get
        scores = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while scores and (best := max(scores)) > none:
            i = scores.index(best)  # the leftmost
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = score(parts[i - 1] + parts[i], none)
            if i < len(scores):
                scores[i] = score(parts[i] + parts[i + 1], none)
        return parts

    def _stays(self, key: int) -> bool:
        left, right = self.texts[key // len(self.texts)], self.texts[key % len(self.texts)]
        return self.merged(left + right) == [left, right]

    def compatible(self, pairs: np.ndarray) -> np.ndarray:
        """Whether merging keeps the border of each pair of pieces ``a * len(texts) + b``."""
        at = np.searchsorted(self.keys, pairs)
        new = at == len(self.keys)
        new[~new] = self.keys[at[~new]] != pairs[~new]
        if new.any():
            if len(self.keys) > PAIRS:
                known = np.unique(at[~new])
                self.keys, self.fits = self.keys[known], self.fits[known]
            fresh = np.unique(pairs[new])
            at = np.searchsorted(self.keys, fresh)
            answers = np.array([self._stays(key) for key in fresh.tolist()])
            self.keys, self.fits = np.insert(self.keys, at, fresh), np.insert(self.fits, at, answers)
            at = np.searchsorted(self.keys, pairs)
        return self.fits[at]

    def covered(self, longest: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Covers the stretches from ``start`` to ``stop`` side by side; gives the
        piece that begins at each position, -1 inside pieces."""
        n, many = len(longest), len(self.texts)
        piece, came = np.full(n + 1, -1, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
        failed, any_failed = np.zeros((n >> 3) + 1, dtype=np.uint8), False
        at, last, k = start.copy(), np.full(len(start), -1), longest[start].astype(np.int64)
        live = np.arange(len(start))
        while len(live):
            here, before, take = at[live], last[live], k[live]
            end = here + self.sizes[take]
            fits = take >= 0
            if any_failed:
                fits &= failed[end >> 3] >> (end & 7).astype(np.uint8) & 1 == 0
            ask = np.flatnonzero(fits & (before >= 0))
            if len(ask):
                fits[ask] = self.compatible(before[ask] * many + take[ask])
            on = live[fits]
            piece[here[fits]] = take[fits]
            came[end[fits]] = here[fits]
            at[on], last[on] = end[fits], take[fits]
            k[on] = longest[np.minimum(end[fits], n - 1)]
            less = ~fits & (take >= 0)
            k[live[less]] = self.shorters[take[less]]
            back = take < 0
            if (here[back] == start[live[back]]).any():
                raise AssertionError("a text that merging does not cover")
            if back.any():  # the position fails: its last piece gives way to a shorter one
                any_failed = True
                p, rows = here[back], live[back]
                np.bitwise_or.at(failed, p >> 3, np.uint8(1) << (p & 7).astype(np.uint8))
                p = came[p]
                k[rows] = self.shorters[piece[p]]
                at[rows] = p
                last[rows] = np.where(p == start[rows], -1, piece[came[p]])
            live = live[at[live] < stop[live]]
        out = np.full(n, -1, dtype=np.int64)
        at, live = start.copy(), np.arange(len(start))
        while len(live):
            here = at[live]
            out[here] = piece[here]
            at[live] = here + self.sizes[piece[here]]
            live = live[at[live] < stop[live]]
        return out

    def one(self, longest: np.ndarray, start: int, stop: int) -> tuple[list[int], list[int]]:
        """As :meth:`covered` for one long stretch: its positions and pieces."""
        size, shorter, many, pairs = self.size, self.shorter, len(self.texts), self.pairs
        longest = array("i", longest[start:stop].tobytes())
        n = stop - start
        failed = bytearray((n >> 3) + 1)
        path, places, last, at, k = [], [], -1, 0, longest[0]
        while True:
            while k >= 0:
                end = at + size[k]
                if not failed[end >> 3] >> (end & 7) & 1:
                    key = last * many + k
                    fits = last < 0 or pairs.get(key)
                    if fits is None:
                        if len(pairs) > PAIRS:
                            pairs.clear()
                        fits = pairs[key] = self._stays(key)
                    if fits:
                        break
                k = shorter[k]
            if k >= 0:
                path.append(k)
                places.append(start + at)
                if end == n:
                    return places, path
                at, last, k = end, k, longest[end]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                k = path.pop()
                last = path[-1] if path else -1
                at = places.pop() - start
                k = shorter[k]

    def cut(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of cuts, each encoded by itself, one after the other, and where each one's begin."""
        text = "".join(parts)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        letters = self.find.letter[codes]
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        ends = np.cumsum(sizes)
        # matches do not cross cuts; long cuts are walked in overlapping blocks
        blocks = -(-sizes // SHORT)
        start = np.repeat(ends - sizes, blocks) + (np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * SHORT
        longest = self.find.longest(letters, start, np.minimum(np.repeat(ends, blocks) - start, SHORT + self.find.longest_text - 1), SHORT)
        # stretches of known characters inside a cut
        known = longest >= 0
        first, last = known.copy(), known.copy()
        first[1:] &= ~known[:-1]
        first[ends - sizes] = known[ends - sizes]
        last[:-1] &= ~known[1:]
        last[ends - 1] = known[ends - 1]
        begin, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
        long = stop - begin > SHORT
        found = self.covered(longest, begin[~long], stop[~long])
        for a, b in zip(begin[long].tolist(), stop[long].tolist()):
            places, path = self.one(longest, a, b)
            found[places] = path
        # characters of no piece are numbered after the pieces
        strange, which = np.unique(codes[~known], return_inverse=True)
        found[~known] = len(self.texts) + which
        ids = self.ids + [self._fallback(chr(c)) for c in strange.tolist()]
        number = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        place = np.flatnonzero(found >= 0)
        flat, _ = _spread(np.fromiter(chain.from_iterable(ids), dtype=np.int32), np.cumsum(number) - number, number, found[place])
        upto = np.append(0, np.cumsum(number[found[place]]))
        return flat, upto[np.searchsorted(place, ends - sizes)]

    def parts(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The cuts of all texts with blanks as spaces, one after the other, and the
        number of each text's.  A cut begins with the text or with a run of blanks."""
        rows = [((" " if self.prefix else "") + t.replace(BLANK, " ")).encode() if t else b"" for t in texts]
        data = np.frombuffer(b"".join(rows), dtype=np.uint8)
        ends = np.cumsum([0] + [len(r) for r in rows])
        starts = np.zeros(len(data) + 1, dtype=bool)
        if self.cutting:
            blank = data == 32
            starts[1:-1] = blank[1:] & ~blank[:-1]
        starts[ends] = True
        at = np.flatnonzero(starts)
        cuts = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(data))
        return cuts, np.diff(np.searchsorted(at, ends))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of each text's."""
        cuts, parts = self.parts(texts)
        cuts = cuts.dictionary_encode()  # each different cut is looked up once
        known = len(self.memo)
        words = cuts.dictionary.to_numpy(zero_copy_only=False).tolist()
        which = np.fromiter(map(self.memo.__getitem__, words), dtype=np.int64, count=len(words))
        which = which[cuts.indices.to_numpy()]
        fresh, held, chars = [], [self.flat], 0
        firsts, size = [self.first[:-1]], len(self.flat)

        def settle():
            nonlocal fresh, size
            flat, first = self.cut([part.replace(" ", BLANK) for part in fresh])
            held.append(flat)
            firsts.append(first + size)
            size += len(flat)
            fresh = []

        for part in islice(self.memo, known, None):
            fresh.append(part)
            chars += len(part)
            self.chars += len(part)
            if chars >= TOGETHER:
                settle()
                chars = 0
        if fresh:
            settle()
        if len(held) > 1:
            self.flat, self.first = np.concatenate(held), np.concatenate([*firsts, [size]])
        ids, number = _spread(self.flat, self.first[:-1], np.diff(self.first), which)
        upto = np.append(0, np.cumsum(number))
        ends = np.cumsum(np.append(0, parts))
        if len(self.memo) > MEMO or self.chars > MEMO * MEMO_CHARS:
            self._keep(np.bincount(which, minlength=len(self.memo)))
        return ids, np.diff(upto[ends])

    def _keep(self, times: np.ndarray):
        """Forget all cuts but those of the last texts, or, if they are too many, but those
        that came several times in them, and these as well if they are too many."""
        words = list(self.memo)
        for least in (1, 2, 4, 8):
            used = np.flatnonzero(times >= least)
            kept = [words[i] for i in used.tolist()]
            if len(kept) <= MEMO // 2 and sum(map(len, kept)) <= MEMO * MEMO_CHARS // 2:
                break
        else:
            kept, used = [], used[:0]
        ids, number = _spread(self.flat, self.first[:-1], np.diff(self.first), used)
        self._forget(kept, ids, np.append(0, np.cumsum(number)))


def _spread(flat: np.ndarray, first: np.ndarray, number: np.ndarray, which: np.ndarray):
    """The runs ``flat[first:first + number]`` of ``which``, joined, and their lengths."""
    length = number[which]
    ends = np.cumsum(length)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[which] - (ends - length), length)
    return flat[at], length


class Decoder:
    """Decodes ids: blanks become spaces, the blank that encoding put before the
    text goes, runs of byte pieces become text (each byte that is no UTF-8
    becomes U+FFFD), control pieces are empty; an id that the model lacks
    counts as the unknown piece."""

    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        self.prefix, self.kinds = v.prefix, v.kinds
        self.controls = {i for i, k in enumerate(v.kinds) if k == CONTROL}
        self.unknown = v.unknown.encode()
        self.surface = []
        for piece, kind in zip(v.pieces, v.kinds):
            self.surface.append(
                bytes([int(piece[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL
                else self.unknown if kind == UNKNOWN else piece.replace(BLANK, " ").encode())

    def decode(self, ids: list[int]) -> str:
        if self.controls.isdisjoint(ids):
            return self._run(ids, True)
        # a control piece ends a run of bytes
        out, start, seen = [], 0, False
        for i in [i for i, k in enumerate(ids) if k in self.controls] + [len(ids)]:
            if i > start:
                out.append(self._run(ids[start:i], not seen))
                seen = True
            start = i + 1
        return "".join(out)

    def _run(self, ids: list[int], first: bool) -> str:
        try:
            whole = b"".join(map(self.surface.__getitem__, ids)) if not ids or min(ids) >= 0 else None
        except IndexError:
            whole = None
        if whole is None:
            whole = b"".join(self.surface[i] if 0 <= i < len(self.surface) else self.unknown for i in ids)
        if first and self.prefix and whole[:1] == b" " and 0 <= ids[0] < len(self.kinds) and self.kinds[ids[0]] == NORMAL:
            whole = whole[1:]
        try:
            return whole.decode()
        except UnicodeDecodeError:
            # every piece but bytes is whole UTF-8, so only byte runs can fail
            out = []
            while whole:
                try:
                    out.append(whole.decode())
                    break
                except UnicodeDecodeError as e:
                    out.append(whole[:e.start].decode() + "�")
                    whole = whole[e.start + 1:]
            return "".join(out)


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text",
           carry: tuple[Column, ...] = ()) -> DataFrame:
    """``docs``' id, the columns in ``carry`` and ``ids`` (array of int) for every
    row; repeated rows and null ids stay, null and empty texts have no ids, an
    empty table gives an empty one.  Other columns of ``docs`` may have any names."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(vocabulary)
    key = f"{spark.sparkContext.applicationId}-{held._jbroadcast.id()}"
    rows = docs.select(F.col(id_col), *carry, F.col(text_col).cast("string").alias("_text"))
    last = len(rows.columns) - 1

    def run(batches):
        encoder = Encoder.of(held.value, key)
        for batch in batches:
            for part in slices(batch, last, 4 << 20):
                ids, number = encoder.encode(["" if x is None else x.decode("utf-8", "replace") for x in utf8(part.column(last))])
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(number)), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns[:last], lists], [*part.schema.names[:last], "ids"])

    schema = T.StructType([*rows.schema.fields[:last], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", max_ids: int = 1 << 19) -> DataFrame:
    """``rows`` with the last column ``decoded``: the text of the array of ids in
    ``ids_col`` (null: null; none: empty).  A column ``decoded`` of ``rows`` is replaced."""
    held = rows.sparkSession.sparkContext.broadcast(vocabulary)
    rows = rows.drop("decoded") if "decoded" in rows.columns else rows
    at = rows.columns.index(ids_col)

    def run(batches):
        decoder = Decoder(held.value)
        for batch in batches:
            sizes = pc.list_value_length(batch.column(at)).fill_null(0).to_numpy(zero_copy_only=False)
            groups = (np.cumsum(sizes) - sizes) // max_ids  # rows of about max_ids ids; a longer text is a row of its own
            cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts, cuts[1:]):
                part = batch.slice(start, end - start)
                texts = [None if x is None else decoder.decode([-1 if k is None else k for k in x] if None in x else x)
                         for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                 [*part.schema.names, "decoded"])

    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(run, schema)
