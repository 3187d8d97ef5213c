"""Byte-level BPE encoding and decoding.

Pre-tokenisation without a regular expression: each code point gets a class
(letter, number, other, kinds of white space and of apostrophes; what the
pattern looks ahead to is part of the class), and a class is a function on the
states of a small automaton. Functions compose associatively, so a batch is
scanned in blocks side by side: functions of the blocks, a prefix scan over the
blocks, then the states inside each block. A token starts where state and class
say so. Token slices are merged by rank, new distinct slices side by side and
each once (cached), and the slices' places in an array of ids are kept, so ids and their bytes are put
together by array operations.

The automaton is that of the pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.

Result for special rows: NULL and empty text has no ids and decodes to empty
bytes; repeated rows and ids are encoded each by itself; an empty table gives
an empty result. Columns other than the id and the text are not read, so their
names can't clash.
"""

from __future__ import annotations

import base64
import functools
import itertools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnlog.llm import text as X
from learnlog.llm.merges import Pairs

#: Distinct slices that a task keeps the ids of; then the cache starts anew.
CACHE_SLICES = 200_000
BLOCK = 64

# Classes of code points, with what follows.
PART, LETTER, NUMBER, OTHER, QUOTE2, QUOTE3, JOINING, SPACES, LAST = range(9)
# States: what the token is that the last code point belongs to.
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACES, JOINS, ONE_MORE, TWO_MORE, ENDED = range(9)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """``next[class, state]`` and ``begins[class, state]``: does this code point begin a token."""
    to, begins = np.zeros((9, 9), np.uint8), np.ones((9, 9), bool)
    alone = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, QUOTE2: ONE_MORE, QUOTE3: TWO_MORE,
             JOINING: JOINS, SPACES: IN_SPACES, LAST: ENDED, PART: START}
    for c, s in alone.items():
        to[c] = s
    # runs go on, and a joining space takes a run in; an apostrophe there is nothing special
    for c, run in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS), (QUOTE2, IN_OTHERS), (QUOTE3, IN_OTHERS)):
        for s in (run, JOINS):
            to[c, s], begins[c, s] = run, False
    to[SPACES, IN_SPACES], begins[SPACES, IN_SPACES] = IN_SPACES, False
    for c in range(1, 9):
        to[c, ONE_MORE], begins[c, ONE_MORE] = ENDED, False
        to[c, TWO_MORE], begins[c, TWO_MORE] = ONE_MORE, False
    return to, begins


_NEXT, _BEGINS = _automaton()

# Code points of Unicode's White_Space property.
_WHITE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@functools.lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """LETTER, NUMBER, OTHER or SPACES of every code point."""
    first = {"L": LETTER, "N": NUMBER}
    kind = np.fromiter((first.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000)
    kind[_WHITE] = SPACES
    return kind


def code_point_classes(points: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Class of each code point; ``part`` marks those that part the texts."""
    n = len(points)
    cls = _kinds()[points]
    cls[part] = PART
    after = np.concatenate([points[1:], np.zeros(3, points.dtype)])
    edge = np.concatenate([part[1:], np.ones(3, bool)])
    quote = np.flatnonzero((points == 0x27) & ~part)
    one, two = np.where(edge[quote], 0, after[quote]), np.where(edge[quote] | edge[quote + 1], 0, after[quote + 1])
    cls[quote[np.isin(one, [ord(c) for c in "stmd"])]] = QUOTE2
    cls[quote[((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))]] = QUOTE3
    follow = np.concatenate([cls[1:], np.full(1, PART, np.uint8)])[:n]
    solid = (follow != SPACES) & (follow != PART)
    cls[(cls == SPACES) & solid] = LAST
    cls[(cls == LAST) & (points == 0x20)] = JOINING
    return cls


def token_starts(cls: np.ndarray) -> np.ndarray:
    """Which code points begin a token."""
    n = len(cls)
    lanes = -(-n // BLOCK) or 1
    c = np.ascontiguousarray(np.pad(cls, (0, lanes * BLOCK - n)).reshape(lanes, BLOCK).T).astype(np.intp) * 9
    flat, begins = _NEXT.ravel(), _BEGINS.ravel()
    # the function of each block: where each state leads
    f = np.tile(np.arange(9, dtype=np.uint8), (lanes, 1))
    for j in range(BLOCK):
        f = flat[c[j][:, None] + f]
    # prefix scan of the functions over the blocks
    step = 1
    while step < lanes:
        f[step:] = np.take_along_axis(f[step:], f[:-step], 1)
        step *= 2
    s = np.concatenate([np.full(1, START, np.uint8), f[:-1, START]])
    out = np.empty((BLOCK, lanes), bool)
    for j in range(BLOCK):
        at = c[j] + s
        out[j] = begins[at]
        s = flat[at]
    return out.T.ravel()[:n]


def slice_bounds(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All bytes, the byte at which each token starts and ends, and the number of tokens of each text."""
    raw = b"\0".join([*texts, b""])
    points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32).astype(np.int64)
    width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
    place = np.concatenate([[0], np.cumsum(width)])
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    part = np.zeros(len(points), bool)
    part[np.searchsorted(place, ends)] = True
    first = np.flatnonzero(token_starts(code_point_classes(points, part)))
    begin, end = place[first], np.append(place[first[1:]], len(raw))
    token = ~part[first]
    begin, end = begin[token], end[token]
    return raw, np.stack([begin, end]), np.diff(np.searchsorted(begin, np.concatenate([[0], ends + 1])))


class Tokens:
    """The tokens of a vocabulary file by rank: what decoding needs."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.tokens = [b""] * (max(int(rank) for _, rank in pairs) + 1)
        for token, rank in pairs:
            self.tokens[int(rank)] = base64.b64decode(token)
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.begin = np.concatenate([[0], np.cumsum([len(t) for t in self.tokens])])

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids, one after the other; the bounds of each id's."""
        return gather(self.bytes, self.begin, ids.astype(np.int64))


class Ranks(Tokens):
    """Ranks of a vocabulary file, with the ids of slices that were seen."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.ranks = {token: rank for rank, token in enumerate(self.tokens) if token}
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        # every way to put a token together from two
        pairs = np.fromiter((x for t, rank in self.ranks.items() for k in range(1, len(t))
                             if t[:k] in self.ranks and t[k:] in self.ranks
                             for x in (self.ranks[t[:k]], self.ranks[t[k:]], rank)), np.int32)
        left, right, joined = pairs.reshape(-1, 3).T
        self.pairs = Pairs(left, right, joined, joined)
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.ids, self.begins = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of slices, one after the other; their bounds. A slice that is a token is that token."""
        whole = np.array([self.ranks.get(p, -1) for p in pieces], np.int64)
        size = np.array([len(p) for p in pieces], np.int64)
        apart = whole < 0
        data = np.frombuffer(b"".join(pieces), np.uint8)[np.repeat(apart, size)]
        ids, bounds = self.pairs.merge(self.of_byte[data], np.concatenate([[0], np.cumsum(np.where(apart, size, 0))]))
        count = np.where(apart, np.diff(bounds), 1)
        ends = np.concatenate([[0], np.cumsum(count)])
        out = np.empty(ends[-1], np.uint32)
        out[np.repeat(apart, count)] = ids
        out[ends[:-1][~apart]] = whole[~apart]
        return out, ends

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other; their bounds."""
        raw, (begin, end), count = slice_bounds(texts)
        pieces = [raw[a:b] for a, b in zip(begin.tolist(), end.tolist())]
        if len(self.place) > CACHE_SLICES:
            self.clear()
        index = np.fromiter(map(self.place.get, pieces, itertools.repeat(-1)), np.int64, len(pieces))
        unknown = np.flatnonzero(index < 0)
        if len(unknown):
            found = [pieces[i] for i in unknown.tolist()]
            new = list(dict.fromkeys(found))
            merged, bounds = self.merge(new)
            known = len(self.place)
            self.place.update(zip(new, range(known, known + len(new))))
            self.begins = np.concatenate([self.begins, self.begins[-1] + bounds[1:]])
            self.ids = np.concatenate([self.ids, merged])
            index[unknown] = np.fromiter(map(self.place.__getitem__, found), np.int64, len(found))
        ids, bounds = gather(self.ids, self.begins, index)
        return ids, bounds[np.concatenate([[0], np.cumsum(count)])]


def gather(values: np.ndarray, begin: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``values[begin[i]:begin[i + 1]]`` for each ``i`` of ``index``, one after the other; their bounds."""
    size = begin[index + 1] - begin[index]
    bounds = np.concatenate([[0], np.cumsum(size)])
    return values[np.arange(bounds[-1]) + np.repeat(begin[index] - bounds[:-1], size)], bounds


@functools.lru_cache(maxsize=2)
def _ranks(path: str) -> Ranks:
    return Ranks(path)


@functools.lru_cache(maxsize=2)
def _tokens(path: str) -> Tokens:
    return Tokens(path)


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, ids)``: the ids as little-endian unsigned 32-bit integers, a row per row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks(path)
        for batch in batches:
            texts = X.as_bytes(batch["_text"])
            for a, b in X.slices(texts):
                ids, bounds = ranks.encode(texts[a:b])
                data = ids.astype("<u4").tobytes()
                yield pa.record_batch([batch["_id"][a:b], pa.array(np.diff(bounds), pa.int64()), pa.array(
                    [data[4 * x:4 * y] for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary())], names=[id_col, "n_tokens", "ids"])

    schema = T.StructType([docs.schema[id_col], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).mapInArrow(run, schema)


def bpe_decode(encoded: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of its ids as ``out_col``; NULL ids: NULL."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(path)
        for batch in batches:
            X.release_memory()
            rows = batch[ids_col].to_pylist()
            for a, b in X.slices([r or b"" for r in rows]):
                part = [r or b"" for r in rows[a:b]]
                data, bounds = tokens.decode(np.frombuffer(b"".join(part), "<u4"))
                raw, ends = data.tobytes(), bounds[np.concatenate([[0], np.cumsum([len(p) // 4 for p in part])])].tolist()
                out = [None if r is None else raw[x:y] for r, x, y in zip(rows[a:b], ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, pa.array(out, pa.binary())], names=[*batch.schema.names, out_col])

    if out_col in encoded.columns:
        raise ValueError(f"{out_col} is already a column")
    return encoded.mapInArrow(run, T.StructType([*encoded.schema, T.StructField(out_col, T.BinaryType())]))
