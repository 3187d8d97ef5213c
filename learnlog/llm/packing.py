"""Packing of tokenised documents by best-fit decreasing.

Each task tokenises its documents and packs them in groups of about
``GROUP_TOKENS`` tokens: documents above the sequence length are first cut into
full windows, the pieces are sorted by falling length, and a segment tree over
remaining capacities gives the tightest open window that has room. Nothing is
shuffled; a group's last windows are what padding there is.

Tokens are those of a ``tokenizers`` file without special tokens, then the
end-of-document id. Normalisation, splitting and merges of such a file never
reach across ASCII white space, so each run of other characters (a word) is
encoded once and cached, new words side by side; a file with other rules is
left to the library.

Result for special rows: NULL and empty text is the end-of-document id alone;
repeated rows and ids are packed each by itself; an empty table gives an empty
result. Columns other than the id and the text are not read, so their names
can't clash. Sequence numbers are unique; a task numbers its own from its
partition's number times 2**33.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnlog.llm import text as X
from learnlog.llm.merges import Pairs

LENGTH = 4096
END_ID = 2
#: Tokens of a group of documents that a task packs together; bounds its memory.
GROUP_TOKENS = 2 << 20
#: Distinct words that a task keeps the ids of; then the cache starts anew.
CACHE_WORDS = 400_000


# What the file says of normalisation and splitting, as ``WordEncoder`` does it.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


class WordEncoder:
    """Ids of texts, by cached ids of their words.

    Words of printable characters that are Latin as they stand and in lower case
    (without a special token's ``<|``), which normalisation only puts in lower case,
    are split and merged here, side by side, by the file's vocabulary and merges; the
    library encodes the others, and everything if the file has other rules.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        #: Whether the file does to texts what is assumed here; else the library encodes them whole.
        self.known_rules = (content["normalizer"], content["pre_tokenizer"]) == (NORMALIZER, PRE_TOKENIZER) and {
            k: v for k, v in model.items() if k not in ("type", "vocab", "merges") and v} == {"end_of_word_suffix": "</w>"}
        if not self.known_rules:
            return
        ids = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        rank = {(ids[a], ids[b]): (k, ids[a + b]) for k, (a, b) in enumerate(merges)}
        left, right = np.array(list(rank), np.int32).T
        self.pairs = Pairs(left, right, *np.array(list(rank.values()), np.int32).T)
        self.inner, self.last = (np.array([ids[c + end] for c in _byte_letters()], np.int32) for end in ("", "</w>"))
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.ids, self.begins = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def learn(self, words: list[bytes]) -> None:
        """Add words that are not known yet."""
        plain, other = [], []
        for w in words:
            t = w.decode()
            (plain if max(t + t.lower()) <= LATIN and t.isprintable() and "<|" not in t else other).append(w)
        ids, bounds = self._merge_latin(b"\n".join([*plain, b""]).decode().lower(), len(plain))
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast([w.decode() for w in other], add_special_tokens=False)] if other else []
        known = len(self.place)
        self.place.update(zip([*plain, *other], range(known, known + len(words))))
        sizes = np.concatenate([np.diff(bounds), [len(e) for e in encoded]]).astype(np.int64)
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32), np.array([i for e in encoded for i in e], np.uint32)])
        self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(sizes)])

    def _merge_latin(self, text: str, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the ``n`` lines, printable Latin words in lower case, and their bounds."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        kind = _LATIN_KIND[points]
        first = np.ones(len(points), bool)
        first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
        # an apostrophe that begins a run takes in s, t, m, d, re, ve or ll
        follow = np.concatenate([points, np.zeros(3, np.int64)])
        quote = np.flatnonzero(first & (points == 0x27))
        for suffix in ("s", "t", "re", "ve", "m", "ll", "d"):
            at = quote[np.all([follow[quote + 1 + k] == ord(c) for k, c in enumerate(suffix)], axis=0)]
            first[at + 1] = False
            first[at + 1 + len(suffix)] = True
        inside = kind != _END
        first &= inside
        final = np.append(first[1:] | ~inside[1:], True)
        # from code points to bytes: a token's last byte is the last one of its last code point
        width = 1 + (points >= 0x80)
        place = np.concatenate([[0], np.cumsum(np.where(inside, width, 0))])
        data = np.frombuffer(text.encode(), np.uint8)
        data = data[data != 10]
        last = np.zeros(len(data), bool)
        last[place[1:][final & inside] - 1] = True
        begin = np.flatnonzero(first)
        ids, bounds = self.pairs.merge(np.where(last, self.last[data], self.inner[data]), np.append(place[begin], len(data)))
        lines = np.concatenate([[0], np.flatnonzero(~inside) + 1])
        return ids, bounds[np.searchsorted(begin, lines)]

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``end_id``; bounds of each text."""
        if not self.known_rules:
            whole = [[*e.ids, end_id] for e in self.tokenizer.encode_batch([t.decode() for t in texts], add_special_tokens=False)]
            return np.array([i for e in whole for i in e], np.uint32), np.cumsum([0] + [len(e) for e in whole])
        flat, count = _words(texts)
        if len(self.place) > CACHE_WORDS:
            self.clear()
        index = np.fromiter(map(self.place.get, flat, itertools.repeat(-1)), np.int64, len(flat))
        unknown = np.flatnonzero(index < 0)
        if len(unknown):
            new = [flat[i] for i in unknown.tolist()]
            self.learn(list(dict.fromkeys(new)))
            index[unknown] = np.fromiter(map(self.place.__getitem__, new), np.int64, len(new))
        size = self.begins[index + 1] - self.begins[index]
        bounds = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(bounds[-1]) + np.repeat(self.begins[index] - bounds[:-1], size)
        ends = bounds[np.cumsum(count)]
        ids = np.insert(self.ids[at], ends, np.uint32(end_id))
        return ids, np.concatenate([[0], ends + np.arange(1, len(texts) + 1)])


def _words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Words of all texts and their number per text, with ASCII letters in lower
    case and a mark after a word as a word of its own: both are what the file
    does to them in any case, and make fewer words distinct. Texts that may hold
    a special token, which only counts as it is written, are just split."""
    raw = b"\n".join([*texts, b""])
    if b"<|" in raw:
        words = [t.split() for t in texts]
        return list(itertools.chain.from_iterable(words)), np.array([len(w) for w in words], np.int64)
    data = np.frombuffer(raw.lower(), np.uint8)
    space = _SPACE[data]
    mark = np.zeros(len(data), bool)
    mark[1:-1] = _MARK[data[1:-1]] & space[2:] & (data[:-2] >= 97) & (data[:-2] <= 122)
    # a word begins after white space, and at a mark
    begins = np.flatnonzero(~space & (np.concatenate([[True], space[:-1]]) | mark))
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    apart = np.insert(data, np.flatnonzero(mark), np.uint8(0x20))
    return apart.tobytes().split(), np.diff(np.searchsorted(begins, bounds))


_SPACE, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MARK[list(b".,;:?!")] = True
#: Words up to this character are split and merged here: letters and numbers are the same in every version of Unicode.
LATIN = "\u024f"
_LETTER, _NUMBER, _OTHER, _END = range(4)
_LATIN_KIND = np.array([{"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(i))[0], _OTHER) for i in range(ord(LATIN) + 1)], np.uint8)
_LATIN_KIND[10] = _END


def _byte_letters() -> list[str]:
    """The character that stands for each byte in the file: itself if it is printable and no space, else the next from 256 on."""
    out, spare = [], 256
    for b in range(256):
        if 33 <= b < 127 or 161 <= b < 256 and b != 173:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


class Windows:
    """Open windows by remaining capacity: a segment tree over 0..length."""

    def __init__(self, length: int) -> None:
        self.size = 1 << length.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, capacity: int, window: int) -> None:
        self.open[capacity].append(window)
        k = capacity + self.size
        while k:
            self.count[k] += 1
            k >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """The tightest window with room for ``least``, and its capacity."""
        k = least + self.size
        if not self.count[k]:
            # up to the first ancestor with something on its right, then down its left side
            while k > 1 and (k & 1 or not self.count[k + 1]):
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.size:
                k = 2 * k if self.count[2 * k] else 2 * k + 1
        capacity = k - self.size
        while k:
            self.count[k] -= 1
            k >>= 1
        return self.open[capacity].pop(), capacity


def best_fit_decreasing(lengths: list[int], length: int = LENGTH) -> tuple[list[int], list[int]]:
    """Window and offset of each piece; no piece is longer than ``length``."""
    windows, window, offset, used = Windows(length), [0] * len(lengths), [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = windows.take(lengths[i])
        if found is None:
            found, used = (used, length), used + 1
        window[i], offset[i] = found[0], length - found[1]
        if found[1] > lengths[i]:
            windows.put(found[1] - lengths[i], found[0])
    return window, offset


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """A row per piece: ``(id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``.

    ``with_ids`` adds the piece's ids. A sequence is its pieces by offset.
    """
    names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    if id_col in (*names, "ids"):
        raise ValueError(f"{id_col} is the name of a result column")
    schema = T.StructType([docs.schema[id_col], *(T.StructField(n, T.LongType()) for n in names),
                           *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, encoder = to_arrow_schema(schema), _encoder(tokenizer)
        context = TaskContext.get()
        sequences = (context.partitionId() if context else 0) << 33
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            nonlocal sequences
            sizes = np.concatenate([np.diff(bounds) for _, _, bounds in held])
            ids = np.concatenate([i for _, i, _ in held])
            owner_ids = pa.concat_arrays([k for k, _, _ in held])
            held.clear()
            pieces = -(-sizes // length)
            doc = np.repeat(np.arange(len(sizes)), pieces)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * length
            piece = np.minimum(sizes[doc] - start, length)
            window, offset = best_fit_decreasing(piece.tolist(), length)
            begin = (np.cumsum(sizes) - sizes)[doc] + start
            parts = [ids[b:b + n] for b, n in zip(begin.tolist(), piece.tolist(), strict=True)]
            crc = np.array([zlib.crc32(p.astype("<u4", copy=False).tobytes()) for p in parts], np.int64)
            cols = [owner_ids.take(pa.array(doc)), *(pa.array(x, pa.int64()) for x in (
                start, piece, crc, sizes[doc], sequences + np.array(window, np.int64), np.array(offset, np.int64)))]
            if with_ids:
                bounds = np.concatenate([[0], np.cumsum(piece)]).astype(np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(parts).astype(np.int32))))
            sequences += max(window) + 1
            return pa.RecordBatch.from_arrays(cols, schema=arrow)

        for batch in batches:
            texts = X.as_bytes(batch["_text"])
            for a, b in X.slices(texts):
                held.append((batch["_id"][a:b], *encoder.encode(texts[a:b], end_id)))
                if sum(len(i) for _, i, _ in held) >= GROUP_TOKENS:
                    yield flush()
        if held:
            yield flush()

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).mapInArrow(pack, schema)
