"""Spelling variants by PartEnum signatures.

Words are runs of ``[A-Za-z\\u00C0-\\u00FF]`` (A-Z in lower case) of at least
``LETTERS`` code points that occur at least ``LEAST`` times. Two are near if one
code point more, less or replaced makes one of the other.

* A word's letters are a multiset, that is a binary vector over (letter, how
  many there were before). A replaced letter is a Hamming distance of two, a
  letter more or less one of one.
* PartEnum: the vector's dimensions are dealt to ``PARTS`` parts (``ENDS`` for
  a distance of one). Vectors at a distance of at most d agree on all parts but
  d, so a signature is what a word has in all parts but d of them, for every
  choice of these: words at that distance have an equal one.
* A signature carries the words' length (of the longer one, and whether lengths
  differ) and the letters of one half, in order: an edit leaves the first half
  or the last as it is. That keeps anagrams and letters that are everywhere
  from filling a group.
* Signatures are equi-joined, and the join's condition verifies the pair (beside
  it for words of more than ``LONG`` code points).

The form of a word is its near word with most occurrences, if it has twice as
many or more; forms lead, occurrences rising, to the root, by pointer doubling.

With ``misspell`` a run loses a code point where the crc32 of ``<id>:<run>`` is
divisible by it: the one at crc32 modulo the run's length.

Result for special rows: NULL, empty and letterless text has no words; a missing
id is an empty one in that text; repeated rows count each; of near words with
equally many occurrences the first in code-point order is the form; an empty
table gives an empty result. Other columns are not read, so their names can't
clash.
"""

from __future__ import annotations

import itertools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlog.llm import text as X
from learnlog.llm.graph import delete, written

LETTERS = 5
LEAST = 3
TIMES = 2
#: Parts of the letters of words of one length, and of words whose lengths differ.
PARTS, ENDS = 4, 3
#: Code points up to which a pair is verified in the join.
LONG = 256
#: Distinct words that a map task gathers before it sends them.
FLUSH = 400_000
#: Bytes of a run up to which crc32 is computed side by side.
SHORT = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True


def _crc_table() -> np.ndarray:
    """Remainders of crc32 for each byte."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def crc32(data: np.ndarray, start: np.ndarray, size: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of byte ranges, each going on from the crc32 ``before``."""
    out = before.astype(np.uint32)
    order = np.argsort(-size, kind="stable")
    long = int(np.count_nonzero(size > SHORT))
    for i in order[:long].tolist():
        out[i] = zlib.crc32(data[start[i]:start[i] + size[i]].tobytes(), int(before[i]))
    order = order[long:]
    place, left = start[order], size[order]
    state = out[order] ^ np.uint32(0xFFFFFFFF)
    # the longest first: those that go on are the first ones
    goes_on = np.searchsorted(-left, -np.arange(left[0] if len(left) else 0), side="left")
    for k, m in enumerate(goes_on.tolist()):
        state[:m] = _CRC[(state[:m] ^ data[place[:m] + k]) & np.uint32(0xFF)] ^ (state[:m] >> np.uint32(8))
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def runs(texts: list[bytes], ids: list[int | None], letters: int, misspell: int) -> pa.Array:
    """Words of a slice of texts, with ``letters`` code points or more."""
    data = _LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
    lead = data == 0xC3                                          # of the two bytes of U+00C0 to U+00FF
    inside = _LETTER[data] | lead
    inside[1:] |= lead[:-1]
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    points = np.concatenate([[0], np.cumsum(~lead)])
    length = points[end] - points[start]
    use = length >= letters
    start, size, length = start[use], (end - start)[use], length[use]
    extra: list[bytes] = []
    if misspell:
        doc = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), start, side="right")
        before = np.array([zlib.crc32(b"%s:" % (b"" if i is None else str(i).encode())) for i in ids], np.uint32)
        h = crc32(data, start, size, before[doc])
        hit = h % np.uint32(misspell) == 0
        for a, n, k in zip(start[hit].tolist(), size[hit].tolist(), (h[hit] % length[hit]).tolist(), strict=True):
            word = data[a:a + n].tobytes().decode()
            if len(word) > letters:
                extra.append((word[:k] + word[k + 1:]).encode())
        start, size = start[~hit], size[~hit]
    at = np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)
    whole = np.concatenate([data[at], np.frombuffer(b"".join(extra), np.uint8)])
    offsets = np.concatenate([[0], np.cumsum(np.concatenate([size, [len(e) for e in extra]]))]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(whole)])


def word_counts(docs: DataFrame, letters: int, misspell: int) -> DataFrame:
    """``(word, n)`` of ``docs(id, text)``."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def gathered() -> pa.Table:
            return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"])

        def sent(rows: pa.Table) -> list[pa.RecordBatch]:
            return rows.set_column(0, "word", rows["word"].cast(pa.string())).to_batches()

        for batch in batches:
            texts, ids = X.as_bytes(batch["text"]), batch["id"].to_pylist()
            for a, b in X.slices(texts):
                found = runs(texts[a:b], ids[a:b], letters, misspell).value_counts()
                held.append(pa.table({"word": found.field("values"), "n": found.field("counts")}))
                if sum(map(len, held)) >= FLUSH:
                    held = [gathered()]
                    if len(held[0]) >= FLUSH // 2:
                        yield from sent(held.pop())
        if held:
            yield from sent(gathered())

    return docs.mapInArrow(send, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def signatures(words: list[str], parts: int = PARTS, ends: int = ENDS) -> list[np.ndarray]:
    """Signatures of each word, 64 bits each."""
    out: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(words)
    lengths = np.array([len(w) for w in words])
    for n in np.unique(lengths).tolist():
        which = np.flatnonzero(lengths == n)
        letter = np.frombuffer("".join([words[i] for i in which.tolist()]).encode("utf-32-le"), np.uint32).reshape(-1, n).astype(np.uint64)
        # the binary vector: each letter with the number of equal ones before it
        ordered, at = np.sort(letter, axis=1), np.arange(n)
        begins = np.concatenate([np.ones((len(which), 1), bool), ordered[:, 1:] != ordered[:, :-1]], axis=1)
        before = at - np.maximum.accumulate(np.where(begins, at, 0), axis=1)
        dimension = X.mix64(ordered << np.uint64(32) | before.astype(np.uint64))
        code = X.mix64(dimension, 31)
        # letters in order, from the first on and from the last on
        place = at.astype(np.uint64) << np.uint64(32)
        first = np.cumsum(X.mix64(letter | place, 32), axis=1)
        last = np.cumsum(X.mix64(letter[:, ::-1] | place, 33), axis=1)
        found = []
        # words of n letters; as the longer ones of a pair; as the shorter ones
        for most, apart, kind in ((n, 2, 0), (n, 1, 1), (n + 1, 1, 1)):
            count = parts if apart == 2 else ends
            part = dimension % np.uint64(count)
            sums = [X.mix64(np.where(part == k, code, 0).sum(axis=1, dtype=np.uint64), 40 + k) for k in range(count)]
            head = (most - 1) // 2
            halves = [first[:, head - 1], last[:, most - 2 - head]]
            for left_out in itertools.combinations(range(count), apart):
                seen = sum((sums[k] for k in range(count) if k not in left_out), np.zeros(len(which), np.uint64))
                tag = (most << 8 | kind << 7 | left_out[0] << 4 | left_out[-1]) << 1
                found += [X.mix64(X.mix64(seen, 51) ^ X.mix64(half + np.uint64(tag + side), 52)) for side, half in enumerate(halves)]
        for i, row in zip(which.tolist(), np.column_stack(found), strict=True):
            out[i] = row
    return out


def one_edit(a: str, b: str) -> bool:
    """Whether one code point more, less or replaced makes ``b`` of ``a``."""
    if len(a) > len(b):
        a, b = b, a
    same = len(os.path.commonprefix([a, b]))
    return a != b and (a[same + 1:] == b[same + 1:] if len(a) == len(b) else len(b) == len(a) + 1 and a[same:] == b[same + 1:])


def near_pairs(words: DataFrame) -> DataFrame:
    """``(a, na, b, nb)`` of near words of ``words(word, n)``, each pair once, ``a`` before ``b``."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [row.view(np.int64) for row in signatures(batch["word"].to_pylist())]
            bounds = np.cumsum([0] + [len(f) for f in found]).astype(np.int32)
            flat = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.record_batch({"word": batch["word"], "n": batch["n"], "signatures": pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))})

    signed = words.mapInArrow(sign, "word string, n long, signatures array<long>").select(F.explode("signatures").alias("signature"), "word", "n")
    a = signed.select("signature", F.col("word").alias("a"), F.col("n").alias("na"))
    b = signed.select("signature", F.col("word").alias("b"), F.col("n").alias("nb"))
    agree = (a["signature"] == b["signature"]) & (F.col("a") < F.col("b"))
    short = F.greatest(F.char_length("a"), F.char_length("b")) <= LONG
    verified = a.join(b.hint("merge"), agree & short & (F.levenshtein("a", "b", 1) == 1))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([one_edit(x, y) for x, y in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True)], pa.bool_()))

    # Spark's distance takes the square of a word's length
    far = (a.where(F.char_length("a") >= LONG).join(b.where(F.char_length("b") >= LONG).hint("merge"), agree & ~short)
           .select("a", "na", "b", "nb").mapInArrow(verify, "a string, na long, b string, nb long"))
    return verified.select("a", "na", "b", "nb").union(far).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: where following ``forms(word, form)`` ends; every round's paths are twice as long."""
    spark = forms.sparkSession
    paths, path = written(forms.select("word", F.col("form").alias("root")), "paths")
    while True:
        onward = paths.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = paths.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        longer, to = written(longer, "paths")
        delete(spark, path)
        paths, path = longer.select("word", "root"), to
        if longer.where("moved").isEmpty():
            return paths


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = LETTERS, least: int = LEAST,
                      times: int = TIMES, misspell: int = 0) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``, a row per word.

    ``n`` is the word's occurrences, ``n_near`` the number of its near words;
    ``form`` is NULL where no near word has ``times`` as many occurrences.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    words, _ = written(word_counts(d, letters, misspell).where(F.col("n") >= least), "words")
    pairs, _ = written(near_pairs(words), "pairs")
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("na").alias("n"), F.col("b").alias("near"), F.col("nb").alias("more")),
        F.struct(F.col("b").alias("word"), F.col("nb").alias("n"), F.col("a").alias("near"), F.col("na").alias("more")))).alias("p")).select("p.*")
    best = both.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("more")).alias("less"), "near")).alias("best"))
    follows = -F.col("best.less") >= times * F.col("n")
    best, _ = written(best.select("word", "n_near", F.when(follows, F.col("best.near")).alias("form"), F.when(follows, -F.col("best.less")).alias("form_n")), "best")
    ends = roots(best.where("form is not null"))
    return (words.join(best, "word", "left").join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))
