"""Language identification with bit-sliced n-gram filters.

A filter holds, per slot, one bit for each language: a look-up of an n-gram's
slots returns, by one AND, the mask of all languages that contain it. A text's
n-grams are counted per language by the bits of their masks, the counts are
corrected for the filters' false positives, and the largest decides.

* N-grams are runs of four bytes of the text in lower case, with everything
  but letters as a space; runs of spaces count as one.
* A language contains the n-grams that make up at least ``LEAST_SHARE`` of its
  text (so at most 1 / ``LEAST_SHARE`` of them); all rows are counted.
* The filter's size follows from the largest language's number of n-grams.

The score is the share that the winner has of the two largest corrected counts.

Result for special rows: NULL text and text without a letter is ``und`` with
score 0; without rows to learn from every text is ``und``; if no language has
any of the n-grams, the most frequent language is given with score 0; ties go
to the more frequent, then the smaller name; an empty table gives an empty
result. Columns other than the id, the text and (to learn) the language are not
read, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnlog.llm import text as X
from learnlog.llm.graph import written

GRAM = 4
LEAST_SHARE = 4e-6
HASHES = 3
SLOTS_PER_GRAM = 12
UNKNOWN = "und"

#: Lower case for ASCII letters and for the bytes of other characters; a space for the rest.
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def gram_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Code of each n-gram (four bytes in 32 bits) and the index of its text."""
    # two spaces part the texts; a Latin-1 capital in UTF-8 folds like its letter
    data = np.frombuffer(b"  ".join([b"", *texts, b""]), np.uint8)
    doc = np.repeat(np.arange(len(texts) + 1), [2, *(len(t) + 2 for t in texts)]) - 1
    fold = _FOLD[data]
    fold[1:][(data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)] += 0x20
    space = fold == 0x20
    keep = np.ones(len(data), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    fold, doc = fold[keep].astype(np.uint32), doc[keep]
    n = len(fold) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    code = np.zeros(n, np.uint32)
    for k in range(GRAM):
        code = code << np.uint32(8) | fold[k:k + n]
    # a gram that begins in one text and ends in the next is none
    inside = (doc[:n] == doc[GRAM - 1:]) | ((fold[:n] == 0x20) & (doc[1:n + 1] == doc[GRAM - 1:]))
    return code[inside], doc[GRAM - 1:][inside]


def gram_counts(learn: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` over all rows of ``learn(text, lang)``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def send() -> Iterator[pa.RecordBatch]:
            for lang, (code, n) in total.items():
                yield pa.record_batch({"lang": pa.array([lang] * len(code), pa.string()), "gram": pa.array(code.astype(np.int64)), "n": pa.array(n)})
            total.clear()

        for batch in batches:
            texts, langs = X.as_bytes(batch["text"]), np.array(batch["lang"].to_pylist(), object)
            for a, b in X.slices(texts):
                code, doc = gram_codes(texts[a:b])
                for lang in sorted(set(langs[a:b])):
                    new, n = np.unique(code[(langs[a:b] == lang)[doc]], return_counts=True)
                    old = total.get(lang, (new[:0], n[:0]))
                    both, at = np.unique(np.concatenate([old[0], new]), return_inverse=True)
                    total[lang] = both, np.bincount(at, np.concatenate([old[1], n]), len(both)).astype(np.int64)
            if sum(len(c) for c, _ in total.values()) > 1 << 21:
                yield from send()
        yield from send()

    return learn.select("text", "lang").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Filters:
    """Bit-sliced Bloom filters: ``slots[slot, word]`` has a bit per language."""

    def __init__(self, grams: dict[str, np.ndarray], order: list[str]) -> None:
        self.langs = order
        most = max((len(g) for g in grams.values()), default=1)
        self.bits = max(10, int(np.ceil(np.log2(max(1, most * SLOTS_PER_GRAM)))))
        self.slots = np.zeros((1 << self.bits, -(-len(order) // 64)), np.uint64)
        fill = []
        for k, lang in enumerate(order):
            at = np.unique(self.places(grams[lang].astype(np.uint32)))
            self.slots[at, k // 64] |= np.uint64(1) << np.uint64(k % 64)
            fill.append(len(at) / len(self.slots))
        self.false = np.array(fill) ** HASHES

    def places(self, code: np.ndarray) -> np.ndarray:
        h = X.mix64(code.astype(np.uint64), 41)
        return np.stack([((h >> np.uint64(20 * k)) & np.uint64((1 << self.bits) - 1)).astype(np.int64) if self.bits <= 20
                         else (X.mix64(h, k) >> np.uint64(64 - self.bits)).astype(np.int64) for k in range(HASHES)])

    def masks(self, code: np.ndarray) -> np.ndarray:
        """Languages that contain each gram, as bits."""
        at = self.places(code)
        found = self.slots[at[0]]
        for k in range(1, HASHES):
            found = found & self.slots[at[k]]
        return found

    def counts(self, code: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Grams of each text that each language contains, without the expected false ones; grams of each text."""
        found, total = self.masks(code), np.bincount(doc, minlength=n)
        hits = np.stack([np.bincount(doc[(found[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1) == 1], minlength=n)
                         for k in range(len(self.langs))], 1).reshape(n, len(self.langs))
        return np.maximum((hits - total[:, None] * self.false) / (1 - self.false), 0), total


def learn_filters(learn: DataFrame, least_share: float = LEAST_SHARE) -> Filters | None:
    counts, _ = written(gram_counts(learn), "grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = counts.join(totals, "lang").where(F.col("n") >= F.greatest(F.lit(2), F.col("total") * least_share))
    rows = kept.groupBy("lang").agg(F.max("total").alias("total"), F.collect_list("gram").alias("grams")).collect()
    if not rows:
        return None
    order = [r["lang"] for r in sorted(rows, key=lambda r: (-r["total"], r["lang"]))]
    return Filters({r["lang"]: np.array(r["grams"], np.int64) for r in rows}, order)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def predict_language(docs: DataFrame, learn: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(id, lang_pred, score)``, a row per row of ``docs``; ``learn`` has the rows to learn from."""
    known = learn.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where(
        "text is not null and lang is not null")
    schema = T.StructType([docs.schema[id_col], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    filters = learn_filters(known)
    if filters is None:
        return d.select(F.col("id").alias(id_col), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        names = np.array([*f.langs, UNKNOWN], object)
        for batch in batches:
            column = batch["text"]
            texts, letters = X.as_bytes(column), np.array([has_letter(t) for t in column.to_pylist()], bool)
            for a, b in X.slices(texts):
                got, _ = f.counts(*gram_codes(texts[a:b]), b - a)
                best = got.argmax(1)
                top = np.sort(got, 1)[:, ::-1]
                two = top[:, 0] + (top[:, 1] if len(f.langs) > 1 else 0)
                score = np.divide(top[:, 0], two, out=np.zeros(b - a), where=two > 0)
                ok = letters[a:b]
                yield pa.record_batch([batch["id"][a:b], pa.array(names[np.where(ok, best, len(f.langs))], pa.string()),
                                       pa.array(np.where(ok, score, 0.0))], names=[id_col, "lang_pred", "score"])

    return d.mapInArrow(predict, schema)
