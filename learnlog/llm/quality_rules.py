"""Quality rules by distribution divergence.

A document's histograms of character classes and of common words are compared
with references of the languages by Jensen-Shannon distance (base 2, 0 to 1).
The references are counted over all rows that pass the base rules, by the
language column; a document is judged against the language nearest to it.

* Base rules: fewer than ``MIN_WORDS`` words, or over half of the words in
  3-word windows that the text repeats.
* Character classes: the distance must not exceed ``char_limit``.
* Common words: the distance over the language's ``COMMON`` most common words
  (and one bin for all others) must not exceed ``word_limit``.
* Length guard: a short text's histogram lies off its language's by chance, by
  about the inverse root of its length, so both limits are wider by ``NOISE``
  over the root of the number of words (bytes); texts that the base rules call
  too short are not judged.
* A language with fewer than ``MIN_REFERENCE_WORDS`` words is no reference;
  without any reference the base rules alone decide.

Words are counted in 2**16 hashed bins, so what the tasks and the driver hold
has a fixed size per language, and all rows are counted.

Result for special rows: NULL, empty or blank text has zero counts and fails
the base rules; NULL languages count as a language of their own; repeated rows
and ids are judged each by itself; an empty table gives an empty result. Other
columns are not read unless named in ``carry``, so their names can't clash.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnlog.llm import text as X

MIN_WORDS = 50
MIN_REFERENCE_WORDS = 1000
COMMON = 64
CHAR_LIMIT = 0.27
WORD_LIMIT = 0.41
NOISE = 0.6
BINS = 1 << 16

#: Class of each byte; continuation bytes of UTF-8 count for none.
CLASSES = ("lower", "upper", "digit", "space", "line", "stop", "quote", "bracket", "symbol", "control", "other")
_CLASS = np.full(256, CLASSES.index("other"), np.uint8)
_CLASS[:32] = _CLASS[127] = CLASSES.index("control")
for _name, _chars in (("lower", b"abcdefghijklmnopqrstuvwxyz"), ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                      ("digit", b"0123456789"), ("space", b" \t\x0b\x0c"), ("line", b"\r\n"), ("stop", b".,;:?"),
                      ("quote", b"'\"`-"), ("bracket", b"()[]{}"), ("symbol", b"#*$%&|<>!@+=/\\^_~")):
    _CLASS[list(_chars)] = CLASSES.index(_name)
_CLASS[0x80:0xC0] = len(CLASSES)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_N = len(CLASSES)


def counts(texts: list[bytes], words: X.Words) -> dict[str, np.ndarray]:
    """The base counts of each text."""
    n = len(texts)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])

    def per_text(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return sums[begins[1:]] - sums[begins[:-1]]

    inside = np.zeros(len(words.data) + 1, np.int8)
    inside[words.start] += 1
    inside[words.end] -= 1
    inside = np.cumsum(inside[:-1]).astype(bool)
    lead = (words.data & 0xC0) != 0x80
    h = words.hashes()
    at = X.gram_starts(words, 3)
    doc, key = words.doc[at], X.grams(h, 3)[at] if len(at) else np.zeros(0, np.uint64)
    order, new = X.first_of_each(doc, key)
    group = np.cumsum(new) - 1
    twice = at[order[np.bincount(group, minlength=1)[group] > 1]]
    repeated = np.zeros(len(h) + 3, bool)
    for k in range(3):
        repeated[twice + k] = True
    dup_lines = np.zeros(n, np.int64)
    for i, t in enumerate(texts):
        if b"\n" in t:
            lines = [x for x in t.split(b"\n") if x.split()]
            dup_lines[i] = len(lines) - len(set(lines))
    return {"n_words": words.count.astype(np.int64), "word_chars": per_text(inside & lead), "n_symbols": per_text(_SYMBOL[words.data]),
            "n_dup_lines": dup_lines, "n_repeat_words": np.bincount(words.doc[repeated[: len(h)]], minlength=n).astype(np.int64)}


def base_failed(c: dict[str, np.ndarray]) -> np.ndarray:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def _char_histograms(texts: list[bytes], data: np.ndarray) -> np.ndarray:
    size = np.array([len(t) + 1 for t in texts], np.int64)
    cell = _CLASS[data].astype(np.int32)
    cell[np.cumsum(size) - 1] = _N          # the byte that separates texts is not counted
    cell += np.repeat(np.arange(len(texts), dtype=np.int32) * (_N + 1), size)
    return np.bincount(cell, minlength=len(texts) * (_N + 1)).reshape(-1, _N + 1)[:, :_N]


_PLAIN = np.zeros(256, bool)
_PLAIN[list(b".,;:?")] = True


def _word_bins(words: X.Words) -> np.ndarray:
    """Bin of each word in lower case, without one sentence mark at its end."""
    words = X.lowered(words)
    end = words.end - ((words.end - words.start > 1) & _PLAIN[words.data[words.end - 1]])
    return (X.Words(words.data, words.start, end, words.doc, words.first).hashes() >> np.uint64(48)).astype(np.int64)


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> list[dict]:
    """Per language: character-class distribution, common words' bins and their distribution."""
    width = BINS + _N

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, lang = X.as_bytes(batch["text"]), np.array(batch["lang"].to_pylist(), object)
            for a, b in X.slices(texts):
                part = texts[a:b]
                words = X.words_of(part)
                ok = ~base_failed(counts(part, words))
                bins, chars = _word_bins(words), _char_histograms(part, words.data)
                for name in set(lang[a:b][ok]):
                    of = ok & (lang[a:b] == name)
                    t = total.setdefault(name, np.zeros(width, np.int64))
                    t[:BINS] += np.bincount(bins[of[words.doc]], minlength=BINS)
                    t[BINS:] += chars[of].sum(0)
        for name, t in total.items():
            at = np.flatnonzero(t)
            yield pa.record_batch({"lang": pa.array([name] * len(at), pa.string()), "at": pa.array(at.astype(np.int32)), "n": pa.array(t[at])})

    d = docs.select(F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"))
    sums = d.mapInArrow(count, "lang string, at int, n long").groupBy("lang", "at").agg(F.sum("n").alias("n"))
    word, bin_ = F.col("at") < BINS, F.struct("n", "at")
    found = []
    for r in sums.groupBy("lang").agg(
            F.sum(F.when(word, F.col("n"))).alias("total"),
            F.slice(F.sort_array(F.collect_list(F.when(word, bin_)), asc=False), 1, COMMON).alias("common"),
            F.collect_list(F.when(~word, bin_)).alias("chars")).where("total is not null").collect():
        if r["total"] < MIN_REFERENCE_WORDS:
            continue
        char = np.zeros(_N)
        for c in r["chars"]:
            char[c["at"] - BINS] = c["n"]
        common = [c["n"] for c in r["common"]]
        found.append({"lang": r["lang"], "chars": (char / char.sum()).tolist(), "bins": [c["at"] for c in r["common"]],
                      "words": (np.array([*common, r["total"] - sum(common)]) / r["total"]).tolist()})
    return sorted(found, key=lambda x: x["lang"])


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance, base 2, of each row of ``p`` from ``q``."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = np.where(p > 0, p * np.log2(p / m), 0).sum(1) + np.where(q > 0, q * np.log2(q / m), 0).sum(1)
    return np.sqrt(np.clip(kl / 2, 0, 1))


def distances(texts: list[bytes], words: X.Words, refs: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Distances of characters and words from the nearest language (the least sum of both)."""
    chars = _char_histograms(texts, words.data).astype(float)
    chars /= np.maximum(chars.sum(1, keepdims=True), 1)
    bins = _word_bins(words)
    best = np.full((2, len(texts)), np.inf)
    for ref in refs:
        place = np.full(BINS, COMMON)
        place[ref["bins"]] = np.arange(len(ref["bins"]))
        k = len(ref["bins"]) + 1
        col = np.minimum(place[bins], k - 1)
        hist = np.bincount(words.doc * k + col, minlength=len(texts) * k).reshape(-1, k).astype(float)
        hist /= np.maximum(hist.sum(1, keepdims=True), 1)
        d = np.stack([js_distance(chars, np.array(ref["chars"])), js_distance(hist, np.array(ref["words"]))])
        near = d.sum(0) < best.sum(0)
        best[:, near] = d[:, near]
    return best[0], best[1]


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  char_limit: float = CHAR_LIMIT, word_limit: float = WORD_LIMIT, carry: list[str] | None = None) -> DataFrame:
    """``(id, counts..., base_failed, char_distance, word_distance, kept, carry...)``, a row per row of ``docs``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    carry = list(carry or [])
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    if clash := {id_col, *names, "base_failed", "char_distance", "word_distance", "kept"} & set(carry):
        raise ValueError(f"carried columns clash with the result's: {sorted(clash)}")
    refs = json.dumps(references(docs, text_col, lang_col))
    schema = T.StructType([docs.schema[id_col], *(T.StructField(n, T.LongType()) for n in names), T.StructField("base_failed", T.BooleanType()),
                           T.StructField("char_distance", T.DoubleType()), T.StructField("word_distance", T.DoubleType()),
                           T.StructField("kept", T.BooleanType()), *(docs.schema[c] for c in carry)])
    arrow = to_arrow_schema(schema)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = json.loads(refs)
        for batch in batches:
            texts = X.as_bytes(batch["_text"].cast(pa.string()))
            for a, b in X.slices(texts):
                part = texts[a:b]
                words = X.words_of(part)
                c = counts(part, words)
                failed = base_failed(c)
                char, word = distances(part, words, known) if known else (np.zeros(b - a), np.zeros(b - a))
                size = np.maximum([len(t) for t in part], 1)
                bad = (char > char_limit + NOISE / np.sqrt(size)) | (word > word_limit + NOISE / np.sqrt(np.maximum(c["n_words"], 1)))
                yield pa.RecordBatch.from_arrays(
                    [batch["_id"][a:b], *(pa.array(c[n]) for n in names), pa.array(failed), pa.array(char), pa.array(word),
                     pa.array(~failed & ~bad), *(batch[f"_c{k}"][a:b] for k in range(len(carry)))], schema=arrow)

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"),
                       *(F.col(c).alias(f"_c{k}") for k, c in enumerate(carry))).mapInArrow(judge, schema)
