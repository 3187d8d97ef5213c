"""Substring dedup by difference-cover anchors.

A word goes if a window of ``window`` words that covers it occurs earlier in
the corpus. Hashing every window would shuffle a fingerprint per word; instead
shorter anchors are hashed at the positions of a difference cover: modulo 13,
every distance is a difference of two members of {0, 1, 3, 9}, so two equal
windows at any two positions hold an equal anchor at the same offset below 13.

1. each chunk sends the distinct anchors of its documents; anchors that two
   chunks hold come back;
2. windows around an anchor that is shared (with another chunk, or inside this
   one) are extended to whole windows and sent as 96-bit fingerprints; a chunk
   hears which of them an earlier chunk holds;
3. a chunk drops the words of those windows and of windows repeated inside it.

Windows are compared by 96-bit fingerprints; a false match needs a collision of
all 96 bits.

Result for special rows: NULL or empty text has no words and an empty kept
text; texts shorter than a window lose nothing; rows are ordered by id, then by
text (rows that repeat an id count as one after the other); rows without an id
come last; an empty table gives an empty result. Columns other than the id, the
text and ``carry`` are not read, so their names can't clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from learnlog.llm import chunks as C
from learnlog.llm import text as X

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)


def _sorted(table: pa.Table) -> tuple[pa.Table, list[bytes]]:
    table = table.sort_by([("_id", "ascending"), ("_text", "ascending")])
    return table, X.as_bytes(table["_text"])


def _anchors(words: X.Words, h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Word indexes at cover positions with room for an anchor; the anchors' hashes."""
    size = window - PERIOD + 1
    at = X.gram_starts(words, size)
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True
    at = at[cover[(at - words.first[words.doc[at]]) % PERIOD]]
    at = at[words.count[words.doc[at]] >= window]
    return at, X.grams(h, size)[at]


def _windows(h: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """96-bit fingerprints of the windows that start at ``at``."""
    return X.grams(h, window)[at], (X.grams(h, window, salt=7)[at] >> np.uint64(32)).astype(np.uint32)


def _parts(texts: list[bytes]):
    for a, b in X.slices(texts):
        words = X.words_of(texts[a:b])
        yield a, b, words, words.hashes()


def _send_anchors(table: pa.Table, window: int, buckets: int) -> pa.Table:
    texts = X.as_bytes(table["_text"])
    found = [np.unique(_anchors(words, h, window)[1]) for _, _, words, h in _parts(texts)]
    return C.pack(table["_chunk"][0].as_py(), buckets, np.unique(np.concatenate(found)))


def _send_windows(table: pa.Table, answers: pa.Table, window: int, buckets: int) -> pa.Table:
    if not len(table):
        return C.pack(0, buckets, np.zeros(0, np.uint64), np.zeros(0, np.uint32))
    texts = X.as_bytes(table["_text"])
    (far,), _ = C.unpack(answers, "u8")
    far = np.sort(far)
    local = np.concatenate([_anchors(words, h, window)[1] for _, _, words, h in _parts(texts)])
    local.sort()
    local = np.unique(local[1:][local[1:] == local[:-1]])
    his, los = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
    for _, _, words, h in _parts(texts):
        at, anchor = _anchors(words, h, window)
        hit = np.zeros(len(h) + PERIOD + 1, np.int32)
        hit[at[X.contains(far, anchor) | X.contains(local, anchor)]] = 1
        sums = np.concatenate([[0], np.cumsum(hit)])
        start = X.gram_starts(words, window)
        start = start[sums[start + PERIOD] > sums[start]]
        hi, lo = _windows(h, start, window)
        his.append(hi)
        los.append(lo)
    hi, lo = np.concatenate(his), np.concatenate(los)
    order, new = X.first_of_each(hi, lo)
    keep = order[new]
    return C.pack(table["_chunk"][0].as_py(), buckets, hi[keep], lo[keep])


def _remove(table: pa.Table, answers: pa.Table, window: int, carry: list[str], schema: pa.Schema) -> pa.Table:
    if not len(table):
        return schema.empty_table()
    table, texts = _sorted(table)
    (far_hi, far_lo), _ = C.unpack(answers, "u8", "u4")
    parts, his, los = [], [], []
    for a, b, words, h in _parts(texts):
        start = X.gram_starts(words, window)
        hi, lo = _windows(h, start, window)
        parts.append((a, words.count, words.first, start, len(h)))
        his.append(hi)
        los.append(lo)
    # windows of this chunk after those an earlier chunk holds: all but a first one go
    hi, lo = np.concatenate([far_hi, *his]), np.concatenate([far_lo, *los])
    order, new = X.first_of_each(hi, lo)
    repeated = np.ones(len(hi), bool)
    repeated[order[new]] = False
    repeated = repeated[len(far_hi):]
    n_words, n_removed, kept, done = [], [], [], 0
    for a, count, first, start, total in parts:
        gone = start[repeated[done:done + len(start)]]
        done += len(start)
        cover = np.zeros(total + 1, np.int64)
        np.add.at(cover, gone, 1)
        np.add.at(cover, gone + window, -1)
        drop = np.cumsum(cover[:-1]) > 0
        sums = np.concatenate([[0], np.cumsum(drop)])
        lost = sums[first[1:]] - sums[first[:-1]]
        n_words += count.tolist()
        n_removed += lost.tolist()
        for k, n in enumerate(lost.tolist()):
            ws = texts[a + k].split()
            if n:
                ws = [w for w, d in zip(ws, drop[first[k]:first[k + 1]].tolist(), strict=True) if not d]
            kept.append(b" ".join(ws))
    return pa.Table.from_arrays(
        [table["_id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
         pa.array(kept, pa.binary()).cast(pa.string()), *(table[c] for c in carry)], schema=schema)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    carry: list[str] | None = None) -> DataFrame:
    """``(id, n_words, n_removed, kept_text, carry...)``, a row per row of ``docs``.

    ``kept_text`` is the kept words joined by one space. ``carry`` names columns
    of ``docs`` to return as they are.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    carry = list(carry or [])
    if window < PERIOD:
        raise ValueError(f"a window has at least {PERIOD} words")
    if clash := {id_col, "n_words", "n_removed", "kept_text"} & set(carry):
        raise ValueError(f"carried columns clash with the result's: {sorted(clash)}")
    d, buckets = C.in_chunks(docs, id_col, text_col, carry)
    by_chunk = d.select("_id", "_text", "_chunk", *carry).groupBy("_chunk")
    anchors = by_chunk.applyInArrow(lambda t: _send_anchors(t, window, buckets), C.PACK_SCHEMA)
    near = C.shared(anchors, "u8")
    windows = by_chunk.cogroup(near.groupBy("_chunk")).applyInArrow(
        lambda t, a: _send_windows(t, a, window, buckets), C.PACK_SCHEMA)
    lost = C.not_first(windows, "u8", "u4")
    schema = T.StructType([T.StructField(id_col, T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType()),
                           *(docs.schema[c] for c in carry)])
    arrow = to_arrow_schema(schema)
    return by_chunk.cogroup(lost.groupBy("_chunk")).applyInArrow(
        lambda t, a: _remove(t, a, window, carry, arrow), schema)
