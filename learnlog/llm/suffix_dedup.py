"""Byte-level suffix dedup by prefix-free parsing.

A byte goes if a string of ``WINDOW`` bytes that covers it also starts in a
document with a smaller id. Sorting a suffix per byte of the corpus is avoided
by parsing the texts into phrases that repeat where the text repeats:

* Triggers. Every window has one trigger, its ``GRAM`` bytes of least rolling
  hash (the first of equals). A phrase is a run of windows with one trigger, so
  neighbouring phrases overlap by ``WINDOW - 1`` bytes. As a window decides on
  its trigger and its place, equal windows lie in phrases of the same trigger
  hash: no window begins in one phrase's suffix and ends as another's.
* Parse. A chunk of documents sends its distinct triggers (32 bits besides the
  bucket; triggers that agree in these count as one, which only makes more
  phrases contested); it hears which another chunk holds too, and sends their
  phrases as fingerprints (96 bits, with the trigger's 32). All chunks but the
  first that have a phrase lose it. A trigger with one phrase everywhere is
  settled by the parse alone.
* Dictionary. Where a trigger has several phrases, each is sent with its bytes
  by the first chunk that has it. Their suffixes are sorted to the depth that
  counts (the windows); runs of equal ones are the longest-common-prefix
  intervals of the corpus order, and their first chunk is known from the parse.
* A chunk settles in the same way what repeats among its own documents.

A chunk sends in an order that its texts alone decide, and hears a bit, byte or
mask per entry in that order, so no answer repeats what was asked.

Phrases overlap by all but one byte of a window, so that the dictionary's order
alone places every window, and the parse needs no suffix array of its own.

Result for special rows: NULL and empty text has no bytes; texts shorter than a
window lose nothing; rows that repeat an id don't count as smaller than each
other; rows without an id count as larger than all others, and equal; an empty
table gives an empty result. Columns other than the id and the text are not
read, so their names can't clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnlog.llm import chunks as C
from learnlog.llm import text as X

WINDOW = 50
GRAM = 20
#: Windows of a phrase, at most.
REACH = WINDOW - GRAM + 1
#: Text bytes parsed at once: the arrays of a slice stay in a core's cache.
SLICE_BYTES = 1 << 16
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_scratch = [np.zeros((4, 0), np.uint64)]


@dataclass
class Phrases:
    """Phrases of texts, in their order: first window, number of windows, text's index, trigger hash and fingerprint."""

    raw: bytes                # all texts, a newline after each
    start: np.ndarray
    windows: np.ndarray
    doc: np.ndarray
    trigger: np.ndarray
    hi: np.ndarray
    lo: np.ndarray
    base: np.ndarray          # at which each text begins

    def texts(self, at: np.ndarray) -> np.ndarray:
        """The bytes of these phrases, one after the other."""
        size = self.windows[at] + (WINDOW - 1)
        return np.frombuffer(self.raw, np.uint8)[_ranges(self.start[at], size)]


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        m = max(n, SLICE_BYTES * 5 // 4)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(m, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


def _space(n: int) -> np.ndarray:
    """Four arrays of ``n`` numbers at least; those of a slice are used again."""
    if n > 2 * SLICE_BYTES:
        return np.empty((4, n), np.uint64)
    if _scratch[0].shape[1] < n:
        _scratch[0] = np.empty((4, 2 * SLICE_BYTES), np.uint64)
    return _scratch[0]


def _parse_slice(data: np.ndarray, base: np.ndarray, prints: bool) -> tuple[np.ndarray, ...]:
    """Start, windows, text's index, trigger, hi and lo of the phrases of texts that begin at ``base`` (and its last, the end)."""
    n = len(data)
    total, grams = n - WINDOW + 1, n - GRAM + 1
    if total <= 0:
        return tuple(np.zeros(0, t) for t in ("i8", "i8", "i8", "u8", "u8", "u4"))
    up, down = _power(n + 1)
    a, b, h, sums = _space(n + 1)
    sums = sums[:n + 1]
    np.add(data, np.uint64(0x5851F42D), out=a[:n])
    a[:n] *= up[:n]
    sums[0] = 0
    np.cumsum(a[:n], out=sums[1:])

    def of(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return X.mix64((sums[j] - sums[i]) * down[i])

    h = h[:grams]
    np.subtract(sums[GRAM:], sums[:-GRAM], out=h)
    h *= down[:grams]
    np.right_shift(h, np.uint64(32), out=a[:grams])
    h ^= a[:grams]
    h *= np.uint64(_BASE)
    least, width, spare = h, 1, (a, b)
    while width < REACH:
        step = min(width, REACH - width)
        least = np.minimum(least[:len(least) - step], least[step:], out=spare[0][:len(least) - step])
        width, spare = width + step, spare[::-1]
    # a phrase begins with a text, after its trigger's place or where a smaller trigger comes; not where a window leaves the text
    new = np.empty(total, bool)
    np.not_equal(least[1:], least[:-1], out=new[1:])
    new[1:] |= h[:total - 1] == least[:-1]
    new[base[:-1][base[:-1] < total]] = True
    short = np.maximum(base[1:] - WINDOW, base[:-1])
    leave = _ranges(short, base[1:] - short)
    new[leave[leave < total]] = False
    start = np.flatnonzero(new)
    doc = np.searchsorted(base, start, side="right") - 1
    end = np.minimum(np.append(start[1:], n), base[doc + 1] - WINDOW) + (WINDOW - 1)
    trigger = X.mix64(least[start])
    if not prints:
        return start, end - start - (WINDOW - 1), doc, trigger, trigger[:0], np.zeros(0, np.uint32)
    mid = (start + end) // 2
    hi = X.mix64(of(start, end) + (end - start).astype(np.uint64))
    lo = (X.mix64(of(start, mid) ^ X.mix64(of(mid, end), 3)) >> np.uint64(32)).astype(np.uint32)
    return start, end - start - (WINDOW - 1), doc, trigger, hi, lo


def parse(texts: list[bytes], prints: bool = True) -> Phrases:
    """The phrases of texts; without ``prints``, their fingerprints are left out."""
    raw = b"\n".join([*texts, b""])
    data = np.frombuffer(raw, np.uint8)
    base = np.cumsum([0] + [len(t) + 1 for t in texts])
    parts = [_parse_slice(data[:0], base[:1], prints)]
    for a, b in X.slices(texts, SLICE_BYTES):
        start, windows, doc, *more = _parse_slice(data[base[a]:base[b]], base[a:b + 1] - base[a], prints)
        parts.append((start + base[a], windows, doc + a, *more))
    start, windows, doc, trigger, hi, lo = map(np.concatenate, zip(*parts, strict=True))
    return Phrases(raw, start, windows, doc, trigger, hi, lo, base)


def _new(sorted_keys: np.ndarray) -> np.ndarray:
    """A mask of each key's first."""
    new = np.ones(len(sorted_keys), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return new


def _several(keys: np.ndarray) -> np.ndarray:
    """Which keys are there more than once."""
    order = np.argsort(keys)
    new = np.append(_new(keys[order]), True)
    out = np.empty(len(keys), bool)
    out[order] = ~(new[:-1] & new[1:])
    return out


def _by_fingerprint(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by fingerprint, and a mask of each one's first."""
    order = np.argsort(hi)
    new, other = _new(hi[order]), _new(lo[order])
    if (other & ~new).any():
        order = np.lexsort((lo, hi))
        new, other = _new(hi[order]), _new(lo[order])
    return order, new | other


ROW_SCHEMA = "_bucket int, _chunk int, _data binary"
#: ``_shared``: bits of the chunk's triggers that other chunks hold too; what a chunk hears of a phrase goes back with them.
PHRASE_SCHEMA = "_bucket int, _chunk int, _shared binary, _data binary"
TEXT_SCHEMA = "_bucket int, _chunk int, _windows binary, _text binary"
_PHRASE = np.dtype([("tag", "u4"), ("lo", "u4"), ("hi", "u8")])
#: What a chunk hears of a phrase: an earlier chunk has it, or it is the first and the trigger has other phrases too.
LATER, CONTESTED = 1, 2


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive runs of so many numbers, as binary values."""
    bounds = np.concatenate([[0], np.cumsum(sizes)]) * data.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data).view(np.uint8))])


def _numbers(column: pa.ChunkedArray, kind: str | np.dtype = "u1") -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all binary values, and how many each has."""
    kind = np.dtype(kind)
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy() // kind.itemsize
    parts = [np.zeros(0, np.uint8)]
    for x in column.chunks:
        if len(x):
            bounds = np.frombuffer(x.buffers()[1], np.int32)[x.offset:x.offset + len(x) + 1]
            parts.append(np.frombuffer(x.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]])
    return np.concatenate(parts).view(kind), sizes


def _table(**columns: np.ndarray | pa.Array) -> pa.Table:
    return pa.table({f"_{k}": v if isinstance(v, pa.Array) else pa.array(v.astype(np.int32)) for k, v in columns.items()})


def _runs(to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each of the sorted buckets, and how many entries it has."""
    cut = np.flatnonzero(_new(to))
    return to[cut], np.diff(np.append(cut, len(to)))


def _bit_places(sizes: np.ndarray) -> np.ndarray:
    """Place of each entry's bit where every run begins with a byte."""
    whole = -(-sizes // 8) * 8
    return _ranges(np.cumsum(whole) - whole, sizes)


def _as_bits(flags: np.ndarray, sizes: np.ndarray) -> pa.Array:
    whole = -(-sizes // 8)
    bits = np.zeros(8 * whole.sum(), np.uint8)
    bits[_bit_places(sizes)] = flags
    return _binary(np.packbits(bits), whole)


def _from_bits(column: pa.ChunkedArray, sizes: np.ndarray) -> np.ndarray:
    data, found = _numbers(column)
    _agree(found, -(-sizes // 8))
    return np.unpackbits(data)[_bit_places(sizes)].astype(bool)


def _agree(found: np.ndarray, sent: np.ndarray) -> None:
    if not np.array_equal(found, sent):
        raise ValueError("answers don't fit what the chunk has sent: its rows have changed between two passes")


def _in_order(answers: pa.Table) -> pa.Table:
    return answers.take(pa.array(np.argsort(answers["_bucket"].to_numpy(), kind="stable")))


def _triggers(p: Phrases, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and tag of the distinct triggers, in this order, and the number of each phrase's one among them."""
    key = ((p.trigger >> np.uint64(20)) % np.uint64(buckets)) << np.uint64(32) | p.trigger >> np.uint64(32)
    order = np.argsort(key)
    new = _new(key[order])
    number = np.empty(len(key), np.int64)
    number[order] = np.cumsum(new) - 1
    key = key[order[new]]
    return (key >> np.uint64(32)).astype(np.int64), key.astype(np.uint32), number


def _distinct(p: Phrases, at: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct phrases among those at ``at``, by bucket (``to``) and fingerprint, and the number of each one's among them."""
    order, new = _by_fingerprint(p.hi[at], p.lo[at])
    first = order[new]
    by_bucket = np.argsort(to[first], kind="stable")
    place = np.empty(len(first), np.int64)
    place[by_bucket] = np.arange(len(first))
    number = np.empty(len(at), np.int64)
    number[order] = place[np.cumsum(new) - 1]
    return first[by_bucket], number


def _send_triggers(table: pa.Table, buckets: int) -> pa.Table:
    to, tag, _ = _triggers(parse(X.as_bytes(table["_text"]), prints=False), buckets)
    bucket, sizes = _runs(to)
    return _table(bucket=bucket, chunk=np.full(len(bucket), table["_chunk"][0].as_py()), data=_binary(tag, sizes))


def _shared(rows: pa.Table) -> pa.Table:
    """A bit for each trigger sent: another chunk has it too."""
    tags, sizes = _numbers(rows["_data"], "u4")
    return _table(bucket=rows["_bucket"].to_numpy(), chunk=rows["_chunk"].to_numpy(), data=_as_bits(_several(tags), sizes))


def _send_phrases(table: pa.Table, answers: pa.Table, buckets: int) -> pa.Table:
    p = parse(X.as_bytes(table["_text"]) if len(table) else [])
    to, tag, number = _triggers(p, buckets)
    bucket, sizes = _runs(to)
    answers = _in_order(answers)
    _agree(answers["_bucket"].to_numpy(), bucket)
    flags = _from_bits(answers["_data"], sizes)
    at = np.flatnonzero(flags[number])
    first, _ = _distinct(p, at, to[number[at]])
    first = at[first]
    out = np.empty(len(first), _PHRASE)
    out["tag"], out["lo"], out["hi"] = tag[number[first]], p.lo[first], p.hi[first]
    asked, counts = _runs(to[number[first]])
    has = np.isin(bucket, asked)
    return _table(bucket=asked, chunk=np.full(len(asked), table["_chunk"][0].as_py() if len(table) else 0),
                  shared=_as_bits(flags[np.repeat(has, sizes)], sizes[has]), data=_binary(out, counts))


def _settle(rows: pa.Table) -> pa.Table:
    """A byte for each phrase sent: 0, ``LATER`` or ``CONTESTED``."""
    sent, sizes = _numbers(rows["_data"], _PHRASE)
    chunk = np.repeat(rows["_chunk"].to_numpy(), sizes)
    order, new = _by_fingerprint(sent["hi"], sent["lo"])
    status = np.zeros(len(sent), np.uint8)
    if len(sent):
        of, chunk = np.cumsum(new) - 1, chunk[order]
        later = chunk > np.minimum.reduceat(chunk, np.flatnonzero(new))[of]
        status[order] = np.where(later, LATER, np.where(_several(sent["tag"][order[new]])[of], CONTESTED, 0))
    return _table(bucket=rows["_bucket"].to_numpy(), chunk=rows["_chunk"].to_numpy(), shared=rows["_shared"].combine_chunks(), data=_binary(status, sizes))


def _recall(p: Phrases, settled: pa.Table, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Phrases of shared triggers, their numbers among the distinct ones sent, and of these a phrase, the bucket and the answer."""
    to, _, number = _triggers(p, buckets)
    bucket, sizes = _runs(to)
    settled = _in_order(settled)
    asked = settled["_bucket"].to_numpy()
    flags = np.zeros(len(to), bool)
    flags[np.repeat(np.isin(bucket, asked), sizes)] = _from_bits(settled["_shared"], sizes[np.isin(bucket, asked)])
    at = np.flatnonzero(flags[number])
    first, of = _distinct(p, at, to[number[at]])
    first = at[first]
    status, counts = _numbers(settled["_data"])
    bucket, sizes = _runs(to[number[first]])
    _agree(asked, bucket)
    _agree(counts, sizes)
    return at, of, first, to[number[first]], status


def _send_texts(table: pa.Table, settled: pa.Table, buckets: int) -> pa.Table:
    p = parse(X.as_bytes(table["_text"]) if len(table) else [])
    _, _, first, to, status = _recall(p, settled, buckets)
    say = status == CONTESTED
    first, (bucket, sizes) = first[say], _runs(to[say])
    size = p.windows[first] + (WINDOW - 1)
    return _table(bucket=bucket, chunk=np.full(len(bucket), table["_chunk"][0].as_py() if len(table) else 0), windows=_binary(p.windows[first].astype(np.uint8), sizes),
                  text=_binary(p.texts(first), np.add.reduceat(size, np.cumsum(sizes) - sizes) if len(sizes) else sizes))


def _words(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The 8 bytes at ``depth`` of each suffix as a number; beyond a window, and beyond the text, they are 0."""
    out = np.ndarray((len(text) - 7,), ">u8", text, strides=(1,))[at + depth].astype(np.uint64)
    beyond = max(0, depth + 8 - WINDOW)
    return out >> np.uint64(8 * beyond) << np.uint64(8 * beyond) if beyond else out


def suffix_order(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at these places to the depth of a window, and which differ from the one before."""
    text = np.concatenate([text, np.zeros(WINDOW + 8, np.uint8)])
    key = _words(text, at, 0)
    order = np.argsort(key)
    new = _new(key[order])
    for depth in range(8, WINDOW, 8):
        # those that agree so far, by what comes next
        ends = np.append(new[1:], True)
        tied = np.flatnonzero(~(new & ends))
        if not len(tied):
            break
        key = _words(text, at[order[tied]], depth)
        by_key = np.argsort(key)
        rank = np.empty(len(tied), np.uint64)
        rank[by_key] = np.cumsum(_new(key[by_key]))
        rank |= np.cumsum(new[tied]).astype(np.uint64) << np.uint64(32)
        by_rank = np.argsort(rank)
        order[tied] = order[tied][by_rank]
        new[tied] = _new(rank[by_rank])
    return order, new


def _smaller(text: np.ndarray, windows: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Of each phrase, the windows (as bits) that a phrase of smaller rank has too."""
    if not len(windows):
        return np.zeros(0, np.uint32)
    size = windows.astype(np.int64)
    begin = np.cumsum(size + (WINDOW - 1)) - (size + (WINDOW - 1))
    order, new = suffix_order(text, _ranges(begin, size))
    rank = np.repeat(rank, size)
    cut = np.flatnonzero(new)
    least = np.repeat(np.minimum.reduceat(rank[order], cut), np.diff(np.append(cut, len(order))))
    first = np.empty(len(order), rank.dtype)
    first[order] = least
    bits = np.left_shift(np.uint32(1), _ranges(np.zeros(len(size), np.int64), size).astype(np.uint32))
    return np.bitwise_or.reduceat(np.where(first < rank, bits, np.uint32(0)), np.cumsum(size) - size)


def _sort_dictionary(rows: pa.Table) -> pa.Table:
    """For each contested phrase sent: the windows (as bits) that an earlier chunk has."""
    (windows, sizes), (text, _) = _numbers(rows["_windows"]), _numbers(rows["_text"])
    mask = _smaller(text, windows, np.repeat(rows["_chunk"].to_numpy(), sizes))
    return _table(bucket=rows["_bucket"].to_numpy(), chunk=rows["_chunk"].to_numpy(), data=_binary(mask, sizes))


def _remove(table: pa.Table, answers: pa.Table, schema: pa.Schema, buckets: int) -> pa.Table:
    if not len(table):
        return schema.empty_table()
    texts, missing = X.as_bytes(table["_text"]), table["_id"].is_null().to_numpy()
    rank = np.unique(table["_id"].fill_null(0).to_numpy(), return_inverse=True)[1]
    rank[missing] = len(rank)
    p = parse(texts)
    at, of, first, to, status = _recall(p, answers.filter(answers["_shared"].is_valid()), buckets)
    every = ((np.uint64(1) << p.windows.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)
    gone = np.where(status == LATER, every[first], np.uint32(0))
    masks = _in_order(answers.filter(answers["_shared"].is_null()))
    mask, counts = _numbers(masks["_data"], "u4")
    _agree(np.repeat(masks["_bucket"].to_numpy(), counts), to[status == CONTESTED])
    gone[status == CONTESTED] = mask
    bits = np.zeros(len(every), np.uint32)
    bits[at] = gone[of]
    _repeats_inside(p, rank[p.doc], every, bits)
    return _cut(table, texts, p, bits, schema)


def _repeats_inside(p: Phrases, doc: np.ndarray, every: np.ndarray, bits: np.ndarray) -> None:
    """Phrases and windows that a smaller document of the chunk has, into ``bits``. What is gone for all of the chunk is out."""
    left = np.flatnonzero(bits != every)
    if not len(left):
        return
    order, new = _by_fingerprint(p.hi[left], p.lo[left])
    order = left[order]
    of, cut = np.cumsum(new) - 1, np.flatnonzero(new)
    least = np.minimum.reduceat(doc[order], cut)
    copy = doc[order] > least[of]
    # windows of phrases whose trigger has others, of other documents
    some = np.flatnonzero(_several(p.trigger[order[cut]]))
    some = some[np.argsort(p.trigger[order[cut[some]]])]
    if len(some):
        begin = np.flatnonzero(_new(p.trigger[order[cut[some]]]))
        differ = np.minimum.reduceat(least[some], begin) < np.maximum.reduceat(least[some], begin)
        some = some[np.repeat(differ, np.diff(np.append(begin, len(some))))]
    entry = order[cut[some]]
    mask = np.zeros(len(cut), np.uint32)
    mask[some] = _smaller(p.texts(entry), p.windows[entry], least[some])
    bits[order] |= np.where(copy, every[order], mask[of])


def _cut(table: pa.Table, texts: list[bytes], p: Phrases, bits: np.ndarray, schema: pa.Schema) -> pa.Table:
    some = np.flatnonzero(bits)
    row, number = np.nonzero(np.unpackbits(bits[some].astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little"))
    gone = p.start[some][row] + number
    # windows that overlap or touch are one span; texts are a byte apart
    far = gone[1:] > gone[:-1] + WINDOW
    begin, end = gone[np.append(True, far)[:len(gone)]], gone[np.append(far, True)[:len(gone)]] + WINDOW
    doc = np.searchsorted(p.base, begin, side="right") - 1
    n_spans = np.bincount(doc, minlength=len(texts))
    sums = np.concatenate([[0], np.cumsum(end - begin)])
    last = np.cumsum(n_spans)
    n_removed = sums[last] - sums[last - n_spans]
    kept = list(texts)
    for k in np.flatnonzero(n_spans).tolist():
        spans = slice(last[k] - n_spans[k], last[k])
        starts, stops = [*begin[spans].tolist(), int(p.base[k + 1]) - 1], [int(p.base[k]), *end[spans].tolist()]
        kept[k] = b"".join(p.raw[a:b] for a, b in zip(stops, starts, strict=True))
    return pa.Table.from_arrays([table["_id"], pa.array([len(t) for t in texts], pa.int64()), pa.array(n_removed, pa.int64()),
                                 pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())], schema=schema)


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept)``: ``kept`` is the remaining bytes; a row per row of ``docs``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    d, buckets = C.in_chunks(docs, id_col, text_col, [])
    by_chunk = d.select("_id", "_text", "_chunk").groupBy("_chunk")
    triggers = by_chunk.applyInArrow(lambda t: _send_triggers(t, buckets), ROW_SCHEMA)
    shared = triggers.groupBy("_bucket").applyInArrow(_shared, ROW_SCHEMA)
    phrases = by_chunk.cogroup(shared.groupBy("_chunk")).applyInArrow(lambda t, a: _send_phrases(t, a, buckets), PHRASE_SCHEMA)
    settled = phrases.groupBy("_bucket").applyInArrow(_settle, PHRASE_SCHEMA)
    texts = by_chunk.cogroup(settled.groupBy("_chunk")).applyInArrow(lambda t, a: _send_texts(t, a, buckets), TEXT_SCHEMA)
    masks = texts.groupBy("_bucket").applyInArrow(_sort_dictionary, ROW_SCHEMA)
    answers = settled.unionByName(masks.withColumn("_shared", F.lit(None).cast("binary")))
    schema = T.StructType([T.StructField(id_col, T.LongType()), *(T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")),
                           T.StructField("kept", T.BinaryType())])
    arrow = to_arrow_schema(schema)
    return by_chunk.cogroup(answers.groupBy("_chunk")).applyInArrow(lambda t, a: _remove(t, a, arrow, buckets), schema)
