"""Chunks of documents in id order, and buckets of fingerprints.

Corpus-wide "does this fingerprint occur earlier" questions are answered in two
shuffles of packed arrays instead of a row per fingerprint:

* documents are dealt to chunks, each an id range of bounded text size;
* a chunk sends each of its distinct fingerprints once to the fingerprint's
  bucket (so a fingerprint that a third of all documents hold costs one entry
  per chunk), and the bucket answers the chunks;
* the chunk, co-grouped with the answers, finds the places again.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes of a chunk, about; bounds what one Python call holds.
CHUNK_BYTES = 4 << 20


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_chunks(docs: DataFrame, id_col: str, text_col: str, carry: list[str],
              chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, int]:
    """``(_id, _text, carry..., _chunk)`` hashed by chunk, and the number of buckets.

    Chunk numbers rise with the id; NULL ids come last. One aggregate over the
    table finds the size and the id quantiles that bound the chunks: a number
    per chunk comes to the driver, nothing per document.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"), *carry)
    size = d.agg(F.coalesce(F.sum(F.octet_length("_text") + 64), F.lit(0)), F.count("_id")).first()
    n = max(1, min(math.ceil(size[0] / chunk_bytes), size[1]))
    cuts: list[int] = []
    if n > 1:
        at = [k / n for k in range(1, n)]
        cuts = sorted(set(d.agg(F.percentile_approx("_id", at, max(10_000, min(10 * n, 1_000_000)))).first()[0]))
    bounds = np.array(cuts, np.int64)

    @F.arrow_udf("int")
    def chunk_of(ids: pa.Array) -> pa.Array:
        out = np.searchsorted(bounds, ids.fill_null(0).to_numpy(zero_copy_only=False), side="right")
        out[ids.is_null().to_numpy(zero_copy_only=False)] = len(bounds)
        return pa.array(out, pa.int32())

    p = partitions(spark)
    return d.withColumn("_chunk", chunk_of("_id")).repartition(p, "_chunk"), 2 * p


def _runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of equal keys."""
    cut = np.flatnonzero(np.diff(sorted_keys, prepend=-1))
    return cut, np.append(cut, len(sorted_keys))[1:]


PACK_SCHEMA = "_bucket int, _chunk int, _data binary"


def pack(chunk: int, buckets: int, *cols: np.ndarray) -> pa.Table:
    """Rows of ``PACK_SCHEMA``: the columns, dealt by the first one's value."""
    to = ((cols[0] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    to, cols = to[order], [c[order] for c in cols]
    cut, ends = _runs(to)
    return pa.table({
        "_bucket": pa.array(to[cut].astype(np.int32)),
        "_chunk": pa.array(np.full(len(cut), chunk, np.int32)),
        "_data": pa.array([b"".join(c[a:b].tobytes() for c in cols) for a, b in zip(cut, ends, strict=True)], pa.binary()),
    })


def unpack(rows: pa.Table, *kinds: str) -> tuple[list[np.ndarray], np.ndarray]:
    """Packed columns of all rows, and the chunk of each entry."""
    width = sum(np.dtype(k).itemsize for k in kinds)
    parts: list[list[np.ndarray]] = [[] for _ in kinds]
    chunks = rows["_chunk"].to_numpy() if len(rows) else np.zeros(0, np.int32)
    sizes = []
    for data in rows["_data"].to_pylist():
        n, at = len(data) // width, 0
        sizes.append(n)
        for k, kind in enumerate(kinds):
            parts[k].append(np.frombuffer(data, kind, n, at))
            at += n * np.dtype(kind).itemsize
    cols = [np.concatenate(p) if p else np.zeros(0, k) for p, k in zip(parts, kinds, strict=True)]
    return cols, np.repeat(chunks, sizes)


ANSWER_SCHEMA = "_chunk int, _data binary"


def answer(chunks: np.ndarray, *cols: np.ndarray) -> pa.Table:
    """Rows of ``ANSWER_SCHEMA``: the columns, by chunk."""
    order = np.argsort(chunks, kind="stable")
    to, cols = chunks[order], [c[order] for c in cols]
    cut, ends = _runs(to)
    return pa.table({
        "_chunk": pa.array(to[cut].astype(np.int32)),
        "_data": pa.array([b"".join(c[a:b].tobytes() for c in cols) for a, b in zip(cut, ends, strict=True)], pa.binary()),
    })


def shared(packed: DataFrame, *kinds: str) -> DataFrame:
    """Answers of ``ANSWER_SCHEMA``: fingerprints that two or more chunks sent."""
    def reduce(rows: pa.Table) -> pa.Table:
        cols, chunk = unpack(rows, *kinds)
        order, new = _grouped(cols, chunk)
        group = np.cumsum(new) - 1
        hit = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
        at = order[hit]
        return answer(chunk[at], *(c[at] for c in cols))

    return packed.groupBy("_bucket").applyInArrow(reduce, ANSWER_SCHEMA)


def not_first(packed: DataFrame, *kinds: str) -> DataFrame:
    """Answers of ``ANSWER_SCHEMA``: to each chunk, the fingerprints an earlier chunk sent too."""
    def reduce(rows: pa.Table) -> pa.Table:
        cols, chunk = unpack(rows, *kinds)
        order, new = _grouped(cols, chunk)
        at = order[~new]
        return answer(chunk[at], *(c[at] for c in cols))

    return packed.groupBy("_bucket").applyInArrow(reduce, ANSWER_SCHEMA)


def _grouped(cols: list[np.ndarray], chunk: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by fingerprint, then chunk; a mask of each fingerprint's first."""
    order = np.lexsort((chunk, *cols[::-1]))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = False
        for c in cols:
            s = c[order]
            new[1:] |= s[1:] != s[:-1]
    return order, new
