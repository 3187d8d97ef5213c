"""Phrase collocations by prefix-free parsing.

Texts in lower case (A-Z) fall into pieces at ``[.,;:!?\\x0A-\\x0D]`` and these
into words ``[^\\x20\\x09]+``; a phrase is a run of words of one piece. All counts
are per language.

* Parsing: a window of ``longest - 1`` words whose rolling hash is 0 modulo
  ``TRIGGER`` is a trigger. A chunk runs from one trigger to the next (or for
  ``CHUNK_WORDS`` words) and takes in the next one's window, so that chunks
  overlap by it and every phrase lies whole in the chunk in which it starts.
  Equal content gives equal chunks wherever it stands: copies and shared
  passages become entries of the dictionary with a frequency.
* Counting: the phrases of each distinct chunk, weighted by its frequency. A
  phrase counts where it starts in the chunk's own words; the overlap is context
  only, so what two chunks share counts once.
* Block by block a task sends each distinct phrase once to its bucket, packed;
  the buckets' number follows the bytes of text, so a bucket's size doesn't grow
  and a phrase that is everywhere costs an entry per block.
* Scores are joins of the frequent phrases with their parts, in decimals.

A chunk is text: words with a space between them, a line feed where a piece
ends, a carriage return where the overlap begins; words hold none of the three.

Result for special rows: NULL and empty text has no words; a NULL language is
``und``; repeated rows count each; ties go by more occurrences, then by the
phrase's bytes; an empty table gives an empty result. Other columns are not
read, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnlog.llm import text as X
from learnlog.llm.graph import written

LONGEST = 3
LEAST = 10
TOP = 2000
#: One window of words in so many is a trigger.
TRIGGER = 12
#: Words after which a chunk ends without a trigger.
CHUNK_WORDS = 64
#: Bytes of chunks whose phrases are counted at once.
BLOCK_BYTES = 4 << 20
#: Bytes of text per bucket of phrases, about.
BUCKET_BYTES = 4 << 20
#: Parts of a language that are ranked by themselves first.
RANK_PARTS = 64

_SPACE, _BREAK = np.zeros(256, bool), np.zeros(256, bool)
_SPACE[[0x20, 0x09]] = True
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FACTOR = np.uint64(0x9FB21C651E98DF25)


def _ranges(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Byte ranges, one after the other."""
    at = np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)
    return data[at]


def _strings(data: np.ndarray, size: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Consecutive runs of bytes as strings."""
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32 if kind == pa.string() else np.int64)
    return pa.Array.from_buffers(kind, len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def parse(texts: list[bytes], longest: int = LONGEST) -> tuple[pa.Array, np.ndarray]:
    """Chunks of a slice of texts, and the text of each."""
    raw = _LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
    ends_piece = _BREAK[raw]
    edge = np.diff(np.concatenate([[0], (~(ends_piece | _SPACE[raw])).view(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    n = len(start)
    if not n:
        return pa.array([], pa.large_string()), np.zeros(0, np.int64)
    first = np.searchsorted(start, np.cumsum([0] + [len(t) + 1 for t in texts]))
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    piece = np.cumsum(ends_piece)[start]
    joined = np.append(piece[1:] == piece[:-1], False)          # the next word is of the same piece
    # triggers: windows of longest - 1 words of one text
    h = X.Words(raw, start, end, doc, first).hashes()
    window = max(1, longest - 1)
    begins = np.zeros(n, bool)
    at = np.arange(n - window + 1)
    begins[at] = (X.grams(h, window) % np.uint64(TRIGGER) == 0) & (doc[at] == doc[at + window - 1])
    begins[first[:-1][np.diff(first) > 0]] = True
    since = np.arange(n) - np.maximum.accumulate(np.where(begins, np.arange(n), 0))
    begins |= since % CHUNK_WORDS == 0
    chunk = np.flatnonzero(begins)
    last = np.append(chunk[1:], n) - 1                           # last own word
    to = last
    for _ in range(longest - 1):                                 # overlap: the words that phrases of the own ones run on to
        to = np.where(joined[to], np.minimum(to + 1, n - 1), to)
    # a byte after each word: a space, or a line feed where its piece ends
    size = end - start + 1
    stream = _ranges(np.append(raw, np.uint8(0)), start, size)
    place = np.concatenate([[0], np.cumsum(size)])
    stream[place[1:] - 1] = np.where(joined, 0x20, 0x0A)
    length = place[to + 1] - 1 - place[chunk]
    out = _ranges(stream, place[chunk], length)
    more = to > last
    out[(np.cumsum(length) - length + place[last + 1] - 1 - place[chunk])[more]] = 0x0D
    return _strings(out, length, pa.large_string()), doc[chunk]


def count_phrases(chunks: list[bytes], weight: np.ndarray, longest: int = LONGEST) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct phrases that start in the chunks' own words, their weighted counts, and a hash of each."""
    data = np.frombuffer(b"\n".join([*chunks, b""]), np.uint8)
    end = np.flatnonzero((data == 0x20) | (data == 0x0A) | (data == 0x0D))
    start, mark = np.append(0, end[:-1] + 1), data[end]
    first = np.searchsorted(start, np.cumsum([0] + [len(c) + 1 for c in chunks]))
    chunk = np.repeat(np.arange(len(chunks)), np.diff(first))
    overlaps = np.cumsum(mark == 0x0D) - (mark == 0x0D)          # that begin before each word
    own, joined = overlaps == overlaps[first[:-1]][chunk], mark != 0x0A
    inside = np.ones(len(data), bool)
    inside[end] = False
    encoded = _strings(data[inside], end - start, pa.large_string()).dictionary_encode()
    order = pc.sort_indices(encoded.dictionary).to_numpy()       # so that packed phrases are in order, too
    words = encoded.dictionary.take(pa.array(order))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    word = rank[encoded.indices.to_numpy()]
    size = pc.binary_length(words).to_numpy().astype(np.int64)
    letters = np.frombuffer(b"".join(words.cast(pa.large_binary()).to_pylist()), np.uint8)
    begin = np.cumsum(size) - size
    hashes = X.Words(letters, begin, begin + size, begin, begin).hashes()
    out, counts, keys = [], [], []
    # where phrases start, the rank of each one's phrase so far, and the words of each rank
    at = np.flatnonzero(own)
    part, spelled = word[at], np.arange(len(words))[:, None]
    for k in range(longest):
        if k:
            goes_on = joined[at + k - 1]
            at, part = at[goes_on], part[goes_on]
            distinct, part = np.unique(part * len(words) + word[at + k], return_inverse=True)
            spelled = np.column_stack([spelled[distinct // len(words)], distinct % len(words)])
        n = np.bincount(part, weight[chunk[at]], len(spelled)).astype(np.int64)
        use = spelled[n > 0]                                     # words of overlaps alone have no count
        parts = [words.take(pa.array(use[:, c])) for c in range(k + 1)]
        out.append(pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if k else parts[0])
        counts.append(n[n > 0])
        h = hashes[use[:, 0]]
        for c in range(1, k + 1):
            h = h * _FACTOR + hashes[use[:, c]]
        keys.append(X.mix64(h))
    return pa.concat_arrays(out), np.concatenate(counts), np.concatenate(keys)


def dictionary(docs: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``(lang, chunk, f)``: distinct chunks of ``docs(text, lang)`` and how often the parse has them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = X.as_bytes(batch["text"])
            for a, b in X.slices(texts):
                chunks, of = parse(texts[a:b], longest)
                found = pa.table({"lang": batch["lang"].slice(a, b - a).take(pa.array(of)), "chunk": chunks})
                found = found.group_by(["lang", "chunk"], use_threads=False).aggregate([([], "count_all")])
                yield from pa.table({"lang": found["lang"], "chunk": found["chunk"].cast(pa.string()), "f": found["count_all"]}).to_batches()

    return docs.mapInArrow(run, "lang string, chunk string, f long").groupBy("lang", "chunk").agg(F.sum("f").alias("f"))


def _joined(values: pa.Array, cuts: np.ndarray) -> pa.Array:
    """Values between the cuts as lines of one text."""
    lists = pa.LargeListArray.from_arrays(pa.array(cuts, pa.int64()), values)
    return pc.binary_join(lists, pa.scalar("\n", pa.large_string())).cast(pa.string())


def _lines(texts: pa.ChunkedArray) -> pa.ChunkedArray:
    return pa.chunked_array([pc.split_pattern(c.cast(pa.large_string()), "\n").flatten() for c in texts.chunks], pa.large_string())


def phrase_counts(docs: DataFrame, longest: int, least: int, buckets: int) -> DataFrame:
    """``(lang, k, phrase, f)`` of phrases of ``k`` words with ``f`` of ``least`` or more, and rows of ``k`` 0: words in all, to be added up."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            for lang in rows["lang"].unique().to_pylist():
                own = rows.filter(pc.equal(rows["lang"], lang))
                phrases, n, key = count_phrases(own["chunk"].cast(pa.binary()).to_pylist(), own["f"].to_numpy(), longest)
                to = ((key >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                cut = np.flatnonzero(np.diff(to[order], prepend=-1))
                cuts = np.append(cut, len(order))
                yield pa.record_batch({
                    "bucket": pa.array(to[order[cut]], pa.int64()), "lang": pa.array([lang] * len(cut), pa.string()),
                    "phrases": _joined(phrases.take(pa.array(order)), cuts), "counts": _joined(pa.array(n[order]).cast(pa.large_string()), cuts)})

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch["chunk"].nbytes
            if size >= BLOCK_BYTES:
                yield from block(pa.Table.from_batches(held))
                held, size = [], 0
                X.release_memory()
        if held:
            yield from block(pa.Table.from_batches(held))

    def add_up(rows: pa.Table) -> pa.Table:
        X.release_memory()
        out = []
        for lang in rows["lang"].unique().to_pylist():
            own = rows.filter(pc.equal(rows["lang"], lang))
            sums = pa.table({"phrase": _lines(own["phrases"]), "f": _lines(own["counts"]).cast(pa.int64())}).group_by("phrase", use_threads=False).aggregate([("f", "sum")])
            k = pc.add(pc.count_substring(sums["phrase"], " "), 1)
            words = pc.sum(sums.filter(pc.equal(k, 1))["f_sum"]).as_py() or 0
            often = pc.greater_equal(sums["f_sum"], least)
            kept, k = sums.filter(often), pc.filter(k, often)
            out += [pa.table({"lang": pa.array([lang] * len(kept), pa.string()), "k": k.cast(pa.int32()), "phrase": kept["phrase"].cast(pa.string()), "f": kept["f_sum"]}),
                    pa.table({"lang": pa.array([lang], pa.string()), "k": pa.array([0], pa.int32()), "phrase": pa.array([""], pa.string()), "f": pa.array([words], pa.int64())})]
        return pa.concat_tables(out)

    return (dictionary(docs, longest).mapInArrow(send, "bucket long, lang string, phrases string, counts string")
            .groupBy("bucket").applyInArrow(add_up, "lang string, k int, phrase string, f long"))


def _some(phrase: str, begin: int | Column, n: int | Column) -> Column:
    """``n`` words of a phrase from word ``begin`` (from 1) on."""
    return F.array_join(F.slice(F.split(phrase, " "), begin, n), " ")


def phrase_collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP,
                        longest: int = LONGEST) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` phrases of 2 to ``longest`` words.

    ``a`` is the phrase's count, ``l`` and ``r`` those of its parts at the cut
    with the smallest ``score`` = floor(1000000 a a / (l r)), ``n`` the words of
    the language. A phrase with half of its occurrences or more inside one
    longer phrase gives way to that.
    """
    if longest < 2 or least < 1:
        raise ValueError("phrases have 2 words or more and occur at all")
    d = docs.select(F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    size = d.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    counted, _ = written(phrase_counts(d, longest, least, max(1, -(-size // BUCKET_BYTES))), "phrases")
    totals = counted.where("k = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    often = counted.where("k > 0")
    candidates = often.where("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"))
    # the largest count of a longer phrase that holds a candidate
    if longest > 2:
        parts = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda n: F.transform(
            F.sequence(F.lit(1), F.col("k") - n + 1), lambda i: _some("phrase", i, n)))))
        holders = (candidates.where("k > 2").select("lang", F.col("a").alias("longer"), F.explode(parts).alias("phrase"))
                   .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
        candidates = candidates.join(holders, ["lang", "phrase"], "left").where("longer is null or 2 * longer < a")
    cuts = candidates.select("lang", "phrase", "a", "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", _some("phrase", F.lit(1), F.col("cut")).alias("left"),
                       _some("phrase", F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    left = often.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = often.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    whole = [F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")]
    score = F.expr("(a2 * 1000000) div lr")
    scored = (cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
              .withColumns({"a2": (whole[0] * whole[0]).cast("decimal(31,0)"), "lr": (whole[1] * whole[2]).cast("decimal(38,0)")})
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("least"))
              .select("lang", "phrase", "a", "least.l", "least.r", "least.score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
