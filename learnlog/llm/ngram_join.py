"""N-gram Jaccard join by parity sketches.

Documents whose sets of word shingles (3 words, or ``shingle``) have a Jaccard
similarity of at least ``num / den`` are linked; linked documents form components.

* Size bands: a link's sizes lie in one band or two neighbouring ones, so a
  document joins its own band and the one below.
* Parity sketch: a band whose links differ in at most ``d`` shingles has
  ``d + 1`` blocks of 65,536 bits. A shingle belongs to one block and flips one
  bit of it, so the Hamming distance of two sketches is at most the size of the
  sets' symmetric difference, and linked documents agree on a whole block
  (pigeonhole). A block travels as the XOR of its bits' codes.
* At a low similarity a block has few shingles, many are empty, and unlike
  documents agree on one. There the sketch leaves out common shingles (that a
  sample of the sets has often: this takes nothing from the bound, whichever they
  are) and has spare blocks. A set with more than ``d`` blocks that aren't empty
  is linked by one of those; the others send a sketch of all shingles too, and
  its empty blocks if they are still not more than ``d``.
* Documents that agree on a block are candidates: a block's bucket gives each of
  its sets the block's smallest one as a leader, so any two of them have a leader
  in common. There are at most as many such pairs as blocks, not all pairs.
* Candidates are tested by Hamming distance before anything is clustered: a set
  has a sketch of its own band and one of the band below, of about as many bits
  as the sets have shingles. Sets of a leader and of one band or two neighbouring
  ones are compared by XOR and bit counts, ``SKETCHES`` by ``SKETCHES`` per task;
  those that differ in more bits than linked sets can are no pair. The connected
  components of the pairs that are left are the clusters within which all links
  lie. Texts that only share a passage leave here, before any text is sent.
* In a cluster, equal sets are one class, and classes are compared exactly,
  ``TILE`` by ``TILE`` per task, by a product of incidence matrices. A tile
  gives a spanning forest of its links and the number of links per class; no
  pair leaves it.

Shingles and sets are compared by 64-bit and 128-bit hashes.

Result for special rows: NULL, empty or blank text has an empty set, links with
nothing and is its own component; fewer words than a shingle has are one
shingle; rows with the same id are one node of the graph; a row without an id takes no part and
has a NULL component; an empty table gives an empty result. Other columns are
not read, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlog.llm import text as X
from learnlog.llm.chunks import partitions
from learnlog.llm.graph import components, written

SHINGLE = 3
NUM, DEN = 90, 100
#: Below that many shingles in a block, common ones are left out and there are spare blocks.
THIN = 6
#: Blocks for each allowed difference then.
SPARE = 1.15
#: Shingles of the sample that tells the common ones, about, and how often it has those.
SAMPLE, COMMON = 1 << 23, 8
#: Least bits of a sketch.
BITS = 128
#: Sketches of a leader and band that one task compares with as many others, and bytes of them, about.
SKETCHES, SKETCH_BYTES = 2048, 8 << 20
#: Classes of a cluster that one task compares with as many others.
TILE = 1024
#: Shingles in all that those classes have, about.
TILE_SHINGLES = 1 << 20
#: Shingles per matrix product.
COLUMNS = 2048
#: Entries that a map task gathers before it sends them.
FLUSH = 1 << 20


def shingle_sets(texts: list[bytes], n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, one after the other; their bounds."""
    parts, sizes = [np.zeros(0, np.uint64)], []
    for a, b in X.slices(texts):
        words = X.words_of(texts[a:b], lower=True)
        h = words.hashes()
        at = X.gram_starts(words, n)
        doc, key = words.doc[at], X.grams(h, n)[at] if len(at) else np.zeros(0, np.uint64)
        count = words.count
        for k in np.flatnonzero((count > 0) & (count < n)):
            whole = X.grams(h[words.first[k]:words.first[k + 1]], int(count[k]), salt=n)
            doc, key = np.append(doc, k), np.append(key, whole)
        order, new = X.first_of_each(doc, key)
        keep = order[new]
        parts.append(key[keep])
        sizes.append(np.bincount(doc[keep], minlength=b - a))
    return np.concatenate(parts), np.concatenate([[0], *sizes]).cumsum().astype(np.int64)


def set_ids(keys: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set."""
    def total(x: np.ndarray) -> np.ndarray:
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
        return X.mix64(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64))
    return total(X.mix64(keys, 11)), total(X.mix64(keys, 12))


def size_bands(most: int, num: int = NUM, den: int = DEN) -> np.ndarray:
    """Least set size of each band, to beyond ``most``: links are in one band or two neighbouring ones."""
    bands = [1]
    while bands[-1] <= most:
        bands.append(bands[-1] * den // num + 1)
    return np.array(bands, np.int64)


def sketch_blocks(keys: np.ndarray, bounds: np.ndarray, num: int = NUM, den: int = DEN,
                  common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hash of (band, block, block's bits) for each block of each set's sketches; the set's index.

    With ``common`` (sorted shingles), for thin blocks: these are left out, and empty blocks where others suffice.
    """
    sizes = np.diff(bounds)
    bands = size_bands(int(sizes.max(initial=0)), num, den)
    own = np.searchsorted(bands, sizes, side="right") - 1
    out, of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for below in (0, 1):
        sets = np.flatnonzero((sizes > 0) & (own >= below))
        if not len(sets):
            continue
        band = own[sets] - below
        # sizes a <= b of a link with a in the band: |A xor B| <= (a + b)(den - num)/(den + num), b <= a den / num
        most = bands[band + 1] - 1
        differ = (most + most * den // num) * (den - num) // (den + num)
        blocks = (differ if common is None else (differ * SPARE).astype(np.int64)) + 1
        at = np.concatenate([np.arange(bounds[s], bounds[s + 1]) for s in sets])
        row = np.repeat(np.arange(len(sets)), sizes[sets])
        h = X.mix64(keys[at], 21)
        block = ((h >> np.uint64(32)) % blocks.astype(np.uint64)[row]).astype(np.int64)
        code = X.mix64(h & np.uint64(0xFFFF), 22)
        begin = np.concatenate([[0], np.cumsum(blocks)])
        owner = np.repeat(np.arange(len(sets)), blocks)
        number = np.arange(begin[-1]) - begin[owner]
        tag = band[owner].astype(np.uint64) << np.uint64(40) | number.astype(np.uint64)
        send = np.ones(len(sets), bool)
        if common is not None:
            rare = ~X.contains(common, keys[at])
            sketch = np.zeros(begin[-1], np.uint64)
            np.bitwise_xor.at(sketch, (begin[row] + block)[rare], code[rare])
            out.append(X.mix64(sketch ^ X.mix64(tag, 24))[sketch != 0])
            of.append(sets[owner[sketch != 0]])
            send = np.bincount(owner, sketch != 0, len(sets)) <= differ
        sketch = np.zeros(begin[-1], np.uint64)
        np.bitwise_xor.at(sketch, begin[row] + block, code)
        empty = np.ones(len(sets), bool) if common is None else np.bincount(owner, sketch != 0, len(sets)) <= differ
        use = send[owner] & (empty[owner] | (sketch != 0))
        out.append(X.mix64(sketch ^ X.mix64(tag, 23))[use])
        of.append(sets[owner[use]])
    return np.concatenate(out), np.concatenate(of)


def band_bits(bands: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Bits of a sketch of each band: the most shingles of its sets, in words of 64."""
    return -(-np.maximum(bands[band + 1] - 1, BITS) // 64) * 64


def parity_sketches(keys: np.ndarray, bounds: np.ndarray, num: int, den: int) -> tuple[np.ndarray, list[list[bytes | None]]]:
    """The band of each set (-1: empty), and each set's sketches of its band and of the band below (or None)."""
    sizes = np.diff(bounds)
    bands = size_bands(int(sizes.max(initial=0)), num, den)
    own = np.searchsorted(bands, sizes, side="right") - 1
    h, owner = X.mix64(keys, 25), np.repeat(np.arange(len(sizes)), sizes)
    out: list[list[bytes | None]] = []
    for below in (0, 1):
        have = (sizes > 0) & (own >= below)
        bits = np.where(have, band_bits(bands, np.maximum(own - below, 0)), 0)
        ends = np.cumsum(bits)
        at = have[owner]
        flips = np.bincount(((ends - bits)[owner] + (h % np.maximum(bits, 1).astype(np.uint64)[owner]).astype(np.int64))[at], minlength=int(ends[-1]) if len(ends) else 0)
        data = np.packbits((flips & 1).astype(np.uint8)).tobytes()
        out.append([data[(e - b) // 8:e // 8] if b else None for b, e in zip(bits.tolist(), ends.tolist(), strict=True)])
    return own, out


def common_shingles(docs: DataFrame, shingle: int, total: int) -> np.ndarray:
    """Shingles that a sample of the sets (by text hash) has more than ``COMMON`` times, sorted; ``total``: of all sets."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = X.as_bytes(batch["text"])
            for x, y in X.slices(texts):
                yield pa.record_batch({"key": pa.array(shingle_sets(texts[x:y], shingle)[0].view(np.int64))})

    parts = max(1, total // SAMPLE)
    sample = docs.select("text").where(F.pmod(F.xxhash64("text"), F.lit(parts)) == 0)
    often = sample.mapInArrow(send, "key long").groupBy("key").count().where(F.col("count") > COMMON)
    # a sample of at most about SAMPLE shingles has at most SAMPLE / COMMON such
    return np.sort(np.array([r["key"] for r in often.select("key").toLocalIterator()], np.int64).view(np.uint64))


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars (node, smallest node) with the connected components of edges a-b."""
    nodes, both = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = both[: len(a)], both[len(a):]
    root = np.arange(len(nodes))
    while len(x):
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while (root[root] != root).any():
            root = root[root]
        open_ = root[x] != root[y]
        x, y = x[open_], y[open_]
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _leaders(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node that has a key in common with a smaller one, with the smallest of those; distinct pairs."""
    order = np.lexsort((nodes, keys))
    k, n = keys[order], nodes[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    low = n[new][np.cumsum(new) - 1]
    far = n != low
    n, low = n[far], low[far]
    order, new = X.first_of_each(n, low)
    return n[order[new]], low[order[new]]


def candidates(docs: DataFrame, num: int, den: int, shingle: int = SHINGLE, common: np.ndarray | None = None) -> DataFrame:
    """``(node, leader)`` of set hashes: all sets that agree on a block have its smallest as a leader (which has itself)."""
    buckets = 2 * partitions(docs.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            key, node = np.concatenate([k for k, _ in kept]), np.concatenate([n for _, n in kept])
            kept.clear()
            order, new = X.first_of_each(key, node)
            key, node = key[order[new]], node[order[new]]
            to = ((key >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            cut = np.searchsorted(to[order], np.arange(buckets + 1))
            rows = [(i, order[x:y]) for i, (x, y) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if y > x]
            return pa.record_batch({"bucket": pa.array([i for i, _ in rows], pa.int32()),
                                    "data": pa.array([key[o].tobytes() + node[o].tobytes() for _, o in rows], pa.binary())})

        for batch in batches:
            texts = X.as_bytes(batch["text"])
            for x, y in X.slices(texts):
                keys, bounds = shingle_sets(texts[x:y], shingle)
                node = set_ids(keys, bounds)[0].view(np.int64)
                key, of = sketch_blocks(keys, bounds, num, den, common)
                kept.append((key, node[of]))
                if sum(len(k) for k, _ in kept) >= FLUSH:
                    yield flush()
        if kept:
            yield flush()

    def reduce(rows: pa.Table) -> pa.Table:
        key, node = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for data in rows["data"].to_pylist():
            n = len(data) // 16
            key.append(np.frombuffer(data, "u8", n))
            node.append(np.frombuffer(data, "i8", n, 8 * n))
        x, y = _leaders(np.concatenate(key), np.concatenate(node))
        own = np.unique(y)
        return pa.table({"node": pa.array(np.concatenate([x, own])), "leader": pa.array(np.concatenate([y, own]))})

    return (docs.select("text").mapInArrow(send, "bucket int, data binary")
            .groupBy("bucket").applyInArrow(reduce, "node long, leader long").distinct())


def _with_sets(docs: DataFrame, shingle: int, num: int, den: int) -> DataFrame:
    """``(id, n, node, other, band, own, below)``: each document's set and its two sketches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = X.as_bytes(batch["text"])
            for x, y in X.slices(texts):
                keys, bounds = shingle_sets(texts[x:y], shingle)
                hi, lo = set_ids(keys, bounds)
                band, (own, below) = parity_sketches(keys, bounds, num, den)
                yield pa.record_batch({
                    "id": batch["id"][x:y], "n": pa.array(np.diff(bounds), pa.int64()), "node": pa.array(hi.view(np.int64)), "other": pa.array(lo.view(np.int64)),
                    "band": pa.array(band, pa.int32()), "own": pa.array(own, pa.binary()), "below": pa.array(below, pa.binary())})

    return docs.mapInArrow(run, "id long, n long, node long, other long, band int, own binary, below binary")


def _near(rows: pa.Table, num: int, den: int) -> pa.Table:
    """Stars that join the classes of a tile that sketches don't tell apart."""
    node, n, side = (rows[c].to_numpy() for c in ("node", "n", "side"))
    sketch = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint64).reshape(len(node), -1)
    whole = not rows["cross"][0].as_py() and rows["i"][0].as_py() == rows["j"][0].as_py()
    left, right = (np.flatnonzero(whole | (side == k)) for k in (0, 1))
    others, size = sketch[right], n[right]
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in left.tolist():
        fits = den * np.minimum(n[k], size) >= num * np.maximum(n[k], size)
        fits &= right > k if whole else True
        if fits.any():
            differ = np.bitwise_count(others[fits] ^ sketch[k]).sum(axis=1, dtype=np.int64)
            hit = right[fits][differ <= (n[k] + size[fits]) * (den - num) // (den + num)]
            a.append(np.full(len(hit), node[k]))
            b.append(node[hit])
    x, y = _forest(np.concatenate(a), np.concatenate(b))
    return pa.table({"a": pa.array(x, pa.int64()), "b": pa.array(y, pa.int64())})


def near_edges(candidates: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """``(a, b)`` of nodes that sketches don't tell apart, as stars: linked sets are connected.

    Sets with a leader in common are compared, by bands, tile by tile; rows are
    dealt to tiles before their sketches are joined to them.
    """
    known = sets.where("n > 0 and id is not null").groupBy("node").agg(
        F.first("n").alias("n"), F.first("band").alias("band"), F.first("own").alias("own"), F.first("below").alias("below"))
    known, _ = written(known, "sketches")
    members, _ = written(candidates.join(known.select("node", "n", "band"), "node"), "candidates")
    per_band = members.groupBy("leader", "band").agg(
        F.ceil(F.greatest(F.count("*") / SKETCHES, F.sum("n") / (8 * SKETCH_BYTES))).cast("int").alias("slices"), F.count("*").alias("m"))
    # a leader's sets are of at most a few dozen bands: their number is the logarithm of the largest set
    slices = per_band.groupBy("leader").agg(F.map_from_entries(F.collect_list(F.struct("band", F.struct("slices", "m")))).alias("bands"))

    def of(band):
        return F.coalesce(F.try_element_at("bands", band)["slices"], F.lit(0))

    def numbers(n, use=F.lit(True)):
        return F.when(use & (n > 0), F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def tile(band, cross, i, j, side):
        return F.struct(band.alias("band"), F.lit(cross).alias("cross"), i.alias("i"), j.alias("j"), side.cast("int").alias("side"))

    band, s = F.col("band"), F.pmod(F.xxhash64("node"), of(F.col("band"))).cast("int")
    alone = F.try_element_at("bands", band)["m"] == 1
    tiles = F.concat(
        F.transform(numbers(of(band), ~alone), lambda k: tile(band, False, F.least(k, F.col("s")), F.greatest(k, F.col("s")), k < F.col("s"))),
        F.transform(numbers(of(band + 1)), lambda k: tile(band, True, F.col("s"), k, F.lit(0))),
        F.transform(numbers(of(band - 1)), lambda k: tile(band - 1, True, k, F.col("s"), F.lit(1))))
    rows = (members.join(slices, "leader").withColumn("s", s).select("leader", "node", "n", F.explode(tiles).alias("t"))
            .select("leader", "node", "n", "t.*"))
    sketches = known.select("node", F.explode(F.array(F.struct("band", F.col("own").alias("sketch")), F.struct(
        (F.col("band") - 1).alias("band"), F.col("below").alias("sketch")))).alias("k")).select("node", "k.*").where("sketch is not null")
    return (rows.join(sketches, ["node", "band"]).groupBy("leader", "band", "cross", "i", "j")
            .applyInArrow(lambda t: _near(t, num, den), "a long, b long"))


def _compare(rows: pa.Table, num: int, den: int, shingle: int) -> pa.Table:
    """Links between the classes of block ``i`` and those of block ``j`` of a cluster."""
    i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
    keys, bounds = shingle_sets(X.as_bytes(rows["text"]), shingle)
    hi, lo = set_ids(keys, bounds)
    # an id can have several texts, and a text several rows: one row with the class's own set stays
    node, other, rep = (rows[c].to_numpy() for c in ("node", "other", "rep"))
    order, new = X.first_of_each(rep, node, other)
    use = np.zeros(len(rep), bool)
    own = (hi.view(np.int64)[order] == node[order]) & (lo.view(np.int64)[order] == other[order])
    group = np.cumsum(new) - 1
    at, first = np.unique(group[own], return_index=True)
    use[order[own][first]] = True
    sizes, block, copies = np.diff(bounds), rows["block"].to_numpy(), rows["copies"].to_numpy()
    left, right = np.flatnonzero(use & (block == i)), np.flatnonzero(use & (block == j))
    vocabulary, token = np.unique(keys, return_inverse=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    # a shingle of one row is in no intersection
    common = np.bincount(token, minlength=len(vocabulary)) > 1
    column = np.cumsum(common) - 1
    some = common[token]
    owner, token = owner[some], column[token[some]]
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    inter = np.zeros((len(left), len(right)), np.float32)
    for begin in range(0, int(common.sum()), COLUMNS):
        x, y = np.searchsorted(token, [begin, begin + COLUMNS])
        m = np.zeros((len(sizes), COLUMNS), np.float32)
        m[owner[x:y], token[x:y] - begin] = 1
        inter += m[left] @ m[right].T
    common_size = inter.astype(np.int64)
    linked = den * common_size >= num * (sizes[left][:, None] + sizes[right][None, :] - common_size)
    if i == j:
        linked = np.triu(linked, 1)
    x, y = np.nonzero(linked)
    x, y = left[x], right[y]
    links = (np.bincount(x, copies[y], len(sizes)) + np.bincount(y, copies[x], len(sizes))).astype(np.int64)
    a, b = _forest(rep[x], rep[y])
    have = np.flatnonzero(links)
    return pa.table({"rep": pa.array(np.concatenate([rep[have], a])),
                     "node": pa.array(np.concatenate([node[have], np.zeros(len(a), np.int64)])),
                     "other": pa.array(np.concatenate([other[have], np.zeros(len(a), np.int64)])),
                     "links": pa.array(np.concatenate([links[have], np.zeros(len(a), np.int64)])),
                     "to": pa.array(np.concatenate([np.zeros(len(have), np.int64), b]),
                                    mask=np.concatenate([np.ones(len(have), bool), np.zeros(len(a), bool)]))})


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       num: int = NUM, den: int = DEN, shingle: int = SHINGLE) -> DataFrame:
    """``(id, n_shingles, component_id, class_id, n_links)``, a row per row of ``docs``.

    ``class_id`` is the smallest id with the same set, ``n_links`` the number of
    other rows that the row is linked with.
    """
    if not 0 < num <= den:
        raise ValueError("the least similarity num / den is above 0 and at most 1")
    if shingle < 1:
        raise ValueError("a shingle has at least one word")
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sets, _ = written(_with_sets(d, shingle, num, den), "sets")
    classes = sets.where("n > 0 and id is not null").groupBy("node", "other", "n").agg(
        F.min("id").alias("rep"), F.count("*").alias("copies"))
    common = None
    if num * num < THIN * den * (den - num):
        total = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        common = common_shingles(d.where("id is not null"), shingle, total)
    found = candidates(d.where("id is not null"), num, den, shingle, common)
    tested = components(near_edges(found, sets, num, den))
    named = classes.join(tested, "node").withColumnRenamed("root", "cluster")
    blocks = F.ceil(F.greatest(F.count("*") / TILE, F.sum("n") / TILE_SHINGLES)).cast("int")
    size = named.groupBy("cluster").agg(blocks.alias("blocks"), F.count("*").alias("m")).where("m > 1")
    named, _ = written(named.join(size, "cluster").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int")), "classes")
    against = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                          lambda k: F.struct(F.least(k, "block").alias("i"), F.greatest(k, "block").alias("j")))
    # the same join at every size: the classes grow with the documents, so they are never broadcast
    tiles = (d.withColumnRenamed("id", "rep").join(named.hint("merge"), "rep").withColumn("pair", F.explode(against))
             .select("cluster", "pair.i", "pair.j", "block", "rep", "node", "other", "copies", "text"))
    found, _ = written(tiles.groupBy("cluster", "i", "j").applyInArrow(
        lambda t: _compare(t, num, den, shingle), "rep long, node long, other long, links long, to long"), "links")
    # an id can stand for several sets: links are those of a set, components those of ids
    links = found.where("to is null").groupBy("node", "other").agg(F.sum("links").alias("links"))
    roots = components(found.where("to is not null").select(F.col("rep").alias("a"), F.col("to").alias("b")))
    of_class = (classes.join(links, ["node", "other"], "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
                .select("node", "other", F.col("n").alias("m"), "rep", "copies", F.coalesce("links", F.lit(0)).alias("links"),
                        F.coalesce("root", "rep").alias("root")))
    s, c = sets.alias("s"), of_class.alias("c")
    full = s.join(c, (F.col("s.node") == F.col("c.node")) & (F.col("s.other") == F.col("c.other"))
                  & (F.col("s.n") == F.col("c.m")) & F.col("s.id").isNotNull(), "left")
    return full.select(
        F.col("s.id").alias(id_col), F.col("s.n").alias("n_shingles"),
        F.when(F.col("s.id").isNotNull(), F.coalesce("c.root", "s.id")).alias("component_id"),
        F.when(F.col("s.id").isNotNull(), F.coalesce("c.rep", "s.id")).alias("class_id"),
        F.coalesce(F.col("c.links") + F.col("c.copies") - 1, F.lit(0)).cast("long").alias("n_links"))

