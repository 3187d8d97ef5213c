"""Approximate nearest neighbours by largest inner product: a k-means tree.

* The tree (hierarchical k-means, ``BRANCH`` children a node) is fitted in one
  task on at most ``FIT_ROWS`` vectors, those of the smallest id hashes, and
  every vector is put into a leaf. Inner products become distances by one more
  coordinate, ``sqrt(M^2 - |x|^2)`` with the largest norm ``M``.
* A query's leaves come out of a priority queue of tree nodes, best bin first.
  The number of leaves to visit is widened on the fitted vectors until
  ``TARGET`` of the true neighbours of ``CALIBRATE`` of them are found; a query
  goes on until its leaves hold enough vectors.
* Leaves are dealt to parts of about ``BLOCK`` vectors (a leaf that holds a third
  of all vectors is many parts). A query goes once to each part that has leaves
  of it, with their list, in blocks of ``BLOCK`` queries; each part compares the
  listed leaves only and returns its best ``k`` per query.

Scores are inner products of the original vectors in double precision, summed
in the order of the components.

Result for special rows: vectors that are NULL or zero, hold NULL or non-finite
components, have no id, or are of another length than most (of ties, the
longer) take no part; of rows that repeat an id, the smallest vector counts; a
query has as many neighbours as there are candidates, if fewer than ``k``; no
queries or no candidates give an empty result. Other columns are not read, so
their names can't clash.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnlog.llm.graph import written

FIT_ROWS = 30_000
BRANCH = 8
LEAF_ROWS = 100           # fitted vectors of a leaf, at most
CALIBRATE = 300
TARGET = 0.95
BLOCK = 20_000
NEIGHBOURS = 20


class Tree:
    """Nodes with a centre each; ``children[node]`` is empty for a leaf."""

    def __init__(self, centres: np.ndarray, children: list[list[int]], norm: float) -> None:
        self.centres, self.children, self.norm = centres, children, norm
        self.leaves = [i for i, c in enumerate(children) if not c]
        self.number = {i: k for k, i in enumerate(self.leaves)}
        self.visits = 1

    def lift(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm**2 - (x * x).sum(1), 0))
        return np.hstack([x, rest[:, None]])

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector: the nearest child all the way down."""
        y, at, out = self.lift(x), np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids:
                out[rows] = self.number[node]
                continue
            c = self.centres[kids]
            near = ((c * c).sum(1)[None, :] - 2 * y[rows] @ c.T).argmin(1)
            todo += [(kids[k], rows[near == k]) for k in range(len(kids)) if (near == k).any()]
        return out

    def best_bins(self, q: np.ndarray) -> Iterator[int]:
        """Leaves from the most promising on."""
        q = np.append(q / (np.sqrt(q @ q) or 1) * self.norm, 0.0)
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not kids:
                yield self.number[node]
                continue
            diff = self.centres[kids] - q
            for d, k in zip((diff * diff).sum(1).tolist(), kids, strict=True):
                heapq.heappush(queue, (d, k))


def fit_tree(x: np.ndarray, norm: float, neighbours: int, target: float = TARGET) -> Tree:
    """Tree over the vectors, with the number of leaves that finds ``target`` of their neighbours."""
    rng = np.random.default_rng(0)
    y = Tree(np.zeros((1, x.shape[1] + 1)), [[]], norm).lift(x)
    centres, children, todo = [y.mean(0)], [[]], [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if len(rows) <= LEAF_ROWS:
            continue
        part = y[rows]
        c = part[rng.choice(len(rows), BRANCH, replace=False)]
        for _ in range(8):
            near = ((c * c).sum(1)[None, :] - 2 * part @ c.T).argmin(1)
            size = np.bincount(near, minlength=BRANCH)
            sums = np.zeros_like(c)
            np.add.at(sums, near, part)
            c = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], c)
        near = ((c * c).sum(1)[None, :] - 2 * part @ c.T).argmin(1)
        kids = [k for k in range(BRANCH) if (near == k).any()]
        if len(kids) < 2:          # equal vectors: one leaf
            continue
        for k in kids:
            children[node].append(len(centres))
            todo.append((len(centres), rows[near == k]))
            centres.append(c[k])
            children.append([])
    tree = Tree(np.array(centres), children, norm)
    # widen until enough of the true neighbours lie in the visited leaves
    chosen = rng.permutation(len(x))[:CALIBRATE]
    leaf = tree.leaf_of(x)
    rank = []
    for i in chosen:
        score = x @ x[i]
        score[i] = -np.inf
        best = np.argsort(-score, kind="stable")[:min(neighbours, len(x) - 1)]
        order = {b: k for k, b in enumerate(tree.best_bins(x[i]))}
        rank += [order[b] for b in leaf[best]]
    rank = np.sort(rank)
    while tree.visits < len(tree.leaves) and len(rank) and (rank < tree.visits).mean() < target:
        tree.visits += max(1, tree.visits // 8)
    return tree


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col("v")
    d = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where(
        F.col("id").isNotNull() & v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    size = d.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("n")).first()
    d = d.where(F.size("v") == (size["n"] if size else 0))
    return d.groupBy("id").agg(F.min("v").alias("v"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


#: Queries that are compared at once, and candidates they gather before the worse ones are dropped.
ROWS, HELD = 256, 200_000


def _best(q: np.ndarray, own: np.ndarray, visits: list[np.ndarray], v: np.ndarray, ids: np.ndarray, leaf: np.ndarray,
          k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of ``q``, id and score of each query's ``k`` best in its leaves, ties to the smaller id."""
    order = np.argsort(leaf, kind="stable")
    v, ids, leaf = v[order], ids[order], leaf[order]
    out: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(q), ROWS):
        part, mine, least = q[at:at + ROWS], own[at:at + ROWS], np.full(min(ROWS, len(q) - at), -np.inf)
        lists = visits[at:at + ROWS]
        row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        to = np.concatenate(lists)
        order = np.argsort(to, kind="stable")
        row, to = row[order], to[order]
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def drop_worse() -> None:
            """Keep what can be among the best; rounding of the rough scores is allowed for."""
            i, j, s = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((-s, i))
            i, j, s = i[order], j[order], s[order]
            kth = np.arange(len(i)) - np.searchsorted(i, i) == k - 1
            least[i[kth]] = s[kth] - 1e-9 * (1 + np.abs(s[kth]))
            good = s >= least[i]
            held[:] = [(i[good], j[good], s[good])]

        for one, a, b in zip(*_runs(to), strict=True):
            begin, end = np.searchsorted(leaf, [one, one + 1])
            r = row[a:b]
            rough = part[r] @ v[begin:end].T
            i, j = np.nonzero((rough >= least[r][:, None]) & (mine[r][:, None] != ids[begin:end]))
            held.append((r[i], begin + j, rough[i, j]))
            size += len(i)
            if size > HELD:
                drop_worse()
                size = len(held[0][0])
        drop_worse()
        i, j, _ = held[0]
        exact = np.zeros(len(i))
        for c in range(q.shape[1]):          # one order of sums, wherever a vector stands
            exact += part[i, c] * v[j, c]
        order = np.lexsort((ids[j], -exact, i))
        i, j, exact = i[order], j[order], exact[order]
        keep = np.arange(len(i)) - np.searchsorted(i, i) < k
        out.append((at + i[keep], ids[j[keep]], exact[keep]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _runs(x: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """Value, begin and end of each run of equal values."""
    cut = np.flatnonzero(np.diff(x, prepend=x[0] - 1)) if len(x) else np.zeros(0, np.int64)
    return x[cut].tolist(), cut.tolist(), [*cut[1:].tolist(), len(x)][:len(cut)]


def _deal(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First part and number of parts of each leaf: leaves share parts of about ``BLOCK`` vectors, a larger one has several."""
    first, several, part, room = [], [], 0, BLOCK
    for n in counts.tolist():
        if n > BLOCK:
            part += room < BLOCK
            first.append(part)
            several.append(-(-n // BLOCK))
            part, room = part + several[-1], BLOCK
            continue
        if n > room:
            part, room = part + 1, BLOCK
        first.append(part)
        several.append(1)
        room -= n
    return np.array(first), np.array(several)


def nearest_neighbours(vectors: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding",
                       k: int = NEIGHBOURS, fit_rows: int = FIT_ROWS, target: float = TARGET) -> DataFrame:
    """``(query_id, rank, id, score)``: for each query the ``k`` nearest found, itself left out.

    ``is_query`` maps the id column to the condition that the row is a query.
    """
    spark = vectors.sparkSession
    data, _ = written(_usable(vectors, id_col, vector_col), "vectors")
    schema = f"query_id long, rank int, `{id_col}` long, score double"
    rows = data.count()
    if not rows:
        return spark.createDataFrame([], schema)
    sample = data.where(F.pmod(F.xxhash64("id"), F.lit(rows)) < 2 * fit_rows) if rows > 2 * fit_rows else data
    sample = sample.orderBy(F.xxhash64("id"), "id").limit(fit_rows)

    norm = float(np.sqrt(data.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))).first()[0]))

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        return pa.table({"tree": pa.array([pickle.dumps(fit_tree(_matrix(table["v"]), norm, k, target))], pa.binary())})

    tree: Tree = pickle.loads(sample.groupBy(F.lit(0).alias("k")).applyInArrow(fit, "tree binary").first()["tree"])
    shared = spark.sparkContext.broadcast(tree)
    vector = data.schema["v"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = shared.value.leaf_of(_matrix(b["v"])) if len(b) else np.zeros(0, np.int64)
            yield pa.record_batch([b["id"], b["v"], pa.array(leaf, pa.int32())], names=["id", "v", "leaf"])

    indexed, path = written(data.mapInArrow(place, f"id long, v {vector}, leaf int"), "index")
    # a row per leaf comes to the driver, as many as the tree has
    sizes = {r["leaf"]: r["n"] for r in indexed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    counts = np.array([sizes.get(i, 0) for i in range(len(tree.leaves))])
    first, several = _deal(counts)
    queries = spark.read.parquet(path).where(is_query(F.col("id"))).select("id", "v")
    blocks = max(1, -(-queries.count() // BLOCK))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        for b in batches:
            for at in range(0, len(b), ROWS):
                rows, row, part, leaves = b.slice(at, ROWS), [], [], []
                for i, q in enumerate(_matrix(rows["v"])):
                    mine, held = [], 0
                    for one in t.best_bins(q):
                        mine.append(one)
                        held += counts[one]
                        if len(mine) >= t.visits and held > k:
                            break
                    mine = np.sort(np.array(mine, np.int32))
                    mine = mine[counts[mine] > 0]
                    every = several[mine]
                    to = np.repeat(first[mine], every) + np.arange(every.sum()) - np.repeat(np.cumsum(every) - every, every)
                    one = np.repeat(mine, every)
                    order = np.argsort(to, kind="stable")
                    for p, a, e in zip(*_runs(to[order]), strict=True):
                        row.append(i)
                        part.append(p)
                        leaves.append(one[order][a:e].tobytes())
                take = pa.array(row, pa.int64())
                yield pa.record_batch([rows["id"].take(take), rows["v"].take(take), pa.array(part, pa.int32()), pa.array(leaves, pa.binary())],
                                      names=["id", "v", "part", "leaves"])

    def of_leaf(values: np.ndarray) -> Column:
        return F.element_at(F.array(*[F.lit(int(x)) for x in values]), F.col("leaf") + 1)

    left = (queries.mapInArrow(visit, f"id long, v {vector}, part int, leaves binary")
            .withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")))
    right = indexed.select("id", "v", "leaf", (of_leaf(first) + F.pmod(F.xxhash64("id"), of_leaf(several))).cast("int").alias("part"),
                           F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def compare(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not len(queries) or not len(candidates):
            return pa.table({"query_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        own, visits = queries["id"].to_numpy(), [np.frombuffer(x, np.int32) for x in queries["leaves"].to_pylist()]
        row, ids, score = _best(_matrix(queries["v"]), own, visits, _matrix(candidates["v"]), candidates["id"].to_numpy(),
                                candidates["leaf"].to_numpy(), k)
        return pa.table({"query_id": pa.array(own[row]), "id": pa.array(ids), "score": pa.array(score)})

    keys = ("part", "block")
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, "query_id long, id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
