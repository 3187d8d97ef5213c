"""Quality classifier: naive Bayes support vectors.

A text's features are the hashed n-grams it has (words, pairs of words, and
runs of up to three word shapes), as indicators. They are scaled by class
log-count ratios and by the text's number of features, and a linear hinge-loss
model is fitted by dual coordinate descent.

* The counts behind the ratios cover every labelled row that may be learned
  from; each task adds them up in an array of fixed size.
* The linear model is fitted, in one task, on at most ``FIT_ROWS`` of those
  rows and ``FIT_BYTES`` of their text (by rising id hash; rows with more than
  a 64th of the bytes come after the others, the longest last, so that no long
  text keeps others out); a quarter of them
  calibrates margins to probabilities. Both bounds are parameters of the model,
  not of the data that is scored: every row is scored.

Result for special rows: NULL and empty text has no feature and gets the
model's base rate; rows that repeat an id or a text get the same score; without
rows of both labels to learn from, the score is the share of label 1 (0.5 if
there is no label); an empty table gives an empty result. Columns other than
the id and the text are not read, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnlog.llm import text as X

BITS = 18
FIT_ROWS = 8000
FIT_BYTES = 64 << 20
#: A row with more than this part of the fit's bytes comes after the others.
LONG_PART = 64
ALPHA = 1.0
COST = 1.0
EPOCHS = 12
THRESHOLD = 0.3
SLICE = 1 << 14

_PLAIN = np.zeros(256, np.uint8)
_PLAIN[list(b"abcdefghijklmnopqrstuvwxyz")] = 1
_PLAIN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 2
_PLAIN[list(b"0123456789")] = 3
_PLAIN[0x80:] = 1


def _shapes(words: X.Words, h: np.ndarray) -> np.ndarray:
    """Hash of each word's shape: its class counts (0, some, most), last byte, length, and if it repeats the one before."""
    cls = _PLAIN[words.data]
    size = np.maximum(words.end - words.start, 1)
    shape = np.zeros(len(h), np.uint64)
    for k in range(4):
        sums = np.concatenate([[0], np.cumsum(cls == k)])
        share = (sums[words.end] - sums[words.start]) / size
        shape = shape * np.uint64(4) + np.digitize(share, [1e-9, 0.3, 0.7]).astype(np.uint64)
    last = words.data[words.end - 1].astype(np.uint64)
    shape = shape * np.uint64(256) + np.where(_PLAIN[words.data[words.end - 1]] == 0, last, 0).astype(np.uint64)
    shape = shape * np.uint64(8) + np.digitize(size, [2, 4, 8, 16, 32, 64]).astype(np.uint64)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (words.doc[1:] == words.doc[:-1])
    return X.mix64(shape * np.uint64(2) + same.astype(np.uint64), 31)


def features(texts: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of each text, distinct and sorted, one text after the other; their bounds."""
    nums, sizes = [np.zeros(0, np.int64)], []
    for a, b in X.slices(texts):
        words = X.words_of(texts[a:b])
        h = X.lowered(words).hashes()
        shape = _shapes(words, h)
        docs, keys = [], []
        for n, of, salt in ((1, h, 1), (2, h, 2), (1, shape, 3), (2, shape, 4), (3, shape, 5)):
            at = X.gram_starts(words, n)
            if len(at):
                docs.append(words.doc[at])
                keys.append((X.grams(of, n, salt)[at] >> np.uint64(64 - bits)).astype(np.int64))
        both = np.unique(np.concatenate(docs) << bits | np.concatenate(keys)) if docs else np.zeros(0, np.int64)
        nums.append(both & ((1 << bits) - 1))
        sizes.append(np.bincount(both >> bits, minlength=b - a))
    return np.concatenate(nums), np.concatenate([[0], *sizes]).cumsum().astype(np.int64)


def log_count_ratios(labelled: DataFrame, bits: int = BITS) -> np.ndarray:
    """Per feature: log of the share of label 1's documents' features over label 0's."""
    width = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, width), np.int64)
        for batch in batches:
            num, bounds = features(X.as_bytes(batch["text"]), bits)
            label = np.repeat(batch["label"].to_numpy(zero_copy_only=False), np.diff(bounds))
            for k in (0, 1):
                total[k] += np.bincount(num[label == k], minlength=width)
        step = min(SLICE, width)
        parts = [(s, total[:, s * step:(s + 1) * step]) for s in range(width // step)]
        parts = [(s, p) for s, p in parts if p.any()]
        yield pa.record_batch({"slice": pa.array([s for s, _ in parts], pa.int32()),
                               "counts": pa.array([p.tobytes() for _, p in parts], pa.binary())})

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in rows["counts"].to_pylist())
        return pa.table({"slice": rows["slice"][:1], "counts": pa.array([total.tobytes()], pa.binary())})

    sums = labelled.select("text", "label").mapInArrow(count, "slice int, counts binary").groupBy("slice").applyInArrow(
        add, "slice int, counts binary").collect()
    counts = np.zeros((2, width))
    step = min(SLICE, width)
    for r in sums:
        counts[:, r["slice"] * step:(r["slice"] + 1) * step] = np.frombuffer(r["counts"], np.int64).reshape(2, step)
    share = (counts + ALPHA) / (counts.sum(1, keepdims=True) + ALPHA * width)
    return np.log(share[1] / share[0])


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, width: int,
                 cost: float = COST, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last is the bias) of the hinge-loss model, by dual coordinate descent.

    Labels are weighted so that both classes cost the same in all.
    """
    w, a = np.zeros(width + 1), np.zeros(len(y))
    limit = np.where(y > 0, cost * len(y) / (2 * max(1, (y > 0).sum())), cost * len(y) / (2 * max(1, (y < 0).sum())))
    norm = np.array([v @ v + 1.0 for v in values])
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(y)):
            r, v = rows[i], values[i]
            gradient = y[i] * (w[r] @ v + w[width]) - 1
            new = min(max(a[i] - gradient / norm[i], 0.0), limit[i])
            if new != a[i]:
                step = (new - a[i]) * y[i]
                w[r] += step * v
                w[width] += step
                most = max(most, abs(new - a[i]))
                a[i] = new
        if most < 1e-3:
            break
    return w


def _calibration(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through margins and labels (Newton steps, smoothed targets)."""
    up, down = label.sum(), len(label) - label.sum()
    t = np.where(label == 1, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - t) * margin).sum() + 1e-3 * a, (p - t).sum()])
        q = p * (1 - p)
        m = np.array([[(q * margin * margin).sum() + 1e-3, (q * margin).sum()], [(q * margin).sum(), q.sum() + 1e-9]])
        step = np.linalg.solve(m, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def _fit(sample: DataFrame, ratios: np.ndarray, bits: int) -> tuple[np.ndarray, float, float] | None:
    """Weights times ratios and the bias, slope, offset; fitted in one task on a sample of bounded size."""
    scale = ratios.astype(np.float32)

    def fit(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("id", "ascending"), ("text", "ascending")])
        num, bounds = features(X.as_bytes(rows["text"]), bits)
        label = rows["label"].to_numpy()
        each = [num[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        value = [scale[r] / np.sqrt(max(len(r), 1)) for r in each]
        aside = np.arange(len(label)) % 4 == 3
        if len(set(label[aside])) < 2 or len(set(label[~aside])) < 2:
            aside[:] = False
        train = np.flatnonzero(~aside)
        w = dual_descent([each[i] for i in train], [value[i] for i in train], np.where(label[train] == 1, 1, -1), 1 << bits)
        check = np.flatnonzero(aside) if aside.any() else train
        margin = np.array([w[each[i]] @ value[i] + w[-1] for i in check])
        slope, offset = _calibration(margin, label[check])
        model = np.append((w[:-1] * scale), [w[-1], slope, offset]).astype(np.float64)
        return pa.table({"model": pa.array([model.tobytes()], pa.binary())})

    got = sample.groupBy(F.lit(0).alias("k")).applyInArrow(fit, "model binary").collect()
    return np.frombuffer(got[0]["model"], np.float64) if got else None


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                   learn_from=None, fit_rows: int = FIT_ROWS, fit_bytes: int = FIT_BYTES, bits: int = BITS) -> DataFrame:
    """``(id, score)``, a row per row of ``docs``: the probability of label 1.

    ``learn_from`` maps an id column to the condition that a labelled row may be
    learned from. Labels other than 0 and 1 are not used; of several labels of
    an id, the largest.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1) and id is not null")
    if learn_from is not None:
        known = known.where(learn_from(F.col("id")))
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    tally = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(tally.values())
    if len(tally) < 2:
        base = tally.get(1, 0) / total if total else 0.5
        return d.select(F.col("id").alias(id_col), F.lit(base).alias("score"))
    # the same join at every size: labels grow with the documents, so they are never broadcast
    ratios = log_count_ratios(d.join(known.hint("merge"), "id"), bits)
    # the rows of the smallest hashes: about fit_rows, at most that many
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(total)) < 2 * fit_rows) if total > 2 * fit_rows else known
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(fit_rows)
    # no more of them than fit_bytes of text hold; the window is over fit_rows numbers
    size = d.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.sum(F.octet_length("text")).alias("bytes"))
    last = F.greatest("bytes", F.lit(fit_bytes // LONG_PART))
    so_far = F.sum("bytes").over(Window.orderBy(last, F.xxhash64("id"), "id"))
    # a label whose texts are all above that has its shortest one
    nth = F.row_number().over(Window.partitionBy("label").orderBy("bytes", F.xxhash64("id"), "id"))
    chosen = size.withColumns({"so_far": so_far, "nth": nth}).where((F.coalesce("so_far", F.lit(0)) <= fit_bytes) | (F.col("nth") == 1)).select("id", "label")
    sample = d.join(F.broadcast(chosen), "id")
    model = _fit(sample, ratios, bits)
    if model is None:
        return d.select(F.col("id").alias(id_col), F.lit(tally[1] / total).alias("score"))
    weights, (bias, slope, offset) = model[:-3].astype(np.float32), model[-3:]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = X.as_bytes(batch["text"])
            for a, b in X.slices(texts):
                num, bounds = features(texts[a:b], bits)
                sums = np.concatenate([[0.0], np.cumsum(weights[num], dtype=np.float64)])
                margin = (sums[bounds[1:]] - sums[bounds[:-1]]) / np.sqrt(np.maximum(np.diff(bounds), 1)) + bias
                p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
                yield pa.record_batch([batch["id"][a:b], pa.array(p)], names=[id_col, "score"])

    return d.mapInArrow(score, _schema(docs, id_col))


def _schema(docs: DataFrame, id_col: str) -> T.StructType:
    return T.StructType([docs.schema[id_col], T.StructField("score", T.DoubleType())])
