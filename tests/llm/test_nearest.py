"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from learnlog.llm import nearest as N
from learnlog.llm.queries import QUERIES


def exact(rows, is_query, k=20):
    ids, v = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    out = {}
    for i, q in zip(ids, v):
        if is_query(i):
            s = (v * q).sum(1)
            s[ids == i] = -np.inf
            order = np.lexsort((ids, -s))[:min(k, len(ids) - 1)]
            out[i] = [(int(ids[j]), s[j]) for j in order]
    return out


def recall(got, want):
    hits = total = 0
    for q, best in want.items():
        found = sorted(got.get(q, []))
        assert [r for r, _, _ in found] == list(range(1, len(best) + 1))
        assert all(a[2] >= b[2] for a, b in zip(found, found[1:]))
        assert all(a[1] < b[1] for a, b in zip(found, found[1:]) if a[2] == b[2])
        hits += len({i for _, i, _ in found} & {i for i, _ in best})
        total += len(best)
    return hits / max(total, 1)


def by_query(rows, id_col="vec_id"):
    out = {}
    for r in rows:
        out.setdefault(r["query_id"], []).append((r["rank"], r[id_col], r["score"]))
    return out


def test_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = by_query(QUERIES["op6_nearest_neighbours"](spark, sf).collect())
    want = exact(rows, lambda i: i % 20 == 0)
    assert set(got) == set(want)
    assert recall(got, want) >= 0.9
    vectors = {i: np.array(v, np.float64) for i, v in rows}
    for q, found in got.items():
        assert all(abs(s - vectors[q] @ vectors[i]) < 1e-12 for _, i, s in found)


def test_special_rows(spark, monkeypatch):
    rng = np.random.default_rng(0)
    good = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(0, 400, 2)] + [(1000 + i, [1.0] * 8) for i in range(300)]
    bad = [(1, None), (3, [0.0] * 8), (5, [1.0, None] + [0.0] * 6), (7, [float("nan")] + [0.0] * 7), (9, [float("inf")] + [0.0] * 7),
           (None, [1.0] * 8), (11, [1.0, 2.0]), (13, []), (0, [9.0] * 8)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in good + bad], "vec_id long, embedding array<double>, id string, leaf int").repartition(4)
    monkeypatch.setattr(N, "BLOCK", 50)
    got = by_query(N.nearest_neighbours(df, lambda i: i % 20 == 0).collect())
    want = exact(good, lambda i: i % 20 == 0)
    assert set(got) == set(want)
    assert recall(got, want) >= 0.9
    few = df.where("vec_id in (20, 40, 60)")
    got = by_query(N.nearest_neighbours(few, lambda i: i % 20 == 0).collect())
    assert {q: [i for _, i, _ in sorted(r)] for q, r in got.items()} == {
        q: [i for i, _ in r] for q, r in exact([g for g in good if g[0] in (20, 40, 60)], lambda i: True).items()}


@pytest.mark.parametrize("condition", ["false", "vec_id = 0"])
def test_too_few(spark, condition):
    df = spark.createDataFrame([(0, [1.0, 2.0])], "vec_id long, embedding array<float>").where(condition)
    assert N.nearest_neighbours(df, lambda i: i % 20 == 0).collect() == []
