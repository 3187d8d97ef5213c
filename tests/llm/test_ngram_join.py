"""N-gram Jaccard join against all pairs; sketches and components by themselves."""

import random

import numpy as np
import pytest

from learnlog.llm import ngram_join as J
from learnlog.llm.graph import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = (text or "").translate(LOWER).encode().split()
    return frozenset(tuple(w[k:k + 3]) for k in range(len(w) - 2)) if len(w) >= 3 else frozenset([tuple(w)] if w else [])


def all_pairs(rows, num=90, den=100):
    """(id, size, component, links) of each row, rows of an id as one node."""
    sets = [(r[0], shingles(r[1])) for r in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(sets)
    for x in range(len(sets)):
        for y in range(x):
            (i, a), (j, b) = sets[x], sets[y]
            if a and b and i is not None and j is not None:
                both = len(a & b)
                if den * both >= num * (len(a) + len(b) - both):
                    links[x] += 1
                    links[y] += 1
                    p, q = find(i), find(j)
                    root[max(p, q)] = min(p, q)
    return sorted((i if i is not None else -1, len(s), find(i) if i is not None else None, n) for (i, s), n in zip(sets, links))


@pytest.mark.parametrize("tile", [1024, 4])
def test_join(edge_frame, edge_docs, monkeypatch, tile):
    monkeypatch.setattr(J, "TILE", tile)
    monkeypatch.setattr(J, "SKETCHES", tile)
    got = J.ngram_jaccard_join(edge_frame).collect()
    assert sorted((r[0] if r[0] is not None else -1, r["n_shingles"], r["component_id"], r["n_links"]) for r in got) == all_pairs(edge_docs)


def test_chain_and_large_group(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    rows, text = [], list(base)
    for i in range(40):                      # a chain: neighbours link, the ends don't
        rows.append((1000 - i, " ".join(text)))
        text[i * 9] = f"new{i}"
    for i in range(60):                      # a group of near copies
        near = [f"g{k}" for k in range(300)]
        near[rng.randrange(300)] = f"edit{i}"
        rows.append((i, " ".join(near)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in J.ngram_jaccard_join(df).collect())
    assert got == all_pairs(rows)


def test_empty_table(no_docs):
    assert J.ngram_jaccard_join(no_docs).collect() == []


@pytest.mark.parametrize("num,den", [(90, 100), (80, 100), (1, 2)])
def test_linked_sets_share_a_block(num, den):
    """The pigeonhole bound: any two sets at the threshold agree on a block of a common band."""
    rng = np.random.default_rng(5)
    for _ in range(150):
        n = int(rng.integers(1, 400))
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        b = a[rng.permutation(n)[: n - int(rng.integers(0, n // 4 + 1))]]
        b = np.concatenate([b, rng.integers(0, 2**63, int(rng.integers(0, n // 6 + 1))).astype(np.uint64)])
        x, y = set(a.tolist()), set(b.tolist())
        if not y or den * len(x & y) < num * len(x | y):
            continue
        sets = [np.array(sorted(s), np.uint64) for s in (x, y)]
        key, of = J.sketch_blocks(np.concatenate(sets), np.array([0, len(sets[0]), len(sets[0]) + len(sets[1])]), num, den)
        assert set(key[of == 0].tolist()) & set(key[of == 1].tolist())


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5), (None, 3)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}


def shingles_of(text, n):
    w = (text or "").translate(LOWER).encode().split()
    return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def linked_pairs(rows, n, num, den):
    """Components and numbers of links over sets of ``n`` words, by brute force; ids are distinct."""
    sets = [(i, shingles_of(t, n)) for i, t in rows]
    root, links = {i: i for i, _ in sets}, {i: 0 for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and den * len(a & b) >= num * len(a | b):
                links[i] += 1
                links[j] += 1
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return sorted((i, len(s), find(i), links[i]) for i, s in sets)


@pytest.mark.parametrize("often", [0, 3, 10**9])
def test_five_words_at_four_fifths(spark, edge_docs, monkeypatch, often):
    """Copies with scattered edits, a common passage, and the special rows; whichever shingles count as common."""
    monkeypatch.setattr(J, "COMMON", often)
    rng = random.Random(11)
    passage = [f"p{k}" for k in range(60)]
    rows = [(10_000 + k, r[1]) for k, r in enumerate(edge_docs)]
    for i in range(30):
        words = [f"d{i}w{rng.randrange(10**6)}" for _ in range(rng.randrange(60, 200))] + passage * (i % 3 > 0)
        rows.append((100 * i, " ".join(words)))
        for k in range(1, 8):                # up to one edit in 20 words, or a part added
            near = words + [f"x{i}y{j}" for j in range(len(words) // 6 if k == 7 else 0)]
            for at in rng.sample(range(len(words)), k * len(words) // 160 if k < 7 else 0):
                near[at] = f"e{rng.randrange(10**6)}"
            rows.append((100 * i + k, " ".join(near)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = J.ngram_jaccard_join(df, num=80, den=100, shingle=5).collect()
    want = linked_pairs(rows, 5, 80, 100)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in got) == want
    assert [r[2] for r in want] != [r[2] for r in linked_pairs(rows, 3, 90, 100)]


def test_linked_sets_share_a_block_without_common_shingles():
    """The pigeonhole bound with shingles left out and empty blocks not sent."""
    rng = np.random.default_rng(6)
    linked = 0
    for k in range(400):
        n = int(rng.integers(1, 400))
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        b = a[rng.permutation(n)[: n - int(rng.integers(0, n // 5 + 1))]]
        b = np.concatenate([b, rng.integers(0, 2**63, int(rng.integers(0, n // 8 + 1))).astype(np.uint64)])
        x, y = set(a.tolist()), set(b.tolist())
        if not y or 100 * len(x & y) < 80 * len(x | y):
            continue
        linked += 1
        common = np.sort(rng.permutation(np.concatenate([a, b]))[: int(rng.random() * (k % 4) / 3 * 2 * n)])
        sets = [np.array(sorted(s), np.uint64) for s in (x, y)]
        key, of = J.sketch_blocks(np.concatenate(sets), np.array([0, len(sets[0]), len(sets[0]) + len(sets[1])]), 80, 100, common)
        assert set(key[of == 0].tolist()) & set(key[of == 1].tolist())
    assert linked > 100


def test_unlike_sets_are_no_candidates_at_four_fifths():
    """Sets with a passage in common, but little else, share no block: their cluster would be all documents."""
    rng = np.random.default_rng(7)
    passage = rng.integers(0, 2**63, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate([passage, rng.integers(0, 2**63, 300).astype(np.uint64)])) for _ in range(300)]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    key, of = J.sketch_blocks(np.concatenate(sets), bounds, 80, 100, np.sort(passage))
    assert len(J._forest(*J._leaders(key, of))[0]) < 30


@pytest.mark.parametrize("num,den", [(90, 100), (80, 100), (1, 2)])
def test_no_linked_pair_is_dropped_by_its_sketches(num, den):
    """The Hamming distance in a common band is at most what linked sets can differ by."""
    rng = np.random.default_rng(9)
    tested = 0
    for _ in range(300):
        n = int(rng.integers(1, 600))
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        b = a[rng.permutation(n)[: n - int(rng.integers(0, n // 4 + 1))]]
        b = np.concatenate([b, rng.integers(0, 2**63, int(rng.integers(0, n // 6 + 1))).astype(np.uint64)])
        x, y = sorted((np.unique(a), np.unique(b)), key=len)
        both = len(np.intersect1d(x, y))
        if not len(x) or den * both < num * (len(x) + len(y) - both):
            continue
        band, (own, below) = J.parity_sketches(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]), num, den)
        assert band[1] - band[0] in (0, 1)
        p, q = own[0], own[1] if band[0] == band[1] else below[1]
        distance = int(np.bitwise_count(np.frombuffer(p, np.uint8) ^ np.frombuffer(q, np.uint8)).sum())
        assert distance <= len(x) + len(y) - 2 * both <= (len(x) + len(y)) * (den - num) // (den + num)
        tested += 1
    assert tested > 50


def test_a_shared_passage_leaves_before_texts_are_compared(spark, monkeypatch):
    """Sets that agree on blocks of a passage are one cluster; their sketches tell them apart, and near copies stay."""
    monkeypatch.setattr(J, "SKETCHES", 16)
    rng = random.Random(4)
    passage = [f"p{k}" for k in range(120)]
    rows = []
    for i in range(60):
        words = passage + [f"w{rng.randrange(10**7)}" for _ in range(180)]
        rows.append((2 * i, " ".join(words)))
        words[150 + i] = "edit"
        rows.append((2 * i + 1, " ".join(words)))
    seen = []

    near = J.near_edges
    monkeypatch.setattr(J, "near_edges", lambda found, *a: seen.append((found, near(found, *a))) or seen[0][1])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = J.ngram_jaccard_join(df, num=80, den=100, shingle=5)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in got.collect()) == linked_pairs(rows, 5, 80, 100)
    found, edges = seen[0]
    assert components(found.selectExpr("node a", "leader b")).groupBy("root").count().agg({"count": "max"}).first()[0] > 20
    assert components(edges).groupBy("root").count().agg({"count": "max"}).first()[0] == 2


def test_sets_of_a_block_have_a_leader_in_common():
    rng = np.random.default_rng(3)
    key, node = rng.integers(0, 40, 300).astype(np.uint64), rng.integers(-50, 50, 300)
    pairs = set(zip(*(x.tolist() for x in J._leaders(key, node))))
    for k in np.unique(key):
        own = set(node[key == k].tolist())
        assert {(n, min(own)) for n in own if n != min(own)} <= pairs
    assert len(pairs) <= 300 and all(n > low for n, low in pairs)


def test_linked_rows_of_one_id(spark):
    """Two texts of an id that are linked with each other only."""
    words = [f"w{k}" for k in range(300)]
    rows = [(7, " ".join(words)), (7, " ".join(words[:-1] + ["x"])), (8, "something else altogether here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in J.ngram_jaccard_join(df).collect())
    assert got == all_pairs(rows) == [(7, 298, 7, 1), (7, 298, 7, 1), (8, 2, 8, 0)]
