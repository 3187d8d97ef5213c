"""Spelling variants against every pair of words compared."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from learnlog.llm import spelling as S

_AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1:] == b for k in range(len(a)))


def counted(rows, letters=5, misspell=97):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(_AZ)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if misspell and h % misspell == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += len(run) >= letters
    return +n


def variants(rows, least=3, misspell=97):
    n = {w: k for w, k in counted(rows, misspell=misspell).items() if k >= least}
    out, form = {}, {}
    for w, k in n.items():
        others = [v for v in n if near(w, v)]
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if others and n[best] >= 2 * k else None
        out[w] = (form[w], k, len(others), n[form[w]] if form[w] else None)
    rows = []
    for w, (f, k, m, fn) in out.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, f, root, k, m, fn))
    return sorted(rows, key=str)


def grouped(df, **kwargs):
    return sorted((tuple(r) for r in S.spelling_variants(df, **kwargs).select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def misspelled(seed=1, n=120):
    """Words in steps of one letter, with falling counts; accents, repeated letters, halves in common, anagrams."""
    rng = random.Random(seed)
    base = ["separate", "colour", "naïveté", "aaaaaaaa", "ababab", "ÿßçÀÖ", "mississippi", "abcdefghij", "noon×noon", "receive"]
    words = []
    for w in base:
        chain, k = w, 60
        while k >= 2:
            words += [chain] * k
            at = rng.randrange(len(chain) + 1)
            chain = rng.choice([chain[:at] + rng.choice("abné") + chain[at:], chain[:at] + chain[at + 1:], chain[:at] + rng.choice("xyÿ") + chain[at + 1:]])
            k //= rng.choice([1, 2, 2, 3])
            k -= 1
        words += ["".join(rng.sample(w, len(w))) for _ in range(5) for _ in range(3)]
    rng.shuffle(words)
    rows = [(i, rng.choice([" ", ", ", "1", "\n", "-", "ā"]).join(words[i::n])) for i in range(n)]
    return rows + [(None, words[0]), (None, None), (5, "UP " * 9 + "Upper " * 9 + "upper  uppers " * 3), (6, "")]


@pytest.mark.parametrize("misspell", [97, 2, 0])
def test_against_brute_force(spark, misspell):
    rows = misspelled()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = grouped(df, misspell=misspell)
    assert got == variants(rows, misspell=misspell)
    assert any(r[1] and r[2] != r[1] for r in got)      # a chain of forms


def test_counts_whatever_the_batches(spark, monkeypatch):
    monkeypatch.setattr(S, "FLUSH", 7)
    monkeypatch.setattr(S, "SHORT", 6)
    rows = misspelled(3)
    df = spark.createDataFrame(rows, "id long, text string").repartition(3)
    assert {r["word"]: r["n"] for r in S.word_counts(df, 5, 97).collect()} == counted(rows)


def test_near_words_share_a_signature():
    rng = random.Random(8)
    words = set()
    for _ in range(400):
        w = "".join(rng.choice("abcé") for _ in range(rng.randrange(5, 12)))
        at = rng.randrange(len(w))
        words |= {w, w[:at] + w[at + 1:], w[:at] + rng.choice("abcéz") + w[at + 1:], w[:at] + "b" + w[at:]}
    words = sorted(w for w in words if len(w) > 4)
    for parts, ends in ((4, 3), (3, 2), (6, 4)):
        found = [set(row.tolist()) for row in S.signatures(words, parts, ends)]
        for i, a in enumerate(words):
            for j in range(i):
                if near(a, words[j]):
                    assert found[i] & found[j], (a, words[j])


def test_crc32_side_by_side():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    start = rng.integers(0, 4500, 300)
    size = rng.integers(0, 300, 300)
    before = rng.integers(0, 2**32, 300, dtype=np.uint32)
    want = [zlib.crc32(data[a:a + n].tobytes(), int(b)) for a, n, b in zip(start, size, before)]
    assert S.crc32(data, start, size, before).tolist() == want
    assert S.crc32(data, start[:0], size[:0], before[:0]).tolist() == []


def test_special_rows(spark, edge_frame, edge_docs, no_docs):
    assert grouped(edge_frame, misspell=97) == variants([(r[0], r[1]) for r in edge_docs])
    assert S.spelling_variants(no_docs).collect() == []
    assert S.spelling_variants(spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")).collect() == []


def test_distance_in_the_join_and_beside_it(spark, monkeypatch):
    rows = misspelled(5)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(S, "LONG", 8)
    assert grouped(df, misspell=97) == variants(rows)


def test_long_runs(spark):
    """A run of half a million letters, three times, and one letter more."""
    text = "ab" * 250_000
    df = spark.createDataFrame([(k, text + "c" * (k == 9)) for k in (1, 2, 3, 9, 9, 9, 9, 9, 9)], "doc_id long, text string")
    got = S.spelling_variants(df).collect()
    assert sorted((len(r["word"]), len(r["form"] or ""), r["n"], r["n_near"]) for r in got) == [(500_000, 500_001, 3, 1), (500_001, 0, 6, 1)]
