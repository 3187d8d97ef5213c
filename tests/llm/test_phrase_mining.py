"""Phrase collocations against plain counts of every run of words."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from learnlog.llm import phrase_mining as P

_AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces_of(text):
    pieces = re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(_AZ))
    return [re.findall("[^\x20\x09]+", p) for p in pieces]


def collocations(rows, least, top, longest=3):
    f, n = defaultdict(Counter), Counter()
    for text, lang in ((t, "und" if x is None else x) for t, x in rows):
        for words in pieces_of(text):
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        holders = defaultdict(int)
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    holders[p[i:i + k]] = max(holders[p[i:i + k]], a)
        scored = []
        for p, a in candidates.items():
            if 100 * holders[p] >= 50 * a:
                continue
            score, _, left, right = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def mined(df, **kwargs):
    return sorted(tuple(r) for r in P.phrase_collocations(df, **kwargs).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def texts(seed=2, n=250):
    """Few words, so that runs repeat; copies, shared passages, marks and blanks of all kinds."""
    rng = random.Random(seed)
    vocabulary = ["the", "of", "a", "Éa", "中文", "x1", "(b)", "\x1c", "é\x85", "to", "The", "UP", "ß"]
    blanks = [" "] * 8 + ["  ", "\t", " \t ", "\n", ". ", ", ", "?!", "\r\n", "\x0b", ";", ":", ".."]
    out = []
    for _ in range(n):
        out.append("".join(rng.choice(vocabulary) + rng.choice(blanks) for _ in range(rng.randrange(0, 90))))
    out += [out[3]] * 40 + [out[5] + " " + out[7]] * 5 + ["a " * 500, "same same same", "", " \t", None, "of", "."]
    return [(t, rng.choice(["en", "de", None, ""])) for t in out]


def test_against_brute_force(spark, monkeypatch):
    rows = texts()
    df = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    assert mined(df, least=3, top=60) == collocations(rows, 3, 60)
    assert mined(df, least=1, top=10**6) == collocations(rows, 1, 10**6)
    # chunks, blocks and buckets of any size give the same
    monkeypatch.setattr(P, "TRIGGER", 3)
    monkeypatch.setattr(P, "BLOCK_BYTES", 500)
    monkeypatch.setattr(P, "BUCKET_BYTES", 700)
    monkeypatch.setattr(P, "CHUNK_WORDS", 4)
    assert mined(df, least=3, top=60) == collocations(rows, 3, 60)
    monkeypatch.setattr(P, "TRIGGER", 10**9)
    monkeypatch.setattr(P, "CHUNK_WORDS", 1)
    assert mined(df, least=3, top=60) == collocations(rows, 3, 60)


@pytest.mark.parametrize("longest", [2, 4])
def test_other_lengths(spark, longest):
    rows = texts(4, 120)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    assert mined(df, least=4, top=50, longest=longest) == collocations(rows, 4, 50, longest)


def test_products_beyond_64_bits(spark):
    """Counts in the thousands of millions: the score's terms have 70 bits and more."""
    text = "x y. " * 200
    df = spark.createDataFrame([(text, "en")], "text string, lang string")
    big = 3_000_000_017
    chunks = P.dictionary(df)
    counted = chunks.selectExpr("lang", "chunk", f"f * {big} f")

    def scaled(docs, longest=3):
        return counted

    old, P.dictionary = P.dictionary, scaled
    try:
        got = mined(df)
    finally:
        P.dictionary = old
    assert got == [("en", 1, "x y", 200 * big, 200 * big, 200 * big, 400 * big, 1_000_000)]


def test_each_phrase_starts_in_one_chunk():
    """Phrases of the chunks' own words are the text's, whatever triggers; equal passages give equal chunks."""
    rows = [t or "" for t, _ in texts(6, 80)]
    for longest in (2, 3, 4):
        chunks, of = P.parse([t.encode() for t in rows], longest)
        phrases, n, _ = P.count_phrases([c.encode() for c in chunks.to_pylist()], np.ones(len(chunks), np.int64), longest)
        want = Counter()
        for t in rows:
            for words in pieces_of(t):
                for k in range(1, longest + 1):
                    want.update(" ".join(words[i:i + k]) for i in range(len(words) - k + 1))
        assert dict(zip(phrases.to_pylist(), n.tolist())) == want
    rng = random.Random(1)
    passage, others = (" ".join(f"w{rng.randrange(50)}" for _ in range(k)) for k in (400, 300))
    a, of = P.parse([passage.encode(), (others + " " + passage).encode()])
    first, second = ({c for c, k in zip(a.to_pylist(), of.tolist()) if k == d} for d in (0, 1))
    assert len(first & second) >= 0.8 * len(first)


def test_special_rows(spark, edge_frame, edge_docs, no_docs):
    assert mined(edge_frame, least=2, top=500) == collocations([(r[1], r[2]) for r in edge_docs], 2, 500)
    assert P.phrase_collocations(no_docs).collect() == []
    assert P.phrase_collocations(spark.createDataFrame([(None, None), ("", None)], "text string, lang string")).collect() == []
