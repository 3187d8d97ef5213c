"""License scan against statistics and chains computed word by word."""

import random
import re

import pytest

from learnlog.llm import license_scan as L
from learnlog.llm.license_templates import BASE_PHRASES, TEMPLATES
from learnlog.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
_AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NAMED = [(label, re.findall("[a-z0-9\x80-\U0010ffff]+", t.translate(_AZ))) for label, ts in TEMPLATES.items() for t in ts]


def words_of(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_AZ))


def matches_of(words, template):
    """(start, end, to) of the longest matches that end at a word and can't go on, by a table of common runs."""
    places = {}
    for j, w in enumerate(template):
        places.setdefault(w, []).append(j)
    before, rows = {}, []
    for w in words:
        before = {j: before.get(j - 1, 0) + 1 for j in places.get(w, ())}
        rows.append(before)
    own = [max(r.values(), default=0) for r in rows] + [0]
    return [(i + 1 - own[i], i + 1, j + 1) for i in range(len(words)) for j, n in sorted(rows[i].items())
            if n == own[i] >= min(L.MIN_MATCH, len(template)) and own[i + 1] <= own[i]]


def best_chains(matches):
    """Every earlier match tried as the one before; disjoint chains, best first."""
    covered, first = [], []
    for k, (s, e, to) in enumerate(matches):
        best, since = e - s, s
        for q, (_, f, before) in enumerate(matches[:k]):
            gain = min(e - s, to - before, e - f)
            if f + L.GAP >= s and gain > 0 and covered[q] + gain > best:
                best, since = covered[q] + gain, first[q]
        covered.append(best)
        first.append(since)
    out = []
    for c, s, e in sorted(zip(covered, first, (m[1] for m in matches)), key=lambda x: (-x[0], x[2], -x[1])):
        if all(e <= a or b <= s for _, a, b in out):
            out.append((c, s, e))
    return out


def scanned(text):
    words = words_of(text)
    places = sorted((i, label) for label, phrases in BASE_PHRASES.items() for p in phrases
                    for i in range(len(words)) if words[i:i + len(p.split())] == p.split())
    base = {label for _, label in places}
    shares = [(c / len(t), c, label, s, e) for label, t in NAMED if len(set(words) & set(t)) > 1 for c, s, e in best_chains(matches_of(words, t))]
    spans = []
    for share, _, label, s, e in sorted(shares, key=lambda x: (-x[0], -x[1], *x[2:])):
        if share >= L.COVER and all(e <= x[0] or x[1] <= s for x in spans):
            spans.append((s, e, label, share))
    spans.sort()
    return (len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted(base)),
            ",".join(sorted(base | {x[2] for x in spans})), 1.0 if places else max((x[0] for x in shares), default=0.0), spans)


def result(r):
    return (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"],
            [(s["start"], s["end"], s["label"], s["share"]) for s in r["spans"]])


def licence_texts():
    """Templates whole, cut, with words changed, left out and put in, side by side, and mixed with their own words."""
    rng = random.Random(3)
    pool = [w for _, t in NAMED for w in t]
    out = ["MIT License", "mit-LICENSE mit license MIT Licenses", "general public, license. GENERAL public  license", "apache\u00a0license", "Apache, License!",
           "mit " * 50, "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-SA 4.0", "licensed under cc by", "SPDX-License-Identifier: BSD-3-Clause"]
    for texts in TEMPLATES.values():
        for t in texts:
            words = t.split()
            out += [t, t.upper() + "\n" + t, " ".join(words[len(words) // 4:]), " ".join(words[: len(words) // 2])]
            for rate in (0.03, 0.1):
                out.append(" ".join(rng.choice([w + "x", "", w + " extra words"]) if rng.random() < rate else w for w in words))
    out += [" ".join(rng.choice(pool) for _ in range(200)) for _ in range(30)]
    out += [" ".join(rng.choice(out[10:40]) for _ in range(6)) for _ in range(5)]
    return out


def test_against_brute_force(spark):
    texts = licence_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: result(r) for r in L.license_scan(df).collect()}
    for k, t in enumerate(texts):
        assert got[k] == scanned(t), t
    assert {label for r in got.values() for label in r[5].split(",")} >= set(TEMPLATES)
    for label, group in TEMPLATES.items():
        assert all(label in scanned(t)[5].split(",") for t in group)


def test_notices():
    def labels(text):
        return scanned(text)[5]

    assert labels("Licensed under CC BY-NC 4.0.") == "cc-by-nc" and labels("licensed under cc by and more") == ""
    assert labels(TEMPLATES["mit"][0]) == "mit" and labels(TEMPLATES["gpl"][0]) == "gpl"
    assert labels(TEMPLATES["lgpl"][0]) == "gpl,lgpl"      # by its phrase, a base one


def test_automaton_against_every_run():
    rng = random.Random(5)
    for _ in range(60):
        sequences = [[rng.randrange(3) for _ in range(rng.randrange(1, 12))] for _ in range(rng.randrange(1, 5))]
        automaton = L.SuffixAutomaton(sequences)
        holder = automaton.holders(len(sequences))
        items = [rng.randrange(3) for _ in range(30)]

        def common(i, s):
            return max(n for n in range(i + 2) if n == 0 or any(s[a:a + n] == items[i + 1 - n:i + 1] for a in range(len(s))))

        states, lengths = automaton.stream(items)
        for i, (state, length) in enumerate(zip(states, lengths)):
            own = [common(i, s) for s in sequences]
            assert length == max(own)
            assert [min(length, automaton.length[holder[state, k]]) for k in range(len(sequences))] == own
            for k, s in enumerate(sequences):
                if own[k]:
                    ends = {n for j, n in automaton.ends[holder[state, k]] if j == k}
                    assert ends == {a + own[k] for a in range(len(s)) if s[a:a + own[k]] == items[i + 1 - own[k]:i + 1]}


def test_query_on_the_whole_table(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op13_license_scan"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert tuple(r)[1:] == scanned(docs[r["doc_id"]])[:7], r["doc_id"]


def test_special_rows(edge_frame, edge_docs, no_docs):
    got = sorted(map(repr, ((r["doc_id"], *result(r)) for r in L.license_scan(edge_frame).collect())))
    assert got == sorted(map(repr, ((r[0], *scanned(r[1])) for r in edge_docs)))
    assert L.license_scan(no_docs).collect() == []
    carried = L.license_scan(edge_frame, carry=["label", "_id", "node"]).first()
    assert (carried["label"], carried["_id"], carried["node"]) == ("x", "x", "x")
    with pytest.raises(ValueError):
        L.license_scan(edge_frame, carry=["score"])


def test_long_text(spark):
    """A million words with a notice in the middle and one over and over."""
    text = "word " * 300_000 + "Licensed under the Apache License, Version 2.0. " * 2 + "of the " * 200_000 + "released under the BSD license " * 20_000
    r = L.license_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (r["n_words"], r["n_base"], r["labels"], len(r["spans"])) == (300_000 + 16 + 400_000 + 100_000, 2, "apache,bsd", 20_000)
