"""Substring and suffix dedup against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from learnlog.llm import chunks
from learnlog.llm import suffix_dedup as suffixes
from learnlog.llm.substring_dedup import substring_dedup
from learnlog.llm.suffix_dedup import suffix_dedup, suffix_order

from .llm_cases import smaller_first


def words_left(rows, window=20):
    seen, out = set(), []
    for row in sorted(rows, key=smaller_first):
        words = (row[1] or "").encode().split()
        drop = [False] * len(words)
        for s in range(len(words) - window + 1):
            key = tuple(words[s:s + window])
            if key in seen:
                drop[s:s + window] = [True] * window
            seen.add(key)
        out.append((row[0], len(words), sum(drop), b" ".join(w for w, d in zip(words, drop) if not d).decode()))
    return out


def bytes_left(rows, window=50):
    first = {}
    rank = {i: k for k, i in enumerate(sorted({r[0] for r in rows if r[0] is not None}))}
    rank[None] = len(rank)
    for row in rows:
        raw = (row[1] or "").encode()
        for s in range(len(raw) - window + 1):
            key = raw[s:s + window]
            first[key] = min(first.get(key, rank[row[0]]), rank[row[0]])
    out = []
    for row in rows:
        raw = (row[1] or "").encode()
        drop = np.zeros(len(raw), bool)
        for s in range(len(raw) - window + 1):
            if first[raw[s:s + window]] < rank[row[0]]:
                drop[s:s + window] = True
        spans = int((drop & ~np.concatenate([[False], drop[:-1]])).sum()) if len(raw) else 0
        out.append((row[0], len(raw), int(drop.sum()), spans, np.frombuffer(raw, np.uint8)[~drop].tobytes()))
    return out


def same(a, b):
    key = lambda r: (r[0] is None, *map(str, r))
    assert sorted(map(tuple, a), key=key) == sorted(map(tuple, b), key=key)


@pytest.fixture(params=[1 << 23, 2000], ids=["one chunk", "many chunks"])
def chunk_bytes(request, monkeypatch):
    for f in (chunks.in_chunks,):
        monkeypatch.setattr(f, "__defaults__", (request.param,))


def test_substring_dedup(edge_frame, edge_docs, chunk_bytes):
    same(substring_dedup(edge_frame).select("doc_id", "n_words", "n_removed", "kept_text").collect(), words_left(edge_docs))


def test_substring_dedup_carries_columns(edge_frame, edge_docs):
    got = substring_dedup(edge_frame, carry=["lang", "text"]).select("doc_id", "lang", "text").collect()
    same(got, [(r[0], r[2], r[1]) for r in edge_docs])
    with pytest.raises(ValueError):
        substring_dedup(edge_frame.withColumnRenamed("lang", "n_words"), carry=["n_words"])


def test_suffix_dedup(edge_frame, edge_docs, chunk_bytes):
    got = [(r[0], r[1], r[2], r[3], bytes(r[4])) for r in suffix_dedup(edge_frame).collect()]
    same(got, bytes_left(edge_docs))


def test_empty_table(no_docs):
    assert substring_dedup(no_docs).collect() == []
    assert suffix_dedup(no_docs).collect() == []


def test_suffix_order_is_lexicographic():
    text = np.frombuffer(b"banana" * 30, np.uint8)
    at = np.arange(100)
    order, new = suffix_order(text, at)
    cut = [text[i:i + 50].tobytes() for i in at]
    assert [cut[i] for i in order] == sorted(cut)
    assert new.sum() == len(set(cut))


def test_queries_on_whole_table(spark):
    """The registered queries on the smallest table, against brute force."""
    import hashlib

    from learnlog.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    same(QUERIES["op1_substring_dedup"](spark, sf).collect(),
         [(*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in words_left(rows)])
    same(QUERIES["op9_suffix_dedup"](spark, sf).collect(),
         [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in bytes_left(rows)])


def template_docs():
    """Texts that share headers and footers with other words around them, so that triggers have several phrases; one text is of several slices."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(2, 7))) for _ in range(40)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    heads, feet, long = [prose(14) for _ in range(3)], [prose(12) for _ in range(3)], prose(40_000)
    texts = [f"{prose(rng.randrange(6))} {rng.choice(heads)} {prose(rng.randrange(30))} {rng.choice(feet)}{prose(rng.randrange(3))}" for _ in range(150)]
    texts += [long, f"x{long[:90_000]}y{long[90_001:]}", texts[3], texts[7] + texts[3], None, ""]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, texts[9]), (5, texts[70]), (None, texts[3]), (None, prose(20) + heads[0])]
    rng.shuffle(rows)
    return rows


def test_suffix_dedup_of_templates(spark, chunk_bytes):
    rows = template_docs()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    same([(*r[:4], bytes(r[4])) for r in suffix_dedup(frame).collect()], bytes_left(rows))


def passes(chunk_texts, buckets=7):
    """What chunks of texts send in each pass of suffix dedup."""
    tables = [pa.table({"_text": pa.array(t), "_chunk": pa.array([k] * len(t), pa.int32())}) for k, t in enumerate(chunk_texts)]

    def by(rows, key, reduce):
        return pa.concat_tables([reduce(rows.filter(pa.array(rows[key].to_numpy() == k))) for k in np.unique(rows[key].to_numpy())])

    triggers = pa.concat_tables([suffixes._send_triggers(t, buckets) for t in tables])
    answers = by(triggers, "_bucket", suffixes._shared)
    mine = lambda rows, k: rows.filter(pa.array(rows["_chunk"].to_numpy() == k))
    phrases = pa.concat_tables([suffixes._send_phrases(t, mine(answers, k), buckets) for k, t in enumerate(tables)])
    settled = by(phrases, "_bucket", suffixes._settle)
    return triggers, answers, phrases, settled, [suffixes._send_texts(t, mine(settled, k), buckets) for k, t in enumerate(tables)]


def test_suffix_dedup_sends_contested_texts_once():
    """However many chunks hold copies of a contested phrase, its text goes to the dictionary once, and answers repeat no fingerprint."""
    texts = [t for _, t in template_docs()[:100] if t]
    size = lambda rows: sum(len(x) for x in rows["_data"].to_pylist())
    sent = [sum(len(x) for x in t["_text"].to_pylist()) for t in passes([texts] * 5)[-1]]
    assert sent[0] > 0 and sent[1:] == [0] * 4
    triggers, answers, phrases, settled, _ = passes([texts] * 5)
    distinct = len(np.unique(suffixes.parse([t.encode() for t in texts]).trigger))
    assert size(triggers) == 5 * 4 * distinct
    assert size(answers) <= size(triggers) / 32 + len(answers)
    assert size(settled) == size(phrases) / 16


def test_suffix_dedup_rejects_answers_of_other_texts():
    texts = [[t for _, t in template_docs()[:40] if t]] * 2
    settled = passes(texts)[3]
    changed = pa.table({"_text": pa.array(texts[0][:-5]), "_chunk": pa.array([0] * (len(texts[0]) - 5), pa.int32())})
    with pytest.raises(ValueError, match="rows have changed"):
        suffixes._send_texts(changed, settled.filter(pa.array(settled["_chunk"].to_numpy() == 0)), 7)
