"""Byte-level BPE and packing against the public libraries."""

import base64
import hashlib
import json
import random
import unicodedata
import zlib

import numpy as np
import pytest

from learnlog.llm import byte_bpe as B
from learnlog.llm import packing as K
from learnlog.llm.queries import QUERIES, bpe_ranks, packing_tokenizer

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def encoding():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe_ranks(), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(1)
    parts = ["'", "s", "t", "re", "ve", "ll", "d", "m", " ", "  ", "\n", "\t", "a", "é", "1", "²", "५", "!", "#", "'S", "中", "😀", "\x1c", "́", "\0", "\x85", "　", "<|endoftext|>"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 40))) for _ in range(4000)] + [
        "a" * 5000, "ab" * 3000 + "!" * 700, " " * 1000, "x" + " " * 999, "", "it's we'll they've I'd"]


def test_ids_and_bytes(encoding):
    texts = odd_texts()
    raw = [t.encode() for t in texts]
    ranks = B.Ranks(bpe_ranks())
    ids, bounds = ranks.encode(raw)
    data, ends = ranks.decode(ids)
    for k, t in enumerate(texts):
        assert ids[bounds[k]:bounds[k + 1]].tolist() == encoding.encode_ordinary(t), repr(t)
        assert data[ends[bounds[k]]:ends[bounds[k + 1]]].tobytes() == raw[k]


def test_slices_follow_the_pattern():
    import regex

    pattern = regex.compile(public_tokenizers.PATTERN)
    texts = odd_texts()
    raw, (begin, end), count = B.slice_bounds([t.encode() for t in texts])
    got, at = [raw[a:b] for a, b in zip(begin, end)], 0
    for t, n in zip(texts, count):
        if not any(c in t for c in "\x1c"):       # the libraries differ in what is white space
            assert got[at:at + n] == [m.group().encode() for m in pattern.finditer(t)], repr(t)
        at += n


def test_cache_restart(encoding, monkeypatch):
    monkeypatch.setattr(B, "CACHE_SLICES", 10)
    ranks = B.Ranks(bpe_ranks())
    for t in ("one two three four five six seven", "eight nine ten eleven twelve", "one two", "ten"):
        assert ranks.encode([t.encode()])[0].tolist() == encoding.encode_ordinary(t)


def test_bpe_query(spark, encoding):
    rows = {r["doc_id"]: tuple(r) for r in QUERIES["op4_byte_bpe"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for r in docs:
        ids = encoding.encode_ordinary(r["text"] or "")
        assert rows[r["doc_id"]] == (r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                                     hashlib.sha256((r["text"] or "").encode()).hexdigest())


def test_bpe_special_rows(edge_frame, edge_docs, no_docs, encoding):
    got = B.bpe_decode(B.bpe_encode(edge_frame, bpe_ranks()), bpe_ranks()).collect()
    key = lambda r: (str(r[0]), r[1], r[2])
    want = [(r[0], len(encoding.encode_ordinary(r[1] or "")), (r[1] or "").encode()) for r in edge_docs]
    assert sorted(((r["doc_id"], r["n_tokens"], bytes(r["decoded"])) for r in got), key=key) == sorted(want, key=key)
    assert B.bpe_encode(no_docs, bpe_ranks()).collect() == []


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing_tokenizer())


def test_word_cache_equals_whole_texts(tokenizer):
    texts = odd_texts() + ["Ünïted ÉCOLE l’été d'été 'Re x'LL ½ ª ²³ ÿŸ ǅ ǆ ﬁ don't's a\u00adb \u00a0x", "İstanbul ΑΣ ΑΣ' Ǆ", "é ́e  e f", "a<|endoftext|>b"]
    ids, bounds = K.WordEncoder(packing_tokenizer()).encode([t.encode() for t in texts], K.END_ID)
    for k, t in enumerate(texts):
        assert ids[bounds[k]:bounds[k + 1]].tolist() == [*tokenizer.encode(t, add_special_tokens=False).ids, K.END_ID], repr(t)


def test_every_code_point(tokenizer):
    """Alone, inside a word, after a digit and before a mark."""
    points = [c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000]
    points = [c for c in points if unicodedata.category(c) != "Cn" and not 0xAC00 < ord(c) < 0xD7A3 and not 0xF0000 <= ord(c)]
    encoder = K.WordEncoder(packing_tokenizer())
    for i in range(0, len(points), 4000):
        texts = [f"{c} a{c}b 1{c} {c}\u0301" for c in points[i:i + 4000]]
        ids, bounds = encoder.encode([t.encode() for t in texts], K.END_ID)
        want = tokenizer.encode_batch(texts, add_special_tokens=False)
        wrong = [t for k, t in enumerate(texts) if ids[bounds[k]:bounds[k + 1] - 1].tolist() != want[k].ids]
        assert not wrong, wrong[:5]


def test_another_file_goes_to_the_library(tmp_path):
    """What is assumed of the file is compared with what it says."""
    from tokenizers import Tokenizer

    content = json.load(open(packing_tokenizer(), encoding="utf-8"))
    content["normalizer"] = None
    path = str(tmp_path / "cased.json")
    json.dump(content, open(path, "w", encoding="utf-8"))
    text = "Some Words, don't STOP 123"
    ids, _ = K.WordEncoder(path).encode([text.encode()], K.END_ID)
    assert ids.tolist() == [*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, K.END_ID]
    assert ids.tolist() != K.WordEncoder(packing_tokenizer()).encode([text.encode()], K.END_ID)[0].tolist()


def check_pieces(rows, ids, length=4096):
    """Every id in one piece, sequences gapless from 0 and not too long; the share that is filled."""
    sequences, documents = {}, {}
    for r in rows:
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(part) == r["length"] > 0 and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        documents.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    for kind in (sequences, documents):
        for key, parts in kind.items():
            at = 0
            for begin, n in sorted(parts):
                assert begin == at
                at += n
            assert at <= length if kind is sequences else at == len(ids[key])
    assert set(documents) == set(ids)
    return sum(map(len, ids.values())) / (length * len(sequences))


def test_packing_query(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    ids = {r["doc_id"]: [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2] for r in docs}
    assert check_pieces(QUERIES["op10_packing"](spark, SF).collect(), ids) > 0.98


def test_packing_special_rows(spark, edge_frame, edge_docs, no_docs, tokenizer, monkeypatch):
    monkeypatch.setattr(K, "GROUP_TOKENS", 5000)
    # rows of one id are told apart by their ids; the carried columns' names clash with none of the result's
    want = sorted(str([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2]) + str(r[0]) for r in edge_docs)
    got = K.pack_documents(edge_frame, packing_tokenizer(), with_ids=True).collect()
    rows, sequences = {}, {}
    for r in got:
        rows.setdefault((r["doc_id"], r["doc_tokens"], r["start"] if r["length"] == r["doc_tokens"] else None), []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for begin, n in sorted(parts):
            assert begin == at
            at += n
        assert at <= 4096
    whole = [str(list(r["ids"])) + str(r["doc_id"]) for r in got if r["length"] == r["doc_tokens"]]
    for (doc_id, tokens, start), parts in rows.items():
        if start is None:            # a long text: its pieces, in order (no id has two long texts here)
            parts.sort(key=lambda r: r["start"])
            assert [r["start"] for r in parts] == [sum(p["length"] for p in parts[:k]) for k in range(len(parts))]
            whole.append(str([i for r in parts for i in r["ids"]]) + str(doc_id))
    assert sorted(whole) == want
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)
    assert K.pack_documents(no_docs, packing_tokenizer()).collect() == []


def test_best_fit_decreasing():
    rng = random.Random(0)
    lengths = [rng.randrange(1, 101) for _ in range(2000)]
    window, offset = K.best_fit_decreasing(lengths, 100)
    room = {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [w for w, r in room.items() if r >= lengths[i]]
        if fits:
            assert room[window[i]] == min(room[w] for w in fits)
        else:
            assert window[i] not in room
        assert offset[i] == 100 - room.get(window[i], 100)
        room[window[i]] = room.get(window[i], 100) - lengths[i]
    assert min(room.values()) >= 0
