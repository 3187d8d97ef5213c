"""The corpus pipeline: stage by stage against brute force on the stage's own input, and as a whole."""

import pytest

import corpus_pipeline as P
from learnlog.llm.queries import packing_tokenizer

from .test_dedup import words_left
from .test_ngram_join import linked_pairs
from .test_text_rules import base_counts, base_spans
from .test_tokens import check_pieces

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows that each stage got, and the last one's result."""
    folder, docs, seen = tmp_path_factory.mktemp("pipeline"), spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in P.STAGES:
        seen.append(docs.collect())
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if name != "packing":
            assert docs.columns == P.COLUMNS
    return [*seen, docs.collect()]


def test_quality_stage(stages):
    before, after = ({r["doc_id"]: r for r in s} for s in stages[:2])
    assert set(after) < set(before) and all(after[i] == before[i] for i in after)
    assert not any(base_counts(before[i]["text"])[5] for i in after)


def test_near_duplicate_stage_takes_five_words_at_four_fifths(spark):
    """A copy with a fifth of a text added: 3 words at 0.9 leave it in."""
    words = [f"w{k}" for k in range(200)]
    rows = [(1, " ".join(words)), (2, " ".join(words + [f"x{k}" for k in range(40)])), (3, " ".join(words[::-1]))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = [r["doc_id"] for r in P.near_duplicates(spark, docs, SF).collect()]
    assert sorted(left) == [i for i, _, c, _ in linked_pairs(rows, 5, 80, 100) if i == c] == [1, 3]


def test_near_duplicate_stage(stages):
    component = {i: c for i, _, c, _ in linked_pairs([(r["doc_id"], r["text"]) for r in stages[1]], 5, 80, 100)}
    assert {r["doc_id"] for r in stages[2]} == {i for i, c in component.items() if i == c}
    assert len(stages[2]) < len(stages[1])


def test_passage_stage(stages):
    before = {r["doc_id"]: r["text"] for r in stages[2]}
    want = {i: (kept if gone else before[i]) for i, n, gone, kept in words_left([(r["doc_id"], r["text"]) for r in stages[2]]) if n > gone}
    assert {r["doc_id"]: r["text"] for r in stages[3]} == want
    assert all(r["n_chars"] == len(r["text"]) for r in stages[3])


def test_secret_stage(stages):
    before, after = ({r["doc_id"]: r["text"] for r in s} for s in stages[3:5])
    assert set(before) == set(after)
    assert all((after[i] != before[i]) >= bool(base_spans(before[i])) and not base_spans(after[i]) for i in before)


def test_packing_stage(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing_tokenizer())
    ids = {r["doc_id"]: [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 2] for r in stages[4]}
    check_pieces(stages[5], ids)
    assert all(r["ids"] == ids[r["doc_id"]][r["start"]:r["start"] + r["length"]] for r in stages[5])


def test_run(spark, stages):
    got = {(r["doc_id"], r["start"], r["ids_crc32"]) for r in P.run(spark, SF).collect()}
    assert got == {(r["doc_id"], r["start"], r["ids_crc32"]) for r in stages[5]}


def test_stages_on_special_rows(spark, edge_docs, no_docs):
    docs = spark.createDataFrame(edge_docs, no_docs.schema)
    for _, stage in P.STAGES:
        stage(spark, docs, SF).collect()
        assert stage(spark, no_docs, SF).collect() == []
