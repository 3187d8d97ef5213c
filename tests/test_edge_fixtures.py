"""Hand-written edge fixtures (FIXTURES.md): one-row user, lecture-only user,
repeated content, repeated lecture with one tag, NULL and one-character tags,
content missing from the dimension, equal timestamps, all answers right,
content in valid absent from train."""

import pytest

from learnlog.operators import history as h
from learnlog.operators import lectures as lec
from learnlog.operators import state as stt
from learnlog.operators.joins import join_dim
from learnlog.schema import INTERACTIONS, LECTURES, QUESTIONS


def row(rid, ts, user, content, lecture=0, y=1):
    return dict(row_id=rid, timestamp=ts, user_id=user, content_id=content, content_type_id=lecture,
                task_container_id=0, user_answer=-1 if lecture else 0, answered_correctly=-1 if lecture else y,
                prior_question_elapsed_time=None, prior_question_had_explanation=None)


@pytest.fixture(scope="module")
def dims(spark):
    q = spark.createDataFrame([
        dict(question_id=1, bundle_id=0, correct_answer=0, part=2, tags="11 22"),
        dict(question_id=2, bundle_id=0, correct_answer=0, part=3, tags=None),
        dict(question_id=3, bundle_id=1, correct_answer=0, part=3, tags="7"),
    ], QUESTIONS)
    lt = spark.createDataFrame([
        dict(lecture_id=10, tag=11, part=2, type_of="concept"),
        dict(lecture_id=11, tag=7, part=5, type_of="solving question"),
    ], LECTURES)
    return q, lt


def test_edge_log(spark, dims):
    qdim, ldim = dims
    rows = [
        row(0, 5, user=1, content=1),                       # one-row user
        row(1, 0, user=2, content=10, lecture=1),           # lecture-only user
        row(2, 1, user=2, content=10, lecture=1),
        row(3, 0, user=3, content=10, lecture=1),           # repeated lecture, same tag
        row(4, 0, user=3, content=10, lecture=1),           # equal timestamps: row_id breaks the tie
        row(5, 0, user=3, content=1),
        row(6, 2, user=3, content=1),                       # repeated content
        row(7, 3, user=3, content=2),                       # NULL tags
        row(8, 4, user=3, content=99),                      # content missing from the dimension
        row(9, 4, user=3, content=11, lecture=1),
        row(10, 5, user=3, content=3),                      # one-character tag matches the lecture
    ]
    log = spark.createDataFrame(rows, INTERACTIONS)
    hist = {r["row_id"]: r for r in lec.lecture_history(log, qdim, ldim, rows_per_task=2).collect()}
    assert set(hist) == {0, 5, 6, 7, 8, 10}
    assert hist[0]["num_lecture_seen"] == 0 and hist[0]["num_question_seen"] == 1
    assert hist[5]["num_tags_match"] == 2 and hist[5]["part_matches"] == 1   # two lectures tagged 11
    assert hist[7]["num_tags_match"] == 0 and hist[7]["part_matches"] == 0   # NULL tags
    assert hist[8]["num_tags_match"] == 0 and hist[8]["part_matches"] == 0   # unknown question
    assert hist[10]["num_tags_match"] == 1 and hist[10]["num_lecture_seen"] == 3
    assert hist[10]["part3_seen"] == 2 and hist[8]["part3_seen"] == 1

    q = join_dim(log.filter("content_type_id = 0"), qdim.select("question_id", "part"), "content_id", "question_id")
    f = {r["row_id"]: r for r in h.add_user_feats(q, rows_per_task=1).collect()}
    assert f[0]["count_u"] == 0 and f[0]["answered_correctly_avg_u"] is None and f[0]["first_time"] == 1
    assert f[6]["first_time"] == 0 and f[6]["count_u"] == 1
    assert f[10]["answered_correctly_avg_u"] == 1.0  # all answers right
    assert f[8]["part_count_u"] == 0  # NULL part is its own group


def test_valid_content_absent_from_train(spark, dims):
    qdim, _ = dims
    train = spark.createDataFrame([row(0, 0, 1, 1), row(1, 1, 1, 2)], INTERACTIONS)
    valid = spark.createDataFrame([row(2, 5, 1, 3), row(3, 6, 9, 1)], INTERACTIONS)
    tq = join_dim(train, qdim.select("question_id", "part"), "content_id", "question_id")
    vq = join_dim(valid, qdim.select("question_id", "part"), "content_id", "question_id")
    out = {r["row_id"]: r for r in stt.apply_frozen_state(vq, stt.build_state(tq)).collect()}
    assert out[2]["first_time"] == 1 and out[2]["count_u"] == 2 and out[2]["part_count_u"] == 1
    assert out[3]["count_u"] == 0 and out[3]["answered_correctly_avg_u"] is None  # unknown user


def test_dimension_join_without_broadcast(spark, dims):
    qdim, _ = dims
    log = spark.createDataFrame([row(0, 0, 1, 1), row(1, 1, 1, 99)], INTERACTIONS)
    dim = qdim.select("question_id", "part")
    for hint in ("broadcast", "merge"):
        got = sorted((r["row_id"], r["part"]) for r in join_dim(log, dim.hint(hint), "content_id", "question_id").collect())
        assert got == [(0, 2), (1, None)]
