"""Streaming equals batch (survey 5, item 3)."""

import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from learnlog.operators import history as h
from learnlog.operators.joins import join_dim
from learnlog.plans.q_streaming import log_stream
from learnlog.session import scratch_path
from learnlog.sources import fixtures as fx
from learnlog.streaming.late_labels import run_late_labels
from learnlog.streaming.scoring import drain_to_parquet
from learnlog.streaming.user_state import stream_user_state

from conftest import SMOKE_SF


def test_stream_user_state_equals_batch_window(spark):
    base = scratch_path(spark, f"t-stream-{uuid.uuid4().hex}")
    out = drain_to_parquet(spark, stream_user_state(log_stream(spark, SMOKE_SF, base)),
                           f"{base}/out", f"{base}/ckpt")
    cols = ["row_id", "answered_correctly_sum_u", "count_u"]
    batch = h.user_prior(fx.interactions(spark, SMOKE_SF).filter("content_type_id = 0")).select(*cols)
    assert sorted(out.select(*cols).collect()) == sorted(batch.collect())


def test_late_labels_equal_container_grain_history(spark):
    base = scratch_path(spark, f"t-late-{uuid.uuid4().hex}")
    batches = fx.test_batches(spark, SMOKE_SF, 200)
    qdim = fx.questions(spark, SMOKE_SF)
    got = run_late_labels(spark, batches, qdim, base)
    # batch form: rows of earlier batches only (RANGE frame on the batch number)
    lg = fx.interactions(spark, SMOKE_SF).withColumn("task_container_id",
                                                      F.floor(F.col("row_id") / 200).cast("long"))
    q = join_dim(lg.filter("content_type_id = 0"), qdim.select("question_id", "part"), "content_id", "question_id")
    exp = h.add_user_feats(q, grain="container", rows_per_task=3)
    cols = ["row_id", "answered_correctly_sum_u", "count_u", "part_sum_u", "part_count_u", "first_time"]
    assert sorted(got.select(*cols).collect()) == sorted(exp.select(*cols).collect())
    assert got.count() == q.count()


def test_stream_static_score_equals_batch_scoring(spark):
    from learnlog.operators.model import predict_scores
    from learnlog.plans import static_score as ss
    from learnlog.plans.q_streaming import batch_stream
    from learnlog.streaming.scoring import score_stream

    lg, qd = fx.interactions(spark, SMOKE_SF), fx.questions(spark, SMOKE_SF)
    base = scratch_path(spark, f"t-static-{uuid.uuid4().hex}")
    stats = ss.materialize(ss.static_stats(lg, qd), f"{base}/stats")
    model = ss.train(lg, qd)
    streamed = drain_to_parquet(spark, score_stream(batch_stream(spark, SMOKE_SF, base), model,
                                                    lambda q: ss.featurise(q, stats)),
                                f"{base}/out", f"{base}/ckpt")
    batch = predict_scores(model, ss.featurise(lg, stats))
    a = {r["row_id"]: r["score"] for r in streamed.collect()}
    b = {r["row_id"]: r["score"] for r in batch.collect()}
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) < 1e-12 for k in a)


LATE_COLS = ["row_id", "answered_correctly_sum_u", "count_u", "part_sum_u", "part_count_u", "first_time"]


def _late_expected(spark, rows, step):
    qdim = fx.questions(spark, SMOKE_SF)
    lg = fx.interactions(spark, SMOKE_SF).withColumn("task_container_id", (F.floor(F.col("row_id") / rows) * step).cast("long"))
    q = join_dim(lg.filter("content_type_id = 0"), qdim.select("question_id", "part"), "content_id", "question_id")
    return sorted(h.add_user_feats(q, grain="container").select(*LATE_COLS).collect())


class Crash(Exception):
    pass


@pytest.mark.parametrize("compact", [16, 2])
def test_late_labels_replayed_epochs_and_crashes(spark, monkeypatch, compact):
    """Epochs of one, two and three batches with gaps in their numbers; each is
    replayed, and one crashes after each of its writes before it succeeds."""
    from learnlog.streaming import late_labels as L

    monkeypatch.setattr(L, "COMPACT", compact)
    base = scratch_path(spark, f"t-gaps-{uuid.uuid4().hex}")
    b = fx.test_batches(spark, SMOKE_SF, 100).withColumn("group_num", F.col("group_num") * 3)
    scorer = L.LateLabelScorer(spark, base, fx.questions(spark, SMOKE_SF))
    groups = [r["group_num"] for r in b.select("group_num").distinct().orderBy("group_num").collect()]
    epochs, at = [], 0
    for n in (2, 3, 1, 0, 2, 2):
        epochs.append(groups[at:at + n])
        at += n
    save = L.save_state
    for e, part in enumerate(epochs):
        batch = b.filter(F.col("group_num").isin(part)) if part else b.filter("false")
        if e == 1:
            for after in (False, True):     # before and after the delta is written
                def crash(state, path, after=after):
                    if after:
                        save(state, path)
                    raise Crash
                monkeypatch.setattr(L, "save_state", crash)
                with pytest.raises(Crash):
                    scorer(batch, e)
            monkeypatch.setattr(L, "save_state", save)
        scorer(batch, e)
        scorer(batch, e)                    # the whole epoch again
    got = spark.read.parquet(f"{base}/out")
    assert sorted(got.select(*LATE_COLS).collect()) == _late_expected(spark, 100, 3)


def test_late_labels_miss_nothing_silently(spark):
    from learnlog.streaming.late_labels import LateLabelScorer

    base = scratch_path(spark, f"t-missing-{uuid.uuid4().hex}")
    scorer = LateLabelScorer(spark, base, fx.questions(spark, SMOKE_SF))
    with pytest.raises(AnalysisException):
        scorer(fx.test_batches(spark, SMOKE_SF, 500), 5)      # epochs 0 to 4 are not there


def test_no_scratch_folder_off_local(spark, monkeypatch):
    from learnlog import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())
