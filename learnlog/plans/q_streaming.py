"""Queries for streaming (survey 2.11). User state, late labels and the batch
filter have oracles; for the scoring streams the features that the streamed
rows get before the model are checked queries, and the tests compare scores
with batch scoring."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..models import committed
from ..operators.model import GBTConfig, train_gbt
from ..operators.stats import content_stats
from ..oracle_views import std_int_sql, test_batches_sql, with_views
from ..plans import static_score as ss
from ..plans import tail_split as ts
from ..registry import register
from ..session import scratch_path
from ..sources import fixtures as fx
from ..streaming.late_labels import batch_filter, write_batches
from ..streaming.late_state import run_late_labels_in_state
from ..streaming.scoring import drain_to_parquet, ensemble_score_stream, lecture_score_stream, score_stream
from ..streaming.user_state import stream_user_state as user_state_stream
from .common import QUESTION_ROWS_SQL
from .q_history import W_U
from .q_stats import CONTAINER_LOAD_SQL, PROFILE_NAMES, PROFILE_SQL

_MODELS: dict = {}
BATCH_ROWS = 1000


def _base(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def log_stream(spark, sf, base):
    """The log as a file stream."""
    lg = fx.interactions(spark, sf).withColumn("group_num", F.floor(F.col("row_id") / BATCH_ROWS).cast("long"))
    return spark.readStream.schema(lg.schema).parquet(write_batches(lg, base))


def batch_stream(spark, sf, base):
    # whole batches are dealt to tasks; a row gets its lists only where it is written
    b = fx.unpacked(fx.packed_batches(spark, sf, BATCH_ROWS).repartitionByRange("group_num"))
    return spark.readStream.schema(b.schema).parquet(write_batches(b, base, arranged=True))


@register("stream_user_state", with_views(f"""WITH {QUESTION_ROWS_SQL.strip()}
SELECT row_id, user_id, CAST(coalesce(sum(answered_correctly) OVER ({W_U}), 0) AS BIGINT) AS answered_correctly_sum_u,
       count(*) OVER ({W_U}) AS count_u,
       CAST(sum(answered_correctly) OVER ({W_U}) AS DOUBLE) / nullif(count(*) OVER ({W_U}), 0) AS answered_correctly_avg_u
FROM qrows""", "interactions", "questions"))
def stream_user_state(spark, sf):
    base = _base(spark, "stream-user")
    out = user_state_stream(log_stream(spark, sf, base))
    return drain_to_parquet(spark, out, f"{base}/out", f"{base}/ckpt")


_LATE = "RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


@register("stream_late_labels", with_views(f"""WITH {QUESTION_ROWS_SQL.strip()},
g AS (SELECT *, row_id // {BATCH_ROWS} AS group_num, coalesce(part, -1) AS pk FROM qrows),
cs AS (SELECT content_id, avg(answered_correctly) AS answered_correctly_avg_c, CAST(sum(answered_correctly) AS BIGINT) AS answered_correctly_sum_c,
              count(answered_correctly) AS answered_correctly_count_c, {std_int_sql("answered_correctly")} AS answered_correctly_std_c
       FROM qrows GROUP BY content_id),
late AS (SELECT row_id, user_id, content_id, group_num,
       CAST(coalesce(sum(answered_correctly) OVER u, 0) AS BIGINT) AS answered_correctly_sum_u, count(*) OVER u AS count_u,
       CAST(sum(answered_correctly) OVER u AS DOUBLE) / nullif(count(*) OVER u, 0) AS answered_correctly_avg_u,
       CAST(coalesce(sum(answered_correctly) OVER p, 0) AS BIGINT) AS part_sum_u, count(*) OVER p AS part_count_u,
       CAST(sum(answered_correctly) OVER p AS DOUBLE) / nullif(count(*) OVER p, 0) AS part_avg_u,
       CASE WHEN count(*) OVER c = 0 THEN 1 ELSE 0 END AS first_time
FROM g
WINDOW u AS (PARTITION BY user_id ORDER BY group_num {_LATE}),
       p AS (PARTITION BY user_id, pk ORDER BY group_num {_LATE}),
       c AS (PARTITION BY user_id, content_id ORDER BY group_num {_LATE}))
SELECT late.*, cs.* EXCLUDE (content_id) FROM late LEFT JOIN cs ON late.content_id = cs.content_id""", "interactions", "questions"))
def stream_late_labels(spark, sf):
    lg, q = fx.interactions(spark, sf), fx.questions(spark, sf)
    return run_late_labels_in_state(spark, fx.test_batches(spark, sf, BATCH_ROWS), q, _base(spark, "stream-late"),
                                    content_stats(lg.filter("content_type_id = 0")))


def lecture_model(spark, sf):
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODELS:
        lg, q, l = fx.interactions(spark, sf), fx.questions(spark, sf), fx.lectures(spark, sf)
        feats = ts.split_features(lg, q, l)
        model = train_gbt(feats, ts.FEATURES, cfg=GBTConfig(max_iter=20))
        _MODELS[key] = (model, ts.materialize(ts.static_tables(lg, q, l), _base(spark, "static")))
    return _MODELS[key]


@register("stream_lecture_score_trained")
def stream_lecture_score_trained(spark, sf):
    model, tables = lecture_model(spark, sf)
    base = _base(spark, "stream-lecture")
    scores = lecture_score_stream(batch_stream(spark, sf, base), model, tables)
    return drain_to_parquet(spark, scores, f"{base}/out", f"{base}/ckpt")


def static_model(spark, sf):
    key = ("static", spark.sparkContext.applicationId, sf)
    if key not in _MODELS:
        lg, q = fx.interactions(spark, sf), fx.questions(spark, sf)
        stats = ss.materialize(ss.static_stats(lg, q), _base(spark, "static-stats"))
        _MODELS[key] = (ss.train(lg, q), stats)
    return _MODELS[key]


_TAGS = ", ".join(f"coalesce(CAST(TRY_CAST(string_split(q.tags, ' ')[{i}] AS INTEGER) AS DOUBLE), 0.5) AS tags{i}" for i in (1, 2, 3))


STATIC_SQL = f"""WITH {QUESTION_ROWS_SQL.strip()},
u AS (SELECT user_id, avg(answered_correctly) AS a, CAST(sum(answered_correctly) AS DOUBLE) AS s FROM qrows GROUP BY user_id),
c AS (SELECT content_id, avg(answered_correctly) AS a FROM qrows GROUP BY content_id),
feats AS (SELECT r.row_id, coalesce(u.a, 0.5) AS answered_correctly_user, coalesce(u.s, 0.5) AS sum, coalesce(c.a, 0.5) AS answered_correctly_content,
       coalesce(CAST(q.bundle_id AS DOUBLE), 0.5) AS bundle_id, coalesce(CAST(q.part AS DOUBLE), 0.5) AS part,
       coalesce(r.prior_question_elapsed_time, 0.5) AS prior_question_elapsed_time,
       CAST(coalesce(r.prior_question_had_explanation, false) AS DOUBLE) AS prior_question_had_explanation_enc, {_TAGS}
FROM qrows r LEFT JOIN u ON r.user_id = u.user_id LEFT JOIN c ON r.content_id = c.content_id
LEFT JOIN questions q ON r.content_id = q.question_id)"""


@register("stream_static_features", with_views(f"{STATIC_SQL}\nSELECT * FROM feats", "interactions", "questions"))
def stream_static_features(spark, sf):
    # What stream_static_score gives to the model, streamed in the same way.
    base = _base(spark, "stream-static-features")
    stats = ss.materialize(ss.static_stats(fx.interactions(spark, sf), fx.questions(spark, sf)), f"{base}/stats")
    rows = ss.featurise(batch_stream(spark, sf, base), stats).select("row_id", *ss.FEATURES)
    return drain_to_parquet(spark, rows, f"{base}/out", f"{base}/ckpt")


_PROFILE = ", ".join(f"coalesce(p.{n}, 0) AS {n}, CAST(coalesce(p.{n}, 0) > 0 AS INTEGER) AS {n}_boolean" for n in PROFILE_NAMES)


LECTURE_SQL = f"""WITH {QUESTION_ROWS_SQL.strip()},
{PROFILE_SQL.strip()},
load AS ({CONTAINER_LOAD_SQL}),
qs AS (SELECT content_id, CAST(round_even(CAST(avg(answered_correctly) AS DECIMAL(18, 9)), 5) AS DOUBLE) AS r, count(*) AS n FROM qrows GROUP BY content_id),
qd AS (SELECT q.question_id, q.part, qs.r,
              CASE WHEN qs.n < 3 THEN 0.65 WHEN qs.r < 0.2 AND qs.n < 21 THEN 0.2 WHEN qs.r > 0.95 AND qs.n < 21 THEN 0.95 ELSE qs.r END AS quest_pct
       FROM questions q LEFT JOIN qs ON q.question_id = qs.content_id),
us AS (SELECT user_id, avg(answered_correctly) AS a, avg(CAST(coalesce(prior_question_had_explanation, false) AS INTEGER)) AS e FROM qrows GROUP BY user_id),
feats AS (SELECT r.row_id, coalesce(us.a, 0.65) AS answered_correctly_user, coalesce(us.e, (SELECT avg(e) FROM us)) AS explanation_mean_user,
       coalesce(qd.quest_pct, (SELECT avg(r) FROM qd)) AS quest_pct, coalesce(l.avg_questions_seen, 1.0) AS avg_questions_seen,
       coalesce(r.prior_question_elapsed_time, (SELECT avg(prior_question_elapsed_time) FROM qrows)) AS prior_question_elapsed_time,
       CAST(coalesce(r.prior_question_had_explanation, false) AS INTEGER) AS prior_question_had_explanation_enc,
       CAST(coalesce(qd.part - 1, 4) AS INTEGER) AS part, {_PROFILE}
FROM qrows r LEFT JOIN us ON r.user_id = us.user_id LEFT JOIN qd ON r.content_id = qd.question_id
LEFT JOIN load l ON least(r.task_container_id, 9999) = l.task_container_id LEFT JOIN profile p ON r.user_id = p.user_id)"""


@register("stream_lecture_features", with_views(f"{LECTURE_SQL}\nSELECT * FROM feats", "interactions", "questions", "lectures"))
def stream_lecture_features(spark, sf):
    # What stream_lecture_score gives to the model, streamed in the same way.
    base = _base(spark, "stream-lecture-features")
    lg, q, l = fx.interactions(spark, sf), fx.questions(spark, sf), fx.lectures(spark, sf)
    tables = ts.materialize(ts.static_tables(lg, q, l), f"{base}/tables")
    rows = batch_stream(spark, sf, base).filter(F.col("content_type_id") == 0)
    return drain_to_parquet(spark, ts.featurise(rows, tables).select("row_id", *ts.FEATURES), f"{base}/out", f"{base}/ckpt")


@register("stream_static_score", with_views(f"{STATIC_SQL}\nSELECT row_id, {committed('static').sql()} AS score FROM feats", "interactions", "questions"))
def stream_static_score(spark, sf):
    # Frozen user / content / question statistics joined to each micro-batch,
    # NULLs filled with 0.5, scored by the committed model.
    base = _base(spark, "stream-static")
    stats = ss.materialize(ss.static_stats(fx.interactions(spark, sf), fx.questions(spark, sf)), f"{base}/stats")
    scores = ensemble_score_stream(batch_stream(spark, sf, base), committed("static"), lambda q: ss.featurise(q, stats))
    return drain_to_parquet(spark, scores, f"{base}/out", f"{base}/ckpt")


@register("stream_static_score_trained")
def stream_static_score_trained(spark, sf):
    # The same with the model trained on the log.
    model, stats = static_model(spark, sf)
    base = _base(spark, "stream-static")
    scores = score_stream(batch_stream(spark, sf, base), model, lambda q: ss.featurise(q, stats))
    return drain_to_parquet(spark, scores, f"{base}/out", f"{base}/ckpt")


def lecture_scores(spark, sf, base, keep=()):
    """Scores of the committed model on the stream, with the static tables of the log."""
    lg, q, l = fx.interactions(spark, sf), fx.questions(spark, sf), fx.lectures(spark, sf)
    tables = ts.materialize(ts.static_tables(lg, q, l), f"{base}/tables")
    return ensemble_score_stream(batch_stream(spark, sf, base), committed("lecture"), lambda rows: ts.featurise(rows, tables), keep)


@register("stream_lecture_score", with_views(f"{LECTURE_SQL}\nSELECT row_id, {committed('lecture').sql()} AS score FROM feats", "interactions", "questions", "lectures"))
def stream_lecture_score(spark, sf):
    base = _base(spark, "stream-lecture")
    return drain_to_parquet(spark, lecture_scores(spark, sf, base), f"{base}/out", f"{base}/ckpt")


@register("sink_predictions", with_views(f"""{LECTURE_SQL}
SELECT row_id, {committed('lecture').sql()} AS answered_correctly, CAST(row_id // {BATCH_ROWS} AS INTEGER) AS group_num FROM feats""",
    "interactions", "questions", "lectures"))
def sink_predictions(spark, sf):
    # The submission form: the score under the label's name, a folder per batch.
    base = _base(spark, "stream-sink")
    scores = lecture_scores(spark, sf, base, keep=("group_num",)).withColumnRenamed("score", "answered_correctly")
    return drain_to_parquet(spark, scores, f"{base}/predictions", f"{base}/ckpt", partition_by=("group_num",))


@register("stream_batch_filter", with_views(f"WITH {test_batches_sql(BATCH_ROWS).strip()}\nSELECT * FROM batches WHERE group_num = 1", "interactions"))
def stream_batch_filter(spark, sf):
    base = _base(spark, "stream-filter")
    picked = batch_filter(batch_stream(spark, sf, base), 1)
    return drain_to_parquet(spark, picked, f"{base}/out", f"{base}/ckpt")
