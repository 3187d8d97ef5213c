"""Queries for aggregations (survey 2.4)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import sketches as sk
from ..operators import stats as st
from ..operators.joins import attach_lecture_dim
from ..oracle_views import std_int_sql, with_views
from ..registry import register
from ..schema import LECTURE_TYPES, PARTS
from ..session import scratch_path, stored
from ..sources import fixtures as fx
from .common import QUESTION_ROWS_SQL, log, question_rows

STD = std_int_sql("answered_correctly")  # exact-moment sample std (stats.std_int)

Y = "answered_correctly"


def _q(sql: str, *extra: str) -> str:
    return with_views(f"WITH {QUESTION_ROWS_SQL.strip()}\n{sql}", "interactions", "questions", *extra)


def _qrows(spark, sf):
    return log(spark, sf).filter(F.col("content_type_id") == 0)


@register("content_mean", _q("""
SELECT content_id, avg(answered_correctly) AS answered_correctly_avg_c FROM qrows GROUP BY content_id"""))
def content_mean(spark, sf):
    return st.content_stats(_qrows(spark, sf), ("avg",))


@register("content_mean_count", _q("""
SELECT content_id, avg(answered_correctly) AS answered_correctly_avg_c,
       count(answered_correctly) AS answered_correctly_count_c
FROM qrows GROUP BY content_id"""))
def content_mean_count(spark, sf):
    return st.content_stats(_qrows(spark, sf), ("avg", "count"))


@register("content_mean_std_count", _q(f"""
SELECT content_id, avg(answered_correctly) AS question_mean_acc,
       {STD} AS question_std_acc, count(*) AS question_count
FROM qrows GROUP BY content_id"""))
def content_mean_std_count(spark, sf):
    return st.named_stats(_qrows(spark, sf), "content_id", {
        "question_mean_acc": F.avg(Y), "question_std_acc": st.std_int(Y),
        "question_count": F.count(F.lit(1))})


@register("content_full_stats", _q(f"""
SELECT content_id, avg(answered_correctly) AS answered_correctly_avg_c,
       CAST(sum(answered_correctly) AS BIGINT) AS answered_correctly_sum_c,
       count(answered_correctly) AS answered_correctly_count_c,
       {STD} AS answered_correctly_std_c
FROM qrows GROUP BY content_id"""))
def content_full_stats(spark, sf):
    return st.content_stats(_qrows(spark, sf))


@register("content_attempt_stats", _q(f"""
SELECT content_id, question_count, avg(answered_correctly) AS mean_acc,
       {STD} AS std_acc, count(answered_correctly) AS "count"
FROM (SELECT content_id, answered_correctly,
             CAST(least(count(*) OVER (PARTITION BY user_id, content_id), 5) AS BIGINT) AS question_count
      FROM qrows) t
GROUP BY content_id, question_count"""))
def content_attempt_stats(spark, sf):
    return st.content_attempt_stats(_qrows(spark, sf))


@register("container_stats", _q(f"""
SELECT task_container_id, avg(answered_correctly) AS task_mean_acc,
       {STD} AS task_std_acc, count(*) AS task_count
FROM qrows GROUP BY task_container_id"""))
def container_stats(spark, sf):
    return st.named_stats(_qrows(spark, sf), "task_container_id", {
        "task_mean_acc": F.avg(Y), "task_std_acc": st.std_int(Y), "task_count": F.count(F.lit(1))})


@register("user_mean_sum", with_views("""
SELECT user_id, avg(answered_correctly) AS answered_correctly_mean_user,
       CAST(sum(answered_correctly) AS BIGINT) AS answered_correctly_sum_user
FROM interactions GROUP BY user_id""", "interactions"))
def user_mean_sum(spark, sf):
    # D8 variant "all": lecture rows (label -1) are included, as the reference does.
    return st.named_stats(log(spark, sf), "user_id", {
        "answered_correctly_mean_user": F.avg(Y), "answered_correctly_sum_user": F.sum(Y).cast("long")})


@register("user_mean_questions", _q("""
SELECT user_id, avg(answered_correctly) AS answered_correctly_user FROM qrows GROUP BY user_id"""))
def user_mean_questions(spark, sf):
    return st.named_stats(_qrows(spark, sf), "user_id", {"answered_correctly_user": F.avg(Y)})


@register("user_explanation_mean", _q("""
SELECT user_id, avg(CAST(coalesce(prior_question_had_explanation, false) AS INTEGER)) AS explanation_mean_user
FROM qrows GROUP BY user_id"""))
def user_explanation_mean(spark, sf):
    flag = F.coalesce(F.col("prior_question_had_explanation"), F.lit(False)).cast("int")
    return st.named_stats(_qrows(spark, sf), "user_id", {"explanation_mean_user": F.avg(flag)})


@register("question_count", _q("""
SELECT question_id, count(*) AS "count" FROM qrows WHERE question_id IS NOT NULL GROUP BY question_id"""))
def question_count(spark, sf):
    q = question_rows(spark, sf).filter(F.col("question_id").isNotNull())
    return st.named_stats(q, "question_id", {"count": F.count(F.lit(1))})


PROFILE_NAMES = [f"part_{p}" for p in PARTS] + [f"type_of_{t}" for t in LECTURE_TYPES]
_PROFILE_SUMS = ",\n".join(
    [f"CAST(sum(CASE WHEN l.part = {p} THEN 1 ELSE 0 END) AS BIGINT) AS part_{p}" for p in PARTS]
    + [f"CAST(sum(CASE WHEN replace(l.type_of, ' ', '_') = '{t}' THEN 1 ELSE 0 END) AS BIGINT) AS type_of_{t}"
       for t in LECTURE_TYPES])
PROFILE_SQL = f"""
profile AS (
  SELECT i.user_id, {_PROFILE_SUMS}
  FROM interactions i LEFT JOIN lectures l ON i.content_id = l.lecture_id
  WHERE i.content_type_id = 1
  GROUP BY i.user_id
)"""


def lecture_rows(spark, sf):
    lr = log(spark, sf).filter(F.col("content_type_id") == 1)
    return attach_lecture_dim(lr, fx.lectures(spark, sf))


@register("user_lecture_profile", with_views(f"WITH {PROFILE_SQL.strip()}\nSELECT * FROM profile",
                                             "interactions", "lectures"))
def user_lecture_profile(spark, sf):
    return st.user_lecture_profile(lecture_rows(spark, sf), flags=False)


_FLAGS = ", ".join(f"CAST({n} > 0 AS INTEGER) AS {n}_boolean" for n in PROFILE_NAMES)


@register("user_lecture_flags", with_views(f"WITH {PROFILE_SQL.strip()}\nSELECT *, {_FLAGS} FROM profile",
                                           "interactions", "lectures"))
def user_lecture_flags(spark, sf):
    return st.user_lecture_profile(lecture_rows(spark, sf), flags=True)


CONTAINER_LOAD_SQL = """
SELECT task_container_id, avg_questions,
       sum(avg_questions) OVER (ORDER BY task_container_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS avg_questions_seen
FROM (SELECT task_container_id, CAST(count(*) AS DOUBLE) / count(DISTINCT user_id) AS avg_questions
      FROM qrows GROUP BY task_container_id) t"""


@register("container_questions_per_user", _q("""
SELECT task_container_id, CAST(count(*) AS DOUBLE) / count(DISTINCT user_id) AS avg_questions
FROM qrows GROUP BY task_container_id"""))
def container_questions_per_user(spark, sf):
    return st.container_questions(_qrows(spark, sf))


@register("cumulative_container_load", _q(CONTAINER_LOAD_SQL))
def cumulative_container_load(spark, sf):
    return st.container_load(_qrows(spark, sf))


@register("user_part_stats", _q("""
SELECT user_id, part, avg(answered_correctly) AS part_mean_u,
       CAST(sum(answered_correctly) AS BIGINT) AS part_sum_u
FROM qrows GROUP BY user_id, part"""))
def user_part_stats(spark, sf):
    return st.named_stats(question_rows(spark, sf), ["user_id", "part"], {
        "part_mean_u": F.avg(Y), "part_sum_u": F.sum(Y).cast("long")})


@register("global_means", _q("""
SELECT (SELECT avg(answered_correctly) FROM qrows) AS label_mean,
       (SELECT avg(prior_question_elapsed_time) FROM qrows) AS elapsed_mean,
       (SELECT avg(m) FROM (SELECT avg(answered_correctly) AS m FROM qrows GROUP BY user_id) u) AS user_mean_mean,
       (SELECT avg(m) FROM (SELECT avg(answered_correctly) AS m FROM qrows GROUP BY content_id) c)
         AS question_mean_mean"""))
def global_means(spark, sf):
    return st.global_means(_qrows(spark, sf))


@register("distinct_counts", with_views("""
SELECT count(DISTINCT user_id) AS n_user_id, count(DISTINCT content_id) AS n_content_id,
       count(DISTINCT task_container_id) AS n_task_container_id
FROM interactions""", "interactions"))
def distinct_counts(spark, sf):
    return st.distinct_counts(log(spark, sf), ["user_id", "content_id", "task_container_id"])


COUNTED = ("user_id", "content_id", "task_container_id")


@register("distinct_counts_by_day", with_views("\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_exact, true AS within_three_errors FROM interactions" for c in COUNTED), "interactions"))
def distinct_counts_by_day(spark, sf):
    """Sketches of the first half of the days, the other half folded in; estimates against the exact counts."""
    lg, path = stored(log(spark, sf).select(*COUNTED, F.floor(F.col("timestamp") / fx.DAY_MS).cast("int").alias("day")), "days"), scratch_path(spark, f"hll-{uuid.uuid4().hex}")
    late = F.col("day") % 2 == 1
    sk.write_sketches(sk.daily_sketches(lg.where(~late), COUNTED, F.col("day")), path)
    sk.update_sketches(spark, path, lg.where(late), COUNTED, F.col("day"))
    exact = st.distinct_counts(lg, COUNTED).unpivot([], [f"n_{c}" for c in COUNTED], "column", "n_exact").withColumn("column", F.substring("column", 3, 100))
    near = F.abs(F.col("n") - F.col("n_exact")) <= 3 * sk.STANDARD_ERROR * F.col("n_exact")
    return exact.join(sk.distinct_estimates(spark.read.parquet(path)), "column").select("column", "n_exact", near.alias("within_three_errors"))


PROFILE_COLS = ["answered_correctly", "prior_question_elapsed_time", "content_type_id"]
_SUMMARY = "\nUNION ALL\n".join(f"""
SELECT '{c}' AS "column", count(v) AS "count", avg(v) AS mean, stddev_samp(v) AS std, min(v) AS "min",
       quantile_cont(v, 0.25) AS p25, quantile_cont(v, 0.5) AS p50, quantile_cont(v, 0.75) AS p75,
       max(v) AS "max"
FROM (SELECT CAST({c} AS DOUBLE) AS v FROM interactions) t""" for c in PROFILE_COLS)


@register("profile_summary", with_views(_SUMMARY, "interactions"))
def profile_summary(spark, sf):
    return st.profile_summary(log(spark, sf), PROFILE_COLS)


@register("median_quantile", with_views("""
SELECT quantile_cont(prior_question_elapsed_time, 0.5) AS elapsed_median,
       quantile_cont("timestamp", 0.11) AS ts_q11
FROM interactions""", "interactions"))
def median_quantile(spark, sf):
    from ..functions.quantiles import column_quantiles
    cols = {"elapsed": F.col("prior_question_elapsed_time"), "ts": F.col("timestamp")}
    at = column_quantiles(log(spark, sf), cols, [0.5, 0.11])
    return spark.createDataFrame([(at["elapsed"][0], at["ts"][1])], "elapsed_median double, ts_q11 double")
