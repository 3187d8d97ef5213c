"""Queries for joins (survey 2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import round_half_even
from ..operators import joins as jn
from ..operators import splits as sp
from ..operators import stats as st
from ..oracle_views import std_int_sql, with_views
from ..registry import register
from ..sources import fixtures as fx
from .common import log
from .q_stats import PROFILE_SQL, lecture_rows

STD = std_int_sql("answered_correctly")  # exact-moment sample std (stats.std_int)


def _qrows(spark, sf):
    return log(spark, sf).filter(F.col("content_type_id") == 0)


@register("join_question_dim", with_views("""
SELECT i.row_id, i.content_id, q.question_id, q.bundle_id, q.correct_answer, q.part, q.tags
FROM interactions i LEFT JOIN questions q ON i.content_id = q.question_id
WHERE i.content_type_id = 0""", "interactions", "questions"))
def join_question_dim(spark, sf):
    q = fx.questions(spark, sf)
    return (jn.join_dim(_qrows(spark, sf), q, "content_id", "question_id", keep_key=True)
            .select("row_id", "content_id", "question_id", "bundle_id", "correct_answer", "part", "tags"))


@register("join_lecture_dim", with_views("""
SELECT i.row_id, i.content_id, l.lecture_id, l.tag AS lecture_tag, l.part AS lecture_part,
       l.type_of AS lecture_type_of
FROM interactions i LEFT JOIN lectures l ON i.content_id = l.lecture_id
WHERE i.content_type_id = 1""", "interactions", "lectures"))
def join_lecture_dim(spark, sf):
    return lecture_rows(spark, sf).select("row_id", "content_id", "lecture_id", "lecture_tag",
                                          "lecture_part", "lecture_type_of")


CSTATS = f"""
cstats AS (
  SELECT content_id, avg(answered_correctly) AS answered_correctly_avg_c,
         CAST(sum(answered_correctly) AS BIGINT) AS answered_correctly_sum_c,
         count(answered_correctly) AS answered_correctly_count_c,
         {STD} AS answered_correctly_std_c
  FROM interactions WHERE content_type_id = 0 GROUP BY content_id
)"""


@register("join_content_stats", with_views(f"""WITH {CSTATS.strip()}
SELECT i.row_id, i.content_id, c.answered_correctly_avg_c, c.answered_correctly_sum_c,
       c.answered_correctly_count_c, c.answered_correctly_std_c
FROM interactions i LEFT JOIN cstats c ON i.content_id = c.content_id
WHERE i.content_type_id = 0""", "interactions"))
def join_content_stats(spark, sf):
    q = _qrows(spark, sf)
    return (jn.join_stats(q, st.content_stats(q), "content_id")
            .select("row_id", "content_id", "answered_correctly_avg_c", "answered_correctly_sum_c",
                    "answered_correctly_count_c", "answered_correctly_std_c"))


@register("join_user_stats", with_views("""
SELECT i.row_id, i.user_id, u.answered_correctly_mean_user, u.answered_correctly_sum_user
FROM interactions i LEFT JOIN (
  SELECT user_id, avg(answered_correctly) AS answered_correctly_mean_user,
         CAST(sum(answered_correctly) AS BIGINT) AS answered_correctly_sum_user
  FROM interactions GROUP BY user_id) u ON i.user_id = u.user_id""", "interactions"))
def join_user_stats(spark, sf):
    lg = log(spark, sf)
    u = st.named_stats(lg, "user_id", {"answered_correctly_mean_user": F.avg("answered_correctly"),
                                       "answered_correctly_sum_user": F.sum("answered_correctly").cast("long")})
    return jn.join_stats(lg, u, "user_id").select("row_id", "user_id", "answered_correctly_mean_user",
                                                  "answered_correctly_sum_user")


@register("join_container_stats", with_views(f"""
SELECT i.row_id, i.task_container_id, t.task_mean_acc, t.task_std_acc, t.task_count
FROM interactions i LEFT JOIN (
  SELECT task_container_id, avg(answered_correctly) AS task_mean_acc,
         {STD} AS task_std_acc, count(*) AS task_count
  FROM interactions WHERE content_type_id = 0 GROUP BY task_container_id) t
  ON i.task_container_id = t.task_container_id
WHERE i.content_type_id = 0""", "interactions"))
def join_container_stats(spark, sf):
    q = _qrows(spark, sf)
    t = st.named_stats(q, "task_container_id", {
        "task_mean_acc": F.avg("answered_correctly"), "task_std_acc": st.std_int("answered_correctly"),
        "task_count": F.count(F.lit(1))})
    return jn.join_stats(q, t, "task_container_id").select(
        "row_id", "task_container_id", "task_mean_acc", "task_std_acc", "task_count")


@register("join_user_lecture_profile", with_views(f"""WITH {PROFILE_SQL.strip()}
SELECT i.row_id, p.* EXCLUDE (user_id), i.user_id
FROM interactions i LEFT JOIN profile p ON i.user_id = p.user_id
WHERE i.content_type_id = 0""", "interactions", "lectures"))
def join_user_lecture_profile(spark, sf):
    prof = st.user_lecture_profile(lecture_rows(spark, sf), flags=False)
    return jn.join_stats(_qrows(spark, sf).select("row_id", "user_id"), prof, "user_id")


@register("enrich_question_stats", with_views("""
SELECT q.question_id, q.part, q.bundle_id,
       CAST(round_even(CAST(s.quest_pct AS DECIMAL(18, 9)), 5) AS DOUBLE) AS quest_pct, s."count"
FROM questions q LEFT JOIN (
  SELECT content_id, avg(answered_correctly) AS quest_pct, count(*) AS "count"
  FROM interactions WHERE content_type_id = 0 GROUP BY content_id) s ON q.question_id = s.content_id""",
    "interactions", "questions"))
def enrich_question_stats(spark, sf):
    q = _qrows(spark, sf)
    s = st.named_stats(q, "content_id", {"quest_pct": F.avg("answered_correctly"), "count": F.count(F.lit(1))})
    s = s.withColumn("quest_pct", round_half_even("quest_pct", 5))
    dim = fx.questions(spark, sf).select("question_id", "part", "bundle_id")
    return dim.join(s, dim.question_id == s.content_id, "left").drop("content_id")


@register("lookup_by_position", with_views(f"""WITH {CSTATS.strip()}
SELECT i.row_id, i.content_id, q.part, q.bundle_id, c.answered_correctly_avg_c, c.answered_correctly_count_c
FROM interactions i LEFT JOIN questions q ON i.content_id = q.question_id LEFT JOIN cstats c ON i.content_id = c.content_id""",
    "interactions", "questions"))
def lookup_by_position(spark, sf):
    # D3: two tables reindexed by the rows' content and put beside them are
    # keyed left joins here; a lecture row looks up its content id too.
    lg = log(spark, sf)
    q = fx.questions(spark, sf).select("question_id", "part", "bundle_id")
    c = st.content_stats(lg.filter(F.col("content_type_id") == 0), ("avg", "count"))
    return jn.join_stats(jn.join_dim(lg.select("row_id", "content_id"), q, "content_id", "question_id"), c, "content_id")


TAIL_SQL = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "timestamp" DESC, row_id DESC) AS tail_rank
  FROM interactions WHERE content_type_id = 0
)"""


@register("anti_split", with_views(f"""WITH {TAIL_SQL.strip()}
SELECT row_id, user_id FROM ranked r
WHERE NOT EXISTS (SELECT 1 FROM ranked v WHERE v.tail_rank <= 5 AND v.row_id = r.row_id)""", "interactions"))
def anti_split(spark, sf):
    q = _qrows(spark, sf)
    valid = sp.user_tail_split(q).filter(F.col("split") == "valid")
    return jn.anti_split(q, valid, "row_id").select("row_id", "user_id")


@register("attach_columns", with_views("""
SELECT row_id, user_id, CAST(content_type_id = 0 AS INTEGER) AS is_question,
       CAST(answered_correctly = 1 AS INTEGER) AS is_correct, "timestamp" // 86400000 AS day
FROM interactions""", "interactions"))
def attach_columns(spark, sf):
    return log(spark, sf).withColumns({
        "is_question": (F.col("content_type_id") == 0).cast("int"),
        "is_correct": (F.col("answered_correctly") == 1).cast("int"),
        "day": F.floor(F.col("timestamp") / 86_400_000).cast("long"),
    }).select("row_id", "user_id", "is_question", "is_correct", "day")
