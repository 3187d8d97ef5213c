"""Queries for scalar functions (survey 2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as sc
from ..functions.quantiles import quantiles
from ..operators.history import user_relative_time
from ..operators.lectures import parse_tags
from ..oracle_views import with_views
from ..registry import register
from ..sources import fixtures as fx
from .common import log
from .q_relational import _DUMMY_SQL, lecture_dummies

_TAGS_SQL = ", ".join(f"TRY_CAST(string_split(tags, ' ')[{i + 1}] AS INTEGER) AS tags{i + 1}" for i in range(6))


@register("split_tags_columns", with_views(f"SELECT question_id, {_TAGS_SQL} FROM questions", "questions"))
def split_tags_columns(spark, sf):
    return fx.questions(spark, sf).select("question_id", *sc.split_tags_columns("tags"))


@register("to_numeric_coerce", with_views("""
SELECT question_id, TRY_CAST(tags AS DOUBLE) AS tags_num, TRY_CAST(string_split(tags, ' ')[1] AS DOUBLE) AS first_tag
FROM questions""", "questions"))
def to_numeric_coerce(spark, sf):
    q = fx.questions(spark, sf)
    return q.select("question_id", sc.to_numeric("tags").alias("tags_num"),
                    sc.to_numeric(F.get(F.split("tags", " "), 0)).alias("first_tag"))


@register("parse_tag_array", with_views("""
SELECT question_id, CAST(string_split(trim(tags), ' ') AS INTEGER[]) AS tag_list FROM questions""", "questions"))
def parse_tag_array(spark, sf):
    return fx.questions(spark, sf).select("question_id", parse_tags("tags").alias("tag_list"))


# Tags are 1..82 by the definition of the question view: one column each.
TAG_DOMAIN = range(1, 83)
_TAG_COLS = ", ".join(f"CAST(coalesce(list_contains(CAST(string_split(trim(tags), ' ') AS INTEGER[]), {t}), false) AS INTEGER) AS tag_{t}"
                      for t in TAG_DOMAIN)


@register("tag_dummies", with_views(f"SELECT question_id, {_TAG_COLS} FROM questions", "questions"))
def tag_dummies(spark, sf):
    return fx.questions(spark, sf).select("question_id", *sc.tag_dummies("tags", TAG_DOMAIN))


@register("one_hot", with_views(f"SELECT lecture_id, tag, {_DUMMY_SQL} FROM lectures", "lectures"))
def one_hot(spark, sf):
    return lecture_dummies(spark, sf)


@register("replace_value", with_views(
    "SELECT lecture_id, replace(type_of, 'solving question', 'solving_question') AS type_of FROM lectures",
    "lectures"))
def replace_value(spark, sf):
    return fx.lectures(spark, sf).select(
        "lecture_id", sc.replace_value("type_of", "solving question", "solving_question").alias("type_of"))


@register("log_clip", with_views("""
SELECT row_id,
       ln(greatest("timestamp" - min("timestamp") OVER (PARTITION BY user_id), 1)) AS log_relative_time,
       ln(greatest(coalesce(prior_question_elapsed_time, avg(prior_question_elapsed_time) OVER ()), 1))
         AS log_elapsed
FROM interactions WHERE content_type_id = 0""", "interactions"))
def log_clip(spark, sf):
    q = user_relative_time(log(spark, sf).filter(F.col("content_type_id") == 0))
    q = sc.fill_mean(q, ["prior_question_elapsed_time"])
    return q.select("row_id", sc.log_clip("relative_time").alias("log_relative_time"),
                    sc.log_clip("prior_question_elapsed_time").alias("log_elapsed"))


@register("fill_mean", with_views("""
SELECT row_id, coalesce(prior_question_elapsed_time, avg(prior_question_elapsed_time) OVER ()) AS prior_question_elapsed_time
FROM interactions""", "interactions"))
def fill_mean(spark, sf):
    return sc.fill_mean(log(spark, sf), ["prior_question_elapsed_time"]).select(
        "row_id", "prior_question_elapsed_time")


@register("fill_const", with_views("""
SELECT row_id, coalesce(prior_question_elapsed_time, 0.5) AS prior_question_elapsed_time,
       coalesce(prior_question_had_explanation, false) AS prior_question_had_explanation
FROM interactions""", "interactions"))
def fill_const(spark, sf):
    return sc.fill_const(log(spark, sf), {"prior_question_elapsed_time": 0.5,
                                          "prior_question_had_explanation": False}).select(
        "row_id", "prior_question_elapsed_time", "prior_question_had_explanation")


@register("fill_token", with_views("SELECT question_id, coalesce(tags, 'missing') AS tags FROM questions",
                                   "questions"))
def fill_token(spark, sf):
    return fx.questions(spark, sf).select("question_id", sc.fill_token("tags").alias("tags"))


@register("bool_to_int", with_views("""
SELECT row_id, CAST(coalesce(prior_question_had_explanation, false) AS INTEGER) AS prior_question_had_explanation_enc
FROM interactions""", "interactions"))
def bool_to_int(spark, sf):
    return log(spark, sf).select("row_id", sc.bool_to_int("prior_question_had_explanation")
                                 .alias("prior_question_had_explanation_enc"))


@register("round_rate", with_views("""
SELECT content_id,
       CAST(round_even(CAST(avg(answered_correctly) AS DECIMAL(18, 9)), 5) AS DOUBLE) AS rate5,
       CAST(round_even(CAST(avg(answered_correctly) AS DECIMAL(18, 6)), 2) AS DOUBLE) AS rate2
FROM interactions WHERE content_type_id = 0 GROUP BY content_id""", "interactions"))
def round_rate(spark, sf):
    g = (log(spark, sf).filter(F.col("content_type_id") == 0).groupBy("content_id")
         .agg(F.avg("answered_correctly").alias("r")))
    return g.select("content_id", sc.round_half_even("r", 5).alias("rate5"),
                    sc.round_half_even("r", 2).alias("rate2"))


@register("smooth_rate", with_views("""
SELECT question_id,
       CASE WHEN n < 3 OR n IS NULL THEN 0.65 WHEN r < 0.2 AND n < 21 THEN 0.2 WHEN r > 0.95 AND n < 21 THEN 0.95
            ELSE r END AS quest_pct
FROM questions q LEFT JOIN (
  SELECT content_id, avg(answered_correctly) AS r, count(*) AS n
  FROM interactions WHERE content_type_id = 0 GROUP BY content_id) s
  ON q.question_id = s.content_id""", "interactions", "questions"))
def smooth_rate(spark, sf):
    # The reference smooths the question table after a left join, so a
    # question never answered has count NULL; pandas' mask leaves it NaN and
    # the later fill gives 0.65, which is what the first branch does here.
    q = log(spark, sf).filter(F.col("content_type_id") == 0)
    s = q.groupBy("content_id").agg(F.avg("answered_correctly").alias("r"), F.count(F.lit(1)).alias("n"))
    dim = fx.questions(spark, sf).select("question_id")
    j = dim.join(s, dim.question_id == s.content_id, "left")
    return j.select("question_id", F.coalesce(sc.smooth_rate("r", F.coalesce("n", F.lit(0))),
                                              F.lit(0.65)).cast("double").alias("quest_pct"))


@register("cap_container", with_views("""
SELECT row_id, least(task_container_id, 9999) AS task_container_id FROM interactions""", "interactions"))
def cap_container(spark, sf):
    return log(spark, sf).select("row_id", sc.cap_container().alias("task_container_id"))


@register("shift_part", with_views("SELECT question_id, part - 1 AS part FROM questions", "questions"))
def shift_part(spark, sf):
    return fx.questions(spark, sf).select("question_id", sc.shift_part().alias("part"))


@register("quantile_flag", with_views("""
SELECT row_id, CAST("timestamp" > (SELECT quantile_cont("timestamp", 0.11) FROM interactions) AS INTEGER) AS ts_flag
FROM interactions""", "interactions"))
def quantile_flag(spark, sf):
    lg = log(spark, sf)
    q11, = quantiles(lg, "timestamp", [0.11])
    return lg.select("row_id", (F.col("timestamp") > F.lit(q11)).cast("int").alias("ts_flag"))

