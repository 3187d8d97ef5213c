"""Queries for projections, filters and sorts (survey 2.2, 2.6 sorts/limits)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import one_hot, replace_value
from ..operators import splits as sp
from ..oracle_views import with_views
from ..registry import register
from ..schema import LECTURE_TYPES, PARTS
from ..sources import fixtures as fx
from .common import log

FIELDS = ["row_id", "timestamp", "user_id", "content_id", "content_type_id", "answered_correctly",
          "prior_question_elapsed_time", "prior_question_had_explanation"]
_F = ", ".join(f'"{c}"' if c == "timestamp" else c for c in FIELDS)


def _i(sql: str, *extra) -> str:
    return with_views(sql, "interactions", *extra)


@register("project_fields", _i(f"SELECT {_F} FROM interactions"))
def project_fields(spark, sf):
    return log(spark, sf).select(*FIELDS)


@register("drop_columns", _i("SELECT * EXCLUDE (task_container_id, user_answer) FROM interactions"))
def drop_columns(spark, sf):
    return log(spark, sf).drop("task_container_id", "user_answer")


def lecture_dummies(spark, sf):
    """Lectures with type_of cleaned and one-hot part_* / type_of_* columns."""
    l = fx.lectures(spark, sf).withColumn("type_of", replace_value("type_of", "solving question",
                                                                    "solving_question"))
    return l.select("lecture_id", "tag", *one_hot("part", PARTS), *one_hot("type_of", LECTURE_TYPES))


_DUMMY_SQL = ", ".join(
    [f"CAST(part = {p} AS INTEGER) AS part_{p}" for p in PARTS]
    + [f"CAST(replace(type_of, 'solving question', 'solving_question') = '{t}' AS INTEGER) AS type_of_{t}"
       for t in LECTURE_TYPES])


@register("select_by_prefix", with_views(
    f"SELECT lecture_id, {', '.join(f'part_{p}' for p in PARTS)} FROM (SELECT lecture_id, {_DUMMY_SQL} FROM lectures) t",
    "lectures"))
def select_by_prefix(spark, sf):
    d = lecture_dummies(spark, sf)
    return d.select("lecture_id", *[c for c in d.columns if c.startswith("part")])


@register("rename_columns", _i("""
SELECT content_id AS cid, avg(answered_correctly) AS mean_acc, count(*) AS n
FROM interactions WHERE content_type_id = 0 GROUP BY content_id"""))
def rename_columns(spark, sf):
    g = (log(spark, sf).filter(F.col("content_type_id") == 0).groupBy("content_id")
         .agg(F.avg("answered_correctly"), F.count(F.lit(1))))
    return g.toDF("cid", "mean_acc", "n")


@register("filter_questions", _i("SELECT * FROM interactions WHERE content_type_id = 0"))
def filter_questions(spark, sf):
    return log(spark, sf).filter(F.col("content_type_id") == 0)


@register("filter_lectures", _i("SELECT * FROM interactions WHERE content_type_id = 1"))
def filter_lectures(spark, sf):
    return log(spark, sf).filter(F.col("content_type_id") == 1)


@register("filter_labelled", _i("SELECT * FROM interactions WHERE answered_correctly <> -1"))
def filter_labelled(spark, sf):
    return log(spark, sf).filter(F.col("answered_correctly") != -1)


@register("filter_probe", _i("""
SELECT CASE WHEN task_container_id = 0 THEN 'first_container' ELSE 'later' END AS probe,
       avg(answered_correctly) AS label_mean, count(*) AS n
FROM interactions WHERE content_type_id = 0 GROUP BY 1"""))
def filter_probe(spark, sf):
    q = log(spark, sf).filter(F.col("content_type_id") == 0)
    probe = F.when(F.col("task_container_id") == 0, "first_container").otherwise("later")
    return q.groupBy(probe.alias("probe")).agg(F.avg("answered_correctly").alias("label_mean"),
                                               F.count(F.lit(1)).alias("n"))


@register("split_label", _i("SELECT row_id, answered_correctly FROM interactions WHERE answered_correctly <> -1"))
def split_label(spark, sf):
    return log(spark, sf).filter(F.col("answered_correctly") != -1).select("row_id", "answered_correctly")


@register("sort_time", _i('SELECT * FROM interactions ORDER BY "timestamp", row_id'))
def sort_time(spark, sf):
    return log(spark, sf).orderBy("timestamp", "row_id")


@register("sort_user", _i("SELECT * FROM interactions ORDER BY user_id, row_id"))
def sort_user(spark, sf):
    return log(spark, sf).orderBy("user_id", "row_id")


@register("sort_user_time_desc", _i('SELECT * FROM interactions ORDER BY user_id DESC, "timestamp" DESC, row_id DESC'))
def sort_user_time_desc(spark, sf):
    return log(spark, sf).orderBy(F.col("user_id").desc(), F.col("timestamp").desc(), F.col("row_id").desc())


@register("sort_bins", _i("""
SELECT content_id, avg(answered_correctly) AS rate FROM interactions WHERE content_type_id = 0
GROUP BY content_id ORDER BY rate DESC, content_id"""))
def sort_bins(spark, sf):
    q = log(spark, sf).filter(F.col("content_type_id") == 0)
    return (q.groupBy("content_id").agg(F.avg("answered_correctly").alias("rate"))
             .orderBy(F.col("rate").desc(), "content_id"))


FIRST_N = 1000


@register("first_n", _i(f'SELECT * FROM interactions ORDER BY "timestamp", row_id LIMIT {FIRST_N}'))
def first_n(spark, sf):
    return sp.first_n(log(spark, sf), FIRST_N)


@register("skip_n", _i(f'SELECT * FROM interactions ORDER BY "timestamp", row_id OFFSET {FIRST_N}'))
def skip_n(spark, sf):
    return sp.skip_n(log(spark, sf), FIRST_N)


@register("last_n", _i(f'SELECT * FROM interactions ORDER BY "timestamp" DESC, row_id DESC LIMIT {FIRST_N}'))
def last_n(spark, sf):
    return sp.last_n(log(spark, sf), FIRST_N)


@register("peek", _i('SELECT * FROM interactions ORDER BY "timestamp", row_id LIMIT 5'))
def peek(spark, sf):
    return sp.first_n(log(spark, sf), 5)
