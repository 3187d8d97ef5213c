"""Queries for the causal history features (survey 2.5)."""

from __future__ import annotations


from ..operators import history as h
from ..oracle_views import with_views
from ..registry import register
from ..sources import fixtures as fx
from .common import QUESTION_ROWS_SQL, log, question_rows

W_U = 'PARTITION BY user_id ORDER BY "timestamp", row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING'
W_P = ('PARTITION BY user_id, coalesce(part, -1) ORDER BY "timestamp", row_id '
       'ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING')


def _q(sql: str) -> str:
    return with_views(f"WITH {QUESTION_ROWS_SQL.strip()}\n{sql}", "interactions", "questions")


@register("user_prior_sum", _q(f"""
SELECT row_id, user_id,
       CAST(coalesce(sum(answered_correctly) OVER ({W_U}), 0) AS BIGINT) AS answered_correctly_sum_u
FROM qrows"""))
def user_prior_sum(spark, sf):
    return h.user_prior(question_rows(spark, sf)).select("row_id", "user_id", "answered_correctly_sum_u")


@register("user_prior_count", _q(f"""
SELECT row_id, user_id, count(*) OVER ({W_U}) AS count_u FROM qrows"""))
def user_prior_count(spark, sf):
    return h.user_prior(question_rows(spark, sf)).select("row_id", "user_id", "count_u")


@register("user_prior_mean", _q(f"""
SELECT row_id, user_id,
       CAST(sum(answered_correctly) OVER ({W_U}) AS DOUBLE) / nullif(count(*) OVER ({W_U}), 0)
         AS answered_correctly_avg_u
FROM qrows"""))
def user_prior_mean(spark, sf):
    return h.user_prior(question_rows(spark, sf)).select("row_id", "user_id", "answered_correctly_avg_u")


@register("first_time", _q("""
SELECT row_id, user_id, content_id,
       CASE WHEN row_number() OVER (PARTITION BY user_id, content_id ORDER BY "timestamp", row_id) = 1
            THEN 1 ELSE 0 END AS first_time
FROM qrows"""))
def first_time(spark, sf):
    return h.first_time(question_rows(spark, sf)).select("row_id", "user_id", "content_id", "first_time")


@register("user_part_prior", _q(f"""
SELECT row_id, user_id, part,
       CAST(coalesce(sum(answered_correctly) OVER ({W_P}), 0) AS BIGINT) AS part_sum_u,
       count(*) OVER ({W_P}) AS part_count_u,
       CAST(sum(answered_correctly) OVER ({W_P}) AS DOUBLE) / nullif(count(*) OVER ({W_P}), 0) AS part_avg_u
FROM qrows"""))
def user_part_prior(spark, sf):
    return (h.user_part_prior(question_rows(spark, sf))
            .select("row_id", "user_id", "part", "part_sum_u", "part_count_u", "part_avg_u"))


ADD_USER_FEATS_COLS = ["row_id", "user_id", "content_id", "part", "answered_correctly",
                       "answered_correctly_sum_u", "count_u", "answered_correctly_avg_u",
                       "part_sum_u", "part_count_u", "part_avg_u", "first_time"]

ADD_USER_FEATS_SQL = f"""
SELECT row_id, user_id, content_id, part, answered_correctly,
       CAST(coalesce(sum(answered_correctly) OVER ({W_U}), 0) AS BIGINT) AS answered_correctly_sum_u,
       count(*) OVER ({W_U}) AS count_u,
       CAST(sum(answered_correctly) OVER ({W_U}) AS DOUBLE) / nullif(count(*) OVER ({W_U}), 0)
         AS answered_correctly_avg_u,
       CAST(coalesce(sum(answered_correctly) OVER ({W_P}), 0) AS BIGINT) AS part_sum_u,
       count(*) OVER ({W_P}) AS part_count_u,
       CAST(sum(answered_correctly) OVER ({W_P}) AS DOUBLE) / nullif(count(*) OVER ({W_P}), 0) AS part_avg_u,
       CASE WHEN row_number() OVER (PARTITION BY user_id, content_id ORDER BY "timestamp", row_id) = 1
            THEN 1 ELSE 0 END AS first_time
FROM qrows"""


@register("add_user_feats", _q(ADD_USER_FEATS_SQL))
def add_user_feats(spark, sf):
    return h.add_user_feats(question_rows(spark, sf)).select(*ADD_USER_FEATS_COLS)


# Container grain (D4) on the larger order log: frame ends at container - 1.
WC = 'ORDER BY task_container_id RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING'


@register("add_user_feats_container", with_views(f"""
SELECT user_id, task_container_id, content_id, answered_correctly,
       CAST(coalesce(sum(answered_correctly) OVER (PARTITION BY user_id {WC}), 0) AS BIGINT)
         AS answered_correctly_sum_u,
       count(*) OVER (PARTITION BY user_id {WC}) AS count_u,
       CAST(sum(answered_correctly) OVER (PARTITION BY user_id {WC}) AS DOUBLE)
         / nullif(count(*) OVER (PARTITION BY user_id {WC}), 0) AS answered_correctly_avg_u,
       CASE WHEN count(*) OVER (PARTITION BY user_id, content_id {WC}) = 0 THEN 1 ELSE 0 END AS first_time
FROM order_log""", "order_log"))
def add_user_feats_container(spark, sf):
    return (h.add_user_feats(fx.order_log(spark, sf), grain="container", with_part=False)
            .select("user_id", "task_container_id", "content_id", "answered_correctly",
                    "answered_correctly_sum_u", "count_u", "answered_correctly_avg_u", "first_time"))


@register("recent_mean", _q(f"""
SELECT row_id, user_id,
       avg(answered_correctly) OVER (PARTITION BY user_id ORDER BY "timestamp", row_id
                                     ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS recent_mean_5
FROM qrows"""))
def recent_mean(spark, sf):
    return h.recent_mean(question_rows(spark, sf), 5).select("row_id", "user_id", "recent_mean_5")


@register("user_change", with_views("""
SELECT row_id, user_id,
       CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY "timestamp", row_id) = 1 THEN 1 ELSE 0 END
         AS user_change
FROM interactions""", "interactions"))
def user_change(spark, sf):
    return h.user_change(log(spark, sf)).select("row_id", "user_id", "user_change")


@register("time_diff", with_views("""
SELECT row_id, user_id,
       CAST(coalesce("timestamp" - lag("timestamp") OVER (PARTITION BY user_id ORDER BY "timestamp", row_id), 0)
            AS BIGINT) AS time_diff
FROM interactions""", "interactions"))
def time_diff(spark, sf):
    return h.time_diff(log(spark, sf)).select("row_id", "user_id", "time_diff")


@register("user_relative_time", _q("""
SELECT row_id, user_id, CAST("timestamp" - min("timestamp") OVER (PARTITION BY user_id) AS BIGINT) AS relative_time
FROM qrows"""))
def user_relative_time(spark, sf):
    return h.user_relative_time(question_rows(spark, sf)).select("row_id", "user_id", "relative_time")


@register("answer_time", with_views("""
SELECT row_id, user_id,
       lead(prior_question_elapsed_time) OVER (PARTITION BY user_id ORDER BY "timestamp", row_id) AS answer_time
FROM interactions""", "interactions"))
def answer_time(spark, sf):
    return h.answer_time(log(spark, sf)).select("row_id", "user_id", "answer_time")
