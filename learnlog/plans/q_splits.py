"""Queries for splits (survey 2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import splits as sp
from ..oracle_views import with_views
from ..registry import register
from .common import log
from .q_joins import TAIL_SQL


def _qrows(spark, sf):
    return log(spark, sf).filter(F.col("content_type_id") == 0)


@register("user_tail_split", with_views(f"""WITH {TAIL_SQL.strip()}
SELECT row_id, user_id, CAST(tail_rank AS BIGINT) AS tail_rank,
       CASE WHEN tail_rank <= 5 THEN 'valid' WHEN tail_rank <= 23 THEN 'train' ELSE 'history' END AS split
FROM ranked""", "interactions"))
def user_tail_split(spark, sf):
    return sp.user_tail_split(_qrows(spark, sf)).select("row_id", "user_id", "tail_rank", "split")


@register("ordered_split", with_views("""
SELECT row_id, CASE WHEN pos < n - CAST(ceil(0.2 * n) AS BIGINT) THEN 'train' ELSE 'valid' END AS split
FROM (SELECT row_id, row_number() OVER (ORDER BY "timestamp", row_id) - 1 AS pos, count(*) OVER () AS n
      FROM interactions) t""", "interactions"))
def ordered_split(spark, sf):
    return sp.ordered_split(log(spark, sf)).select("row_id", "split")


@register("random_split", with_views("""
SELECT row_id, CASE WHEN b < 800 THEN 'train' WHEN b < 900 THEN 'valid' ELSE 'test' END AS split
FROM (SELECT row_id, CAST('0x' || substr(md5(CAST(row_id AS VARCHAR) || ':42'), 1, 8) AS BIGINT) % 1000 AS b
      FROM interactions) t""", "interactions"))
def random_split(spark, sf):
    return sp.random_split(log(spark, sf)).select("row_id", "split")


@register("row_counts", with_views(f"""WITH {TAIL_SQL.strip()}
SELECT split, count(*) AS n FROM (
  SELECT CASE WHEN tail_rank <= 5 THEN 'valid' WHEN tail_rank <= 23 THEN 'train' ELSE 'history' END AS split
  FROM ranked) t GROUP BY split
UNION ALL SELECT 'all' AS split, count(*) AS n FROM ranked""", "interactions"))
def row_counts(spark, sf):
    # one pass: each row counts for its split and for all
    s = sp.user_tail_split(_qrows(spark, sf))
    return (s.select(F.explode(F.array("split", F.lit("all"))).alias("split"))
             .groupBy("split").agg(F.count(F.lit(1)).alias("n")))


@register("nested_horizon_stats", with_views(f"""WITH {TAIL_SQL.strip()},
wo_valid AS (SELECT user_id, avg(answered_correctly) AS a, avg(CAST(coalesce(prior_question_had_explanation, false) AS INTEGER)) AS e
             FROM ranked WHERE tail_rank > 5 GROUP BY user_id),
hist AS (SELECT user_id, avg(answered_correctly) AS a, avg(CAST(coalesce(prior_question_had_explanation, false) AS INTEGER)) AS e
         FROM ranked WHERE tail_rank > 23 GROUP BY user_id)
SELECT r.row_id, r.user_id, 'valid' AS split, w.a AS answered_correctly_user, w.e AS explanation_mean_user
FROM ranked r LEFT JOIN wo_valid w ON r.user_id = w.user_id WHERE r.tail_rank <= 5
UNION ALL
SELECT r.row_id, r.user_id, 'train' AS split, h.a AS answered_correctly_user, h.e AS explanation_mean_user
FROM ranked r LEFT JOIN hist h ON r.user_id = h.user_id WHERE r.tail_rank > 5 AND r.tail_rank <= 23""",
    "interactions"))
def nested_horizon_stats(spark, sf):
    return sp.nested_horizon_stats(_qrows(spark, sf)).select(
        "row_id", "user_id", "split", "answered_correctly_user", "explanation_mean_user")
