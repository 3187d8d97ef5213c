"""Queries for the lecture / question history loop (survey 2.5, 2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as sc
from ..operators import lectures as lec
from ..operators import stats as st
from ..operators.history import user_relative_time
from ..operators.joins import join_stats
from ..oracle_views import std_int_sql, with_views
from ..registry import register
from ..schema import PARTS
from ..sources import fixtures as fx
from .common import log

ROWS_SQL = """
lrows AS (
  SELECT i.*, q.part AS q_part, q.tags AS q_tags, l.tag AS l_tag, l.part AS l_part
  FROM interactions i
  LEFT JOIN questions q ON i.content_type_id = 0 AND i.content_id = q.question_id
  LEFT JOIN lectures l ON i.content_type_id = 1 AND i.content_id = l.lecture_id
)"""
WI = 'PARTITION BY user_id ORDER BY "timestamp", row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW'
EARLIER = '(l."timestamp" < r."timestamp" OR (l."timestamp" = r."timestamp" AND l.row_id < r.row_id))'


def _sql(body: str) -> str:
    return with_views(f"WITH {ROWS_SQL.strip()}\n{body}", "interactions", "questions", "lectures")


def _rows(spark, sf):
    return lec.with_dims(log(spark, sf), fx.questions(spark, sf), fx.lectures(spark, sf))


_PART_SEEN_SQL = ",\n".join(
    f"CAST(sum(CASE WHEN content_type_id = 0 AND q_part = {p} THEN 1 ELSE 0 END) OVER ({WI}) AS BIGINT)"
    f" AS part{p}_seen" for p in PARTS)
COUNTER_COLS = ["num_lecture_seen", "num_question_seen"] + [f"part{p}_seen" for p in PARTS]


@register("num_lecture_seen", _sql(f"""
SELECT row_id, user_id, CAST(sum(content_type_id) OVER ({WI}) AS BIGINT) AS num_lecture_seen FROM lrows"""))
def num_lecture_seen(spark, sf):
    return lec.lecture_counters(_rows(spark, sf)).select("row_id", "user_id", "num_lecture_seen")


@register("num_question_seen", _sql(f"""
SELECT row_id, user_id, CAST(sum(1 - content_type_id) OVER ({WI}) AS BIGINT) AS num_question_seen FROM lrows"""))
def num_question_seen(spark, sf):
    return lec.lecture_counters(_rows(spark, sf)).select("row_id", "user_id", "num_question_seen")


@register("part_seen_counts", _sql(f"SELECT row_id, user_id, {_PART_SEEN_SQL} FROM lrows"))
def part_seen_counts(spark, sf):
    return lec.lecture_counters(_rows(spark, sf)).select(
        "row_id", "user_id", *[f"part{p}_seen" for p in PARTS])


TAGS_MATCH_SQL = f"""
tm AS (
  SELECT r.row_id, count(l.row_id) AS num_tags_match
  FROM lrows r LEFT JOIN lrows l
    ON l.user_id = r.user_id AND l.content_type_id = 1 AND {EARLIER}
   AND list_contains(list_distinct(CAST(string_split(trim(r.q_tags), ' ') AS INTEGER[])), l.l_tag)
  WHERE r.content_type_id = 0
  GROUP BY r.row_id
)"""


@register("num_tags_match", _sql(f""", {TAGS_MATCH_SQL.strip()}
SELECT row_id, num_tags_match FROM tm"""))
def num_tags_match(spark, sf):
    return (lec.num_tags_match(_rows(spark, sf), log=log(spark, sf)).filter(F.col("content_type_id") == 0)
            .select("row_id", "num_tags_match"))


PART_MATCH_SQL = f"""
SELECT r.row_id,
       CASE WHEN EXISTS (SELECT 1 FROM lrows l WHERE l.user_id = r.user_id AND l.content_type_id = 1
                         AND l.l_part = r.q_part AND {EARLIER}) THEN 1 ELSE 0 END AS part_matches
FROM lrows r WHERE r.content_type_id = 0"""


@register("part_matches", _sql(PART_MATCH_SQL))
def part_matches(spark, sf):
    return (lec.part_matches(_rows(spark, sf)).filter(F.col("content_type_id") == 0)
            .select("row_id", "part_matches"))


def _latest_sql(condition: str) -> str:
    return f"""SELECT r.row_id, l.content_id AS lid, l."timestamp" AS ts
  FROM lrows r JOIN lrows l ON l.user_id = r.user_id AND l.content_type_id = 1 AND {EARLIER} AND {condition}
  WHERE r.content_type_id = 0
  QUALIFY row_number() OVER (PARTITION BY r.row_id ORDER BY l."timestamp" DESC, l.row_id DESC) = 1"""


@register("asof_prior_match", _sql(f""",
bytag AS ({_latest_sql("list_contains(CAST(string_split(trim(r.q_tags), ' ') AS INTEGER[]), l.l_tag)")}),
bypart AS ({_latest_sql("l.l_part = r.q_part")})
SELECT lrows.row_id, user_id,
       last_value(CASE WHEN content_type_id = 1 THEN content_id END IGNORE NULLS) OVER w AS prev_lecture_id,
       last_value(CASE WHEN content_type_id = 1 THEN "timestamp" END IGNORE NULLS) OVER w AS prev_lecture_ts,
       t.lid AS prev_tag_lecture_id, t.ts AS prev_tag_lecture_ts, p.lid AS prev_part_lecture_id, p.ts AS prev_part_lecture_ts
FROM lrows LEFT JOIN bytag t ON lrows.row_id = t.row_id LEFT JOIN bypart p ON lrows.row_id = p.row_id
WINDOW w AS (PARTITION BY user_id ORDER BY "timestamp", lrows.row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""))
def asof_prior_match(spark, sf):
    out = lec.last_matching_lectures(log(spark, sf), fx.questions(spark, sf), fx.lectures(spark, sf))
    return out.select("row_id", "user_id", *(f"{m}_{c}" for m in lec.MATCHES for c in ("id", "ts")))


HISTORY_COLS = ["row_id", "user_id", "content_id"] + COUNTER_COLS + ["num_tags_match", "part_matches"]


HISTORY_SQL = f"""{TAGS_MATCH_SQL.strip()},
counters AS (
  SELECT row_id, user_id, content_id, content_type_id, q_part,
         CAST(sum(content_type_id) OVER ({WI}) AS BIGINT) AS num_lecture_seen,
         CAST(sum(1 - content_type_id) OVER ({WI}) AS BIGINT) AS num_question_seen,
         {_PART_SEEN_SQL}
  FROM lrows
),
pm AS ({PART_MATCH_SQL}),
hist AS (
  SELECT c.row_id, c.user_id, c.content_id, {", ".join("c." + x for x in COUNTER_COLS)},
         tm.num_tags_match, pm.part_matches
  FROM counters c JOIN tm ON c.row_id = tm.row_id JOIN pm ON c.row_id = pm.row_id
  WHERE c.content_type_id = 0
)"""


@register("lecture_history", _sql(f", {HISTORY_SQL}\nSELECT * FROM hist"))
def lecture_history(spark, sf):
    return (lec.lecture_history(log(spark, sf), fx.questions(spark, sf), fx.lectures(spark, sf))
            .select(*HISTORY_COLS))


STD = std_int_sql("answered_correctly")


@register("plan_b_features", _sql(f""", {HISTORY_SQL},
qonly AS (SELECT * FROM interactions WHERE content_type_id = 0),
qt AS (SELECT content_id, avg(answered_correctly) AS question_mean_acc, {STD} AS question_std_acc, count(*) AS question_count
       FROM qonly GROUP BY content_id),
tt AS (SELECT task_container_id, avg(answered_correctly) AS task_mean_acc, {STD} AS task_std_acc, count(*) AS task_count
       FROM qonly GROUP BY task_container_id)
SELECT h.row_id, {", ".join("h." + x for x in COUNTER_COLS)}, h.num_tags_match, h.part_matches,
       ln(greatest(q."timestamp" - min(q."timestamp") OVER (PARTITION BY q.user_id), 1)) AS log_relative_time,
       ln(greatest(coalesce(q.prior_question_elapsed_time, avg(q.prior_question_elapsed_time) OVER ()), 1)) AS log_elapsed,
       qt.question_mean_acc, qt.question_std_acc, qt.question_count, qs.part, tt.task_mean_acc, tt.task_std_acc, tt.task_count
FROM hist h JOIN qonly q ON h.row_id = q.row_id LEFT JOIN qt ON q.content_id = qt.content_id
LEFT JOIN questions qs ON q.content_id = qs.question_id LEFT JOIN tt ON q.task_container_id = tt.task_container_id"""))
def plan_b_features(spark, sf):
    """Plan B end to end: lecture history, relative and elapsed time, question and container statistics."""
    hist = lec.lecture_history(log(spark, sf), fx.questions(spark, sf), fx.lectures(spark, sf))
    q = sc.fill_mean(user_relative_time(hist), ["prior_question_elapsed_time"])
    y = {"mean_acc": F.avg("answered_correctly"), "std_acc": st.std_int("answered_correctly"), "count": F.count(F.lit(1))}
    for key, name in (("content_id", "question"), ("task_container_id", "task")):
        q = join_stats(q, st.named_stats(hist, key, {f"{name}_{k}": c for k, c in y.items()}), key)
    return q.select("row_id", *COUNTER_COLS, "num_tags_match", "part_matches", sc.log_clip("relative_time").alias("log_relative_time"),
                    sc.log_clip("prior_question_elapsed_time").alias("log_elapsed"), "question_mean_acc", "question_std_acc",
                    "question_count", F.col("_q_part").alias("part"), "task_mean_acc", "task_std_acc", "task_count")
