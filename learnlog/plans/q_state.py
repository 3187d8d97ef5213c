"""Queries for saved features and history state (survey 2.1, 2.5)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import history as h
from ..operators import splits as sp
from ..operators import state as stt
from ..oracle_views import with_views
from ..registry import register
from ..session import scratch_path
from ..sources import io
from .common import QUESTION_ROWS_SQL, question_rows
from .q_history import ADD_USER_FEATS_COLS, ADD_USER_FEATS_SQL

SPLIT_SQL = """
qs AS (SELECT q.*, row_number() OVER (ORDER BY "timestamp", row_id) - 1 AS pos, count(*) OVER () AS n FROM qrows q),
train AS (SELECT * FROM qs WHERE pos < n - CAST(ceil(0.2 * n) AS BIGINT)),
valid AS (SELECT * FROM qs WHERE pos >= n - CAST(ceil(0.2 * n) AS BIGINT)),
us AS (SELECT user_id, CAST(sum(answered_correctly) AS BIGINT) AS s, count(*) AS c FROM train GROUP BY user_id),
ps AS (SELECT user_id, coalesce(part, -1) AS part_k, CAST(sum(answered_correctly) AS BIGINT) AS s, count(*) AS c
       FROM train GROUP BY ALL),
cs AS (SELECT DISTINCT user_id, content_id FROM train)"""


def _sql(body: str) -> str:
    return with_views(f"WITH {QUESTION_ROWS_SQL.strip()},\n{SPLIT_SQL.strip()}\n{body}", "interactions", "questions")


def train_valid(spark, sf):
    """Train / valid question rows of the ordered split. The split is written
    once as a table under spark.checkpoint.dir (cutting lineage), so the train
    and valid branches read it instead of each re-running the position pass."""
    path = scratch_path(spark, f"split-{uuid.uuid4().hex}")
    io.write_features(sp.ordered_split(question_rows(spark, sf)), path)
    s = io.read_features(spark, path)
    return s.filter(F.col("split") == "train").drop("split"), s.filter(F.col("split") == "valid").drop("split")


FROZEN_COLS = ["row_id", "user_id", "content_id", "answered_correctly_sum_u", "count_u", "answered_correctly_avg_u",
               "part_sum_u", "part_count_u", "part_avg_u", "first_time"]


@register("apply_frozen_state", _sql("""
SELECT v.row_id, v.user_id, v.content_id,
       coalesce(us.s, 0) AS answered_correctly_sum_u, coalesce(us.c, 0) AS count_u,
       CAST(coalesce(us.s, 0) AS DOUBLE) / nullif(coalesce(us.c, 0), 0) AS answered_correctly_avg_u,
       coalesce(ps.s, 0) AS part_sum_u, coalesce(ps.c, 0) AS part_count_u,
       CAST(coalesce(ps.s, 0) AS DOUBLE) / nullif(coalesce(ps.c, 0), 0) AS part_avg_u,
       CASE WHEN cs.user_id IS NULL THEN 1 ELSE 0 END AS first_time
FROM valid v
LEFT JOIN us ON v.user_id = us.user_id
LEFT JOIN ps ON v.user_id = ps.user_id AND coalesce(v.part, -1) = ps.part_k
LEFT JOIN cs ON v.user_id = cs.user_id AND v.content_id = cs.content_id"""))
def apply_frozen_state(spark, sf):
    train, valid = train_valid(spark, sf)
    return stt.apply_frozen_state(valid, stt.build_state(train)).select(*FROZEN_COLS)


@register("update_state", with_views(f"""WITH {QUESTION_ROWS_SQL.strip()}
SELECT user_id, CAST(sum(answered_correctly) AS BIGINT) AS answered_correctly_sum_u, count(*) AS count_u
FROM qrows GROUP BY user_id""", "interactions", "questions"))
def update_state(spark, sf):
    train, valid = train_valid(spark, sf)
    return stt.update_state(stt.build_state(train), valid).user


def _saved_state(spark, sf):
    train, _ = train_valid(spark, sf)
    path = scratch_path(spark, f"state-{uuid.uuid4().hex}")
    stt.save_state(stt.build_state(train), path)
    return stt.load_state(spark, path)


@register("save_state", _sql("SELECT user_id, s AS answered_correctly_sum_u, c AS count_u FROM us"))
def save_state(spark, sf):
    return _saved_state(spark, sf).user


@register("load_state", _sql("SELECT user_id, part_k, s AS part_sum_u, c AS part_count_u FROM ps"))
def load_state(spark, sf):
    return _saved_state(spark, sf).user_part


@register("add_user_feats_valid_updated", with_views(f"""WITH {QUESTION_ROWS_SQL.strip()},
feats AS ({ADD_USER_FEATS_SQL}),
qs AS (SELECT row_id, row_number() OVER (ORDER BY "timestamp", row_id) - 1 AS pos, count(*) OVER () AS n FROM qrows)
SELECT {", ".join("f." + c for c in FROZEN_COLS)}
FROM feats f JOIN qs ON f.row_id = qs.row_id
WHERE qs.pos >= qs.n - CAST(ceil(0.2 * qs.n) AS BIGINT)""", "interactions", "questions"))
def add_user_feats_valid_updated(spark, sf):
    train, valid = train_valid(spark, sf)
    return stt.add_user_feats_continued(train, valid).select(*FROZEN_COLS)


def _written_features(spark, sf):
    path = scratch_path(spark, f"features-{uuid.uuid4().hex}")
    io.write_features(h.add_user_feats(question_rows(spark, sf)).select(*ADD_USER_FEATS_COLS), path)
    return path


@register("write_features", with_views(f"WITH {QUESTION_ROWS_SQL.strip()}\n{ADD_USER_FEATS_SQL}",
                                       "interactions", "questions"))
def write_features(spark, sf):
    return io.read_features(spark, _written_features(spark, sf))


@register("read_features", with_views(f"""WITH {QUESTION_ROWS_SQL.strip()},
feats AS ({ADD_USER_FEATS_SQL})
SELECT row_id, count_u, first_time FROM feats WHERE first_time = 1""", "interactions", "questions"))
def read_features(spark, sf):
    f = io.read_features(spark, _written_features(spark, sf))
    return f.filter(F.col("first_time") == 1).select("row_id", "count_u", "first_time")


def _bucketed(spark, sf, buckets=8):
    """Question rows of the split and the state after its training rows, as tables bucketed by user."""
    name, path = f"learnlog_{uuid.uuid4().hex}", scratch_path(spark, f"bucketed-{uuid.uuid4().hex}")
    train, valid = train_valid(spark, sf)
    rows = io.write_bucketed(valid, f"{name}_valid", f"{path}/valid", order=("timestamp", "row_id"), buckets=buckets)
    return rows, stt.save_state_bucketed(stt.build_state(train), name, f"{path}/state", buckets)


@register("apply_bucketed_state", _sql("""
SELECT v.row_id, v.user_id, v.content_id,
       coalesce(us.s, 0) AS answered_correctly_sum_u, coalesce(us.c, 0) AS count_u,
       CAST(coalesce(us.s, 0) AS DOUBLE) / nullif(coalesce(us.c, 0), 0) AS answered_correctly_avg_u,
       coalesce(ps.s, 0) AS part_sum_u, coalesce(ps.c, 0) AS part_count_u,
       CAST(coalesce(ps.s, 0) AS DOUBLE) / nullif(coalesce(ps.c, 0), 0) AS part_avg_u,
       CASE WHEN cs.user_id IS NULL THEN 1 ELSE 0 END AS first_time
FROM valid v
LEFT JOIN us ON v.user_id = us.user_id
LEFT JOIN ps ON v.user_id = ps.user_id AND coalesce(v.part, -1) = ps.part_k
LEFT JOIN cs ON v.user_id = cs.user_id AND v.content_id = cs.content_id"""))
def apply_bucketed_state(spark, sf):
    return stt.apply_bucketed_state(*_bucketed(spark, sf)).select(*FROZEN_COLS)


@register("add_user_feats_bucketed", with_views(f"WITH {QUESTION_ROWS_SQL.strip()}\n{ADD_USER_FEATS_SQL}", "interactions", "questions"))
def add_user_feats_bucketed(spark, sf):
    name, path = f"learnlog_{uuid.uuid4().hex}", scratch_path(spark, f"bucketed-{uuid.uuid4().hex}")
    rows = io.write_bucketed(question_rows(spark, sf), name, path, order=("timestamp", "row_id"), buckets=8)
    return h.add_user_feats(rows).select(*ADD_USER_FEATS_COLS)
