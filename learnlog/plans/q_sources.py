"""Queries for sources and sinks (survey 2.1): CSV round trips of the
fixture views through the shared scratch folder, read back with schemas."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..oracle_views import test_batches_sql, with_views
from ..registry import register
from ..schema import INTERACTIONS, LECTURES, QUESTIONS, TEST_BATCHES
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources import io


def _csv(spark, df, name: str, schema=None, compress=False) -> str:
    """Write ``df`` as CSV in the shared scratch folder (columns in schema
    order: CSV readers map columns by position)."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    io.write_csv(df.select(*[f.name for f in schema.fields]) if schema else df, path, compress)
    return path


@register("scan_interactions", with_views("SELECT * FROM interactions", "interactions"))
def scan_interactions(spark, sf):
    return io.read_csv(spark, _csv(spark, fx.interactions(spark, sf), "log", INTERACTIONS), INTERACTIONS)


@register("scan_questions", with_views("SELECT question_id, part FROM questions", "questions"))
def scan_questions(spark, sf):
    return io.read_csv(spark, _csv(spark, fx.questions(spark, sf), "questions", QUESTIONS), QUESTIONS,
                       columns=["question_id", "part"])


@register("scan_lectures", with_views("SELECT * FROM lectures", "lectures"))
def scan_lectures(spark, sf):
    return io.read_csv(spark, _csv(spark, fx.lectures(spark, sf), "lectures", LECTURES), LECTURES)


@register("scan_test_batches", with_views(f"WITH {test_batches_sql().strip()}\nSELECT * FROM batches",
                                          "interactions"))
def scan_test_batches(spark, sf):
    # every row carries its batch's lists: kilobytes a row, which compressed files hold once
    return io.read_csv(spark, _csv(spark, fx.test_batches(spark, sf), "batches", TEST_BATCHES, compress=True), TEST_BATCHES)


@register("scan_inferred_csv", with_views("SELECT question_id, bundle_id, correct_answer, part, tags FROM questions", "questions"))
def scan_inferred_csv(spark, sf):
    # The reader infers integers; the casts only pin their width for the check.
    got = io.read_csv_inferred(spark, _csv(spark, fx.questions(spark, sf), "questions"))
    return got.select(*[F.col(c).cast("int").alias(c) for c in ("question_id", "bundle_id", "correct_answer", "part")], "tags")


@register("cast_schema", with_views("SELECT * FROM interactions", "interactions"))
def cast_schema(spark, sf):
    raw = io.read_csv_text(spark, _csv(spark, fx.interactions(spark, sf), "log"))
    return io.cast_schema(raw, INTERACTIONS)
