"""Shared inputs of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import attach_question_dim
from ..sources import fixtures as fx


def log(spark: SparkSession, sf: str) -> DataFrame:
    return fx.interactions(spark, sf)


def question_rows(spark: SparkSession, sf: str, cols=("part",)) -> DataFrame:
    """Question rows of the log with the question dimension attached (left)."""
    q = log(spark, sf).filter(F.col("content_type_id") == 0)
    return attach_question_dim(q, fx.questions(spark, sf), cols)


# SQL of the same input, for oracles.
QUESTION_ROWS_SQL = """
qrows AS (
  SELECT i.*, qs.question_id, qs.part
  FROM interactions i LEFT JOIN questions qs ON i.content_id = qs.question_id
  WHERE i.content_type_id = 0
)"""
