"""Equi left joins of the log to dimensions and to aggregate tables.

Every join in the reference is a left join on one key. Nothing is hinted:
adaptive execution broadcasts a side that its measured bytes show to be small
and sort-merges it otherwise, with skew-join splitting for hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_dim(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
             how: str = "left", keep_key: bool = False) -> DataFrame:
    """Left join a dimension on ``fact_key = dim_key``."""
    if fact_key == dim_key:
        return fact.join(dim, fact_key, how)
    out = fact.join(dim, fact[fact_key] == dim[dim_key], how)
    return out if keep_key else out.drop(dim[dim_key])


def join_stats(fact: DataFrame, stats: DataFrame, keys: str | list[str],
               how: str = "left") -> DataFrame:
    """Attach an aggregate table (one row per key) back to the rows."""
    return fact.join(stats, keys, how)


def attach_question_dim(log: DataFrame, questions: DataFrame, cols=("part",)) -> DataFrame:
    """join_question_dim: content_id = question_id, left; question_id kept."""
    q = questions.select("question_id", *cols)
    return join_dim(log, q, "content_id", "question_id", keep_key=True)


def attach_lecture_dim(log: DataFrame, lectures: DataFrame, cols=("tag", "part", "type_of")) -> DataFrame:
    l = lectures.select("lecture_id", *[F.col(c).alias(f"lecture_{c}") for c in cols])
    return join_dim(log, l, "content_id", "lecture_id", keep_key=True)


def anti_split(rows: DataFrame, other: DataFrame, key: str = "row_id") -> DataFrame:
    """Rows whose key is not in ``other`` (``~isin``)."""
    return rows.join(other.select(key), key, "left_anti")
