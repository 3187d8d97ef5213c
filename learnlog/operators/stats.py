"""Aggregate statistics of the log (survey 2.4).

All are ``groupBy().agg()`` with built-in functions, so Spark does partial
(map-side) aggregation before the shuffle; hot keys are combined before they
move. Only the percentile helpers hold values per group and say so.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import LECTURE_TYPES, PARTS
from .prefix import Agg, running

LABEL = "answered_correctly"


def std_int(col: str | Column) -> Column:
    """Sample standard deviation of an integer-valued column from exact
    integer moments: n, sum(y) and sum(y*y) are longs, then one fixed chain
    of double operations. Unlike ``stddev_samp`` (floating partial moments
    merged in task order) the result does not depend on partitioning. NULL
    for fewer than two values, as ``stddev_samp``.
    """
    y = F.col(col) if isinstance(col, str) else col
    n = F.count(y).cast("double")
    s = F.sum(y.cast("long")).cast("double")
    ss = F.sum(y.cast("long") * y.cast("long")).cast("double")
    var = F.greatest(ss - s * s / n, F.lit(0.0)) / (n - F.lit(1.0))
    return F.when(F.count(y) > 1, F.sqrt(var))


def label_stats(df: DataFrame, by: str | Sequence[str], stats: Sequence[str], suffix: str,
                label: str = LABEL) -> DataFrame:
    """mean / sum / count / std (sample) of ``label`` by key, named
    ``{label}_{stat}{suffix}`` as the reference names them."""
    y = F.col(label)
    fns = {"avg": F.avg(y).cast("double"), "sum": F.sum(y).cast("long"),
           "count": F.count(y).cast("long"), "std": std_int(y)}
    keys = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*keys).agg(*[fns[s].alias(f"{label}_{s}{suffix}") for s in stats])


def content_stats(q: DataFrame, stats=("avg", "sum", "count", "std")) -> DataFrame:
    """Per content: answered_correctly_{avg,sum,count,std}_c."""
    return label_stats(q, "content_id", stats, "_c")


def named_stats(df: DataFrame, by: str | Sequence[str], names: dict[str, Column]) -> DataFrame:
    keys = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in names.items()])


def content_attempt_stats(q: DataFrame, cap: int = 5) -> DataFrame:
    """Attempts per (user, content) capped at ``cap``, then mean/std/count of
    the label by (content, attempts): n, sum(y) and sum(y*y) per pair are all
    that the second aggregate needs, so no row is joined back."""
    y = F.col(LABEL).cast("long")
    pairs = q.groupBy("content_id", "user_id").agg(
        F.count(F.lit(1)).alias("_rows"), F.count(y).alias("_n"), F.sum(y).alias("_s"), F.sum(y * y).alias("_ss"))
    n, s, ss = (F.sum(c).cast("double") for c in ("_n", "_s", "_ss"))
    var = F.greatest(ss - s * s / n, F.lit(0.0)) / (n - F.lit(1.0))
    return pairs.groupBy("content_id", F.least("_rows", F.lit(cap)).cast("long").alias("question_count")).agg(
        F.try_divide(s, n).alias("mean_acc"), F.when(F.sum("_n") > 1, F.sqrt(var)).alias("std_acc"),
        F.sum("_n").alias("count"))


def user_lecture_profile(lecture_rows: DataFrame, flags: bool = True) -> DataFrame:
    """Per user: lectures seen by part (part_1..part_7) and by type
    (type_of_*), plus ``*_boolean`` flags (count > 0). ``lecture_rows`` has
    the lecture dimension attached as lecture_part / lecture_type_of."""
    t = F.regexp_replace(F.col("lecture_type_of"), " ", "_")
    cols = [F.sum(F.when(F.col("lecture_part") == p, 1).otherwise(0)).cast("long").alias(f"part_{p}")
            for p in PARTS]
    cols += [F.sum(F.when(t == v, 1).otherwise(0)).cast("long").alias(f"type_of_{v}")
             for v in LECTURE_TYPES]
    prof = lecture_rows.groupBy("user_id").agg(*cols)
    if flags:
        names = [f"part_{p}" for p in PARTS] + [f"type_of_{v}" for v in LECTURE_TYPES]
        prof = prof.withColumns({f"{n}_boolean": (F.col(n) > 0).cast("int") for n in names})
    return prof


def container_questions(q: DataFrame) -> DataFrame:
    """Per container: rows / distinct users (avg_questions)."""
    return q.groupBy("task_container_id").agg(
        (F.count(F.lit(1)) / F.countDistinct("user_id")).cast("double").alias("avg_questions"))


def container_load(q: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """``container_questions`` and its running sum over container order
    (avg_questions_seen).

    An exact running sum: ranges follow the number of containers, not their
    ids, and the sums don't depend on the ranges.
    """
    out = running(container_questions(q), [], [Agg("avg_questions_seen", "exact", F.col("avg_questions"))],
                  order=("task_container_id",), inclusive=True, rows_per_task=rows_per_task)
    return out.withColumn("avg_questions_seen", F.col("avg_questions_seen").cast("double"))


def global_means(q: DataFrame) -> DataFrame:
    """One row: label mean, elapsed mean, mean of user means, mean of
    question means (all over question rows). One lazy plan: the three one-row
    aggregates are joined on a constant."""
    one = F.lit(1).alias("_one")
    base = q.agg(F.avg(LABEL).alias("label_mean"), F.avg("prior_question_elapsed_time").alias("elapsed_mean")).select(one, "*")
    um = q.groupBy("user_id").agg(F.avg(LABEL).alias("m")).agg(F.avg("m").alias("user_mean_mean")).select(one, "*")
    qm = q.groupBy("content_id").agg(F.avg(LABEL).alias("m")).agg(F.avg("m").alias("question_mean_mean")).select(one, "*")
    return base.join(um, "_one").join(qm, "_one").drop("_one")


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    fn = F.approx_count_distinct if approx else F.countDistinct
    return df.agg(*[fn(c).alias(f"n_{c}") for c in cols])


def profile_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count/mean/std/min/quartiles/max per column, one row per column.

    Moments come from one unpivot + ``groupBy(column)`` (partial
    aggregation); quartiles of all columns from one pass of
    ``functions.quantiles`` (exact, distributed).
    """
    from ..functions.quantiles import column_quantiles

    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], list(cols), "column", "value")
    v = F.col("value")
    moments = long.groupBy("column").agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"))
    quartiles = column_quantiles(df, {c: F.col(c) for c in cols}, (0.25, 0.5, 0.75))
    qdf = df.sparkSession.createDataFrame(
        [(c, *q) for c, q in quartiles.items()], "column string, p25 double, p50 double, p75 double")
    return moments.join(qdf, "column", "left")
