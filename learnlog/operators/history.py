"""Leak-free history features: for each row, statistics of the user's earlier
rows only (the reference's row loop over per-user dicts, as running
aggregates).

Grain: ``row`` (default) orders by ``(timestamp, row_id)``; ``container``
uses a RANGE frame on ``task_container_id`` so rows of one container never
see each other's answers (D4).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import NULL_PART, ORDER
from .prefix import Agg, Family, hot_keys, null_safe_join, running, running_families


def _grain(grain: str, rows_per_task: int | None, container: str = "task_container_id") -> dict:
    """``running`` arguments for a grain."""
    if grain == "row":
        return dict(order=ORDER, rows_per_task=rows_per_task)
    if grain == "container":
        return dict(container=container, rows_per_task=rows_per_task)
    raise ValueError(f"grain must be row or container, not {grain}")


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as double, NULL when den is 0 (pandas gives NaN; ANSI raises)."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.try_divide(n.cast("double"), d.cast("double"))


def part_key(part: str = "part") -> Column:
    return F.coalesce(F.col(part), F.lit(NULL_PART))


def user_prior(df: DataFrame, *, label: str = "answered_correctly", grain: str = "row",
               rows_per_task: int | None = None) -> DataFrame:
    """answered_correctly_sum_u / count_u / answered_correctly_avg_u."""
    out = running(df, ["user_id"],
                  [Agg("answered_correctly_sum_u", "sum", F.col(label)),
                   Agg("count_u", "count", F.lit(1))], **_grain(grain, rows_per_task))
    return out.withColumn("answered_correctly_avg_u",
                          ratio("answered_correctly_sum_u", "count_u"))


def user_part_prior(df: DataFrame, *, label: str = "answered_correctly", grain: str = "row",
                    rows_per_task: int | None = None) -> DataFrame:
    """part_sum_u / part_count_u / part_avg_u over earlier rows of the same part."""
    out = running(df.withColumn("_part_k", part_key()), ["user_id", "_part_k"],
                  [Agg("part_sum_u", "sum", F.col(label)),
                   Agg("part_count_u", "count", F.lit(1))], **_grain(grain, rows_per_task))
    return out.withColumn("part_avg_u", ratio("part_sum_u", "part_count_u")).drop("_part_k")


def first_time(df: DataFrame, *, grain: str = "row", rows_per_task: int | None = None) -> DataFrame:
    """1 when the user meets this content for the first time, else 0."""
    out = running(df, ["user_id", "content_id"], [Agg("_seen_before", "count", F.lit(1))], **_grain(grain, rows_per_task))
    return out.withColumn("first_time", (F.col("_seen_before") == 0).cast("int")).drop("_seen_before")


def add_user_feats(df: DataFrame, *, label: str = "answered_correctly", grain: str = "row",
                   rows_per_task: int | None = None, with_part: bool = True, container: str = "task_container_id",
                   answered_only: bool = False) -> DataFrame:
    """All causal user features in one plan over labelled question rows.
    With ``answered_only`` rows without a label count for nothing.

    ``df`` needs user_id, content_id, timestamp, row_id (row grain) or
    task_container_id (container grain), the label and ``part`` when
    ``with_part``. The three key families (user; user+part; user+content)
    are one ``running_families`` call: one shuffle of the rows on the user
    serves every window.
    """
    y = F.col(label)
    one = F.when(y.isNotNull(), F.lit(1)) if answered_only else F.lit(1)
    fams = [Family((Agg("answered_correctly_sum_u", "sum", y), Agg("count_u", "count", one)))]
    if with_part:
        df = df.withColumn("_part_k", part_key())
        fams.append(Family((Agg("part_sum_u", "sum", y), Agg("part_count_u", "count", one)),
                           ("_part_k",)))
    fams.append(Family((Agg("_seen_before", "count", one),), ("content_id",)))
    out = running_families(df, ["user_id"], fams, **_grain(grain, rows_per_task, container))
    new = {"answered_correctly_avg_u": ratio("answered_correctly_sum_u", "count_u"),
           "first_time": (F.col("_seen_before") == 0).cast("int")}
    if with_part:
        new["part_avg_u"] = ratio("part_sum_u", "part_count_u")
    return out.withColumns(new).drop("_seen_before", "_part_k")


def recent_mean(df: DataFrame, n: int, *, label: str = "answered_correctly",
                rows_per_task: int | None = None) -> DataFrame:
    """Mean of the user's last ``n`` answers before this row (NULL on first).

    A window of the ``n`` rows before. For users with more rows than a task
    should hold, prefix sums: with p = earlier answers and S(p) their sum, the
    last n sum to S(p) - S(p - n), looked up by an equi-join on (user_id,
    position), which spreads such a user.
    """
    name = f"recent_mean_{n}"
    frame = Window.partitionBy("user_id").orderBy(*ORDER).rowsBetween(-n, -1)
    hot, total = hot_keys(df, ["user_id"], rows_per_task)
    if not total:
        return df.withColumn(name, F.avg(F.col(label).cast("double")).over(frame))
    pos = running(null_safe_join(df, hot, ["user_id"], "left_semi"), ["user_id"],
                  [Agg("_s", "sum", F.col(label)), Agg("_p", "count", F.lit(1))], order=ORDER, rows_per_task=rows_per_task)
    back = pos.select("user_id", (F.col("_p") + n).alias("_p"), F.col("_s").alias("_s_back"))
    j = pos.join(back, ["user_id", "_p"], "left")
    recent_sum = F.col("_s") - F.coalesce(F.col("_s_back"), F.lit(0))
    many = j.withColumn(name, ratio(recent_sum, F.least(F.col("_p"), F.lit(n)))).drop("_s", "_p", "_s_back")
    few = null_safe_join(df, hot, ["user_id"], "left_anti").withColumn(name, F.avg(F.col(label).cast("double")).over(frame))
    return few.unionByName(many)


def user_change(df: DataFrame, *, rows_per_task: int | None = None) -> DataFrame:
    """1 at each user's first row, else 0."""
    out = running(df, ["user_id"], [Agg("_n_before", "count", F.lit(1))], order=ORDER, rows_per_task=rows_per_task)
    return out.withColumn("user_change", (F.col("_n_before") == 0).cast("int")).drop("_n_before")


def time_diff(df: DataFrame, *, rows_per_task: int | None = None) -> DataFrame:
    """Gap to the user's previous row; 0 on the user's first row."""
    out = running(df, ["user_id"], [Agg("_prev_ts", "last", F.col("timestamp"))], order=ORDER, rows_per_task=rows_per_task)
    return out.withColumn("time_diff", F.coalesce(F.col("timestamp") - F.col("_prev_ts"), F.lit(0))
                          .cast("long")).drop("_prev_ts")


def answer_time(df: DataFrame, *, rows_per_task: int | None = None) -> DataFrame:
    """The next row's prior_question_elapsed_time within the user."""
    return running(df, ["user_id"], [Agg("answer_time", "next", F.col("prior_question_elapsed_time"))], order=ORDER, rows_per_task=rows_per_task)


def user_relative_time(df: DataFrame) -> DataFrame:
    """timestamp minus the user's first timestamp (over the rows given)."""
    start = df.groupBy("user_id").agg(F.min("timestamp").alias("_t0"))
    return (df.join(start, "user_id", "left")
              .withColumn("relative_time", (F.col("timestamp") - F.col("_t0")).cast("long"))
              .drop("_t0"))
