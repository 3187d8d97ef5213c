"""Ordering, positions and splits (survey 2.6).

Global and per-user positions come from the running count of
``operators.prefix``: a log or a user with more rows than a task should hold is
cut into ranges, a plain window serves the rest.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import ORDER
from .prefix import Agg, running


def global_position(df: DataFrame, name: str = "position", rows_per_task: int | None = None) -> DataFrame:
    """0-based position of each row in (timestamp, row_id) order."""
    return running(df, [], [Agg(name, "count", F.lit(1))], order=ORDER, rows_per_task=rows_per_task)


def user_position(df: DataFrame, name: str = "user_position", rows_per_task: int | None = None) -> DataFrame:
    """0-based position of each row inside its user."""
    return running(df, ["user_id"], [Agg(name, "count", F.lit(1))], order=ORDER, rows_per_task=rows_per_task)


def tail_rank(df: DataFrame, name: str = "tail_rank", rows_per_task: int | None = None) -> DataFrame:
    """1 for the user's last row, 2 for the one before, ... (rank from the end):
    an inclusive running count in reversed (timestamp, row_id) order, so no
    per-user count has to be joined back."""
    rev = df.withColumns({"_nts": -F.col("timestamp"), "_nrid": -F.col("row_id")})
    out = running(rev, ["user_id"], [Agg(name, "count", F.lit(1))], order=("_nts", "_nrid"), inclusive=True,
                  rows_per_task=rows_per_task)
    return out.drop("_nts", "_nrid")


def user_tail_split(df: DataFrame, valid_n: int = 5, train_n: int = 18) -> DataFrame:
    """Last ``valid_n`` rows of each user -> valid, the ``train_n`` before ->
    train, the rest -> history. Adds ``tail_rank`` and ``split``."""
    r = F.col("tail_rank")
    return tail_rank(df).withColumn(
        "split", F.when(r <= valid_n, "valid").when(r <= valid_n + train_n, "train").otherwise("history"))


def ordered_split(df: DataFrame, valid_frac: float = 0.2) -> DataFrame:
    """First rows by position -> train, the last ceil(frac * n) -> valid."""
    n = df.count()
    cut = n - math.ceil(round(valid_frac * n, 9))
    pos = global_position(df, "_pos")
    return pos.withColumn("split", F.when(F.col("_pos") < cut, "train").otherwise("valid")).drop("_pos")


def random_split(df: DataFrame, key: str = "row_id", seed: int = 42,
                 fractions=(0.8, 0.1, 0.1), names=("train", "valid", "test")) -> DataFrame:
    """Deterministic random split: md5 of "key:seed", its first 8 hex digits
    modulo 1000.

    Unlike ``rand()``, the label of a row does not change when a task is
    retried after an executor loss.
    """
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    b = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 1000
    edges, acc = [], 0.0
    for f in fractions[:-1]:
        acc += f
        edges.append(int(round(acc * 1000)))
    e: Column = F.lit(names[-1])
    for edge, nm in reversed(list(zip(edges, names[:-1]))):
        e = F.when(b < edge, F.lit(nm)).otherwise(e)
    return df.withColumn("split", e)


def first_n(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows in (timestamp, row_id) order, by position: a top-k
    would gather all of them in one task."""
    return global_position(df, "_pos").filter(F.col("_pos") < n).drop("_pos")


def last_n(df: DataFrame, n: int) -> DataFrame:
    """The last ``n`` rows in (timestamp, row_id) order, by position from the end."""
    rev = df.withColumns({"_nts": -F.col("timestamp"), "_nrid": -F.col("row_id")})
    pos = running(rev, [], [Agg("_pos", "count", F.lit(1))], order=("_nts", "_nrid"))
    return pos.filter(F.col("_pos") < n).drop("_pos", "_nts", "_nrid")


def skip_n(df: DataFrame, n: int) -> DataFrame:
    """All rows after the first ``n`` in (timestamp, row_id) order
    (distributed; ``offset`` would run in one task)."""
    return global_position(df, "_pos").filter(F.col("_pos") >= n).drop("_pos")


def nested_horizon_stats(q: DataFrame, valid_n: int = 5, train_n: int = 18) -> DataFrame:
    """Split rows (valid, train) with user stats from the matching horizon:
    valid rows see stats of all rows but valid; train rows see history only.

    One ranked table and one ``groupBy(user)`` with conditional aggregates, no
    second pass per horizon; the rows are already partitioned by the user, so
    neither the aggregate nor its join moves them again.
    """
    r = F.col("tail_rank")
    ranked = tail_rank(q).withColumn(
        "split", F.when(r <= valid_n, "valid").when(r <= valid_n + train_n, "train").otherwise("history"))
    y = F.col("answered_correctly")
    e = F.coalesce(F.col("prior_question_had_explanation"), F.lit(False)).cast("int")
    stats = ranked.groupBy("user_id").agg(
        F.avg(F.when(r > valid_n, y)).alias("_acc_wo_valid"),
        F.avg(F.when(r > valid_n, e)).alias("_exp_wo_valid"),
        F.avg(F.when(r > valid_n + train_n, y)).alias("_acc_hist"),
        F.avg(F.when(r > valid_n + train_n, e)).alias("_exp_hist"))
    rows = ranked.filter(F.col("split") != "history").join(stats, "user_id", "left")
    is_valid = F.col("split") == "valid"
    return (rows.withColumn("answered_correctly_user",
                            F.when(is_valid, F.col("_acc_wo_valid")).otherwise(F.col("_acc_hist")))
                .withColumn("explanation_mean_user",
                            F.when(is_valid, F.col("_exp_wo_valid")).otherwise(F.col("_exp_hist")))
                .drop("_acc_wo_valid", "_exp_wo_valid", "_acc_hist", "_exp_hist"))
