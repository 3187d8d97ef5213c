"""Evaluation metrics as distributed aggregates (survey 2.10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.prefix import Agg, running
from ..session import stored
from .ensemble import Ensemble


def roc_auc(df: DataFrame, label: str, score: str, rows_per_task: int | None = None) -> DataFrame:
    """Exact, tie-aware ROC AUC as a one-row DataFrame ``auc``.

    Scores are grouped (partial aggregation), negatives below each distinct
    score come from the running sum over scores in order, and ties count
    one half: AUC = sum_s pos_s * (neg_below_s + neg_s / 2) / (P * N). Rows
    whose label or score is NULL (or NaN) don't count.
    """
    y = F.col(label).cast("int")
    s = F.col(score).cast("double")
    by = (df.where(s.isNotNull() & ~F.isnan(s) & F.col(label).isNotNull())
            .groupBy(s.alias("_s")).agg(F.sum(y).cast("long").alias("_pos"),
                                        F.sum(1 - y).cast("long").alias("_neg")))
    cum = running(by, [], [Agg("_neg_below", "sum", F.col("_neg"))], order=("_s",), rows_per_task=rows_per_task)
    return cum.agg(
        (F.sum(F.col("_pos") * (F.col("_neg_below") + F.col("_neg") / 2.0))
         / (F.sum("_pos").cast("double") * F.sum("_neg").cast("double"))).alias("auc"))


def roc_auc_by(df: DataFrame, by: str, label: str, score: str, rows_per_task: int | None = None) -> DataFrame:
    """``roc_auc`` of each value of ``by``, in one pass: ``(by, auc)``."""
    y, s = F.col(label).cast("int"), F.col(score).cast("double")
    groups = (df.where(s.isNotNull() & ~F.isnan(s) & F.col(label).isNotNull()).groupBy(by, s.alias("_s"))
              .agg(F.sum(y).cast("long").alias("_pos"), F.sum(1 - y).cast("long").alias("_neg")))
    cum = running(groups, [by], [Agg("_neg_below", "sum", F.col("_neg"))], order=("_s",), rows_per_task=rows_per_task)
    return cum.groupBy(by).agg(F.try_divide(
        F.sum(F.col("_pos") * (F.col("_neg_below") + F.col("_neg") / 2.0)),
        F.sum("_pos").cast("double") * F.sum("_neg").cast("double")).alias("auc"))


def permutation_importance(rows: DataFrame, ensemble: Ensemble, key: str = "row_id", label: str = "answered_correctly",
                           seed: int = 7, rows_per_task: int | None = None) -> DataFrame:
    """``(feature, auc, permuted_auc, importance)``: what the AUC loses when a
    feature's values are dealt to other rows.

    The row at a place in the order of ``key`` (a unique one) gets the value of
    the row at the same place in the order of md5(seed:feature:key): a
    permutation that any engine can repeat. All features go through one pass:
    their values are ranked together (as text, which a double survives), come
    back as columns of their row, and each row is scored once per feature.
    """
    names, categories = ensemble.features, {n.feature for n in ensemble.nodes if n.categories is not None}
    held = stored(rows.select(key, label, *names), "importance")
    place = running(held.select(key), [], [Agg("_place", "count", F.lit(1))], order=(key,), rows_per_task=rows_per_task)
    long = held.select(key, F.explode(F.array(*[F.struct(
        F.lit(f).alias("feature"), F.col(f).cast("double" if f not in categories else "string").cast("string").alias("_x")) for f in names])).alias("_v")).select(key, "_v.*")
    hashed = long.withColumn("_hash", F.md5(F.concat_ws(":", F.lit(seed), "feature", F.col(key)).cast("binary")))
    dealt = running(hashed, ["feature"], [Agg("_place", "count", F.lit(1))], order=("_hash", key), rows_per_task=rows_per_task)
    # one row per place: a feature's value is NULL or not, so it travels in a struct
    moved = dealt.groupBy("_place").agg(*[F.max(F.when(F.col("feature") == f, F.struct("_x")))["_x"].alias(f"_new_{f}") for f in names])
    wide = held.join(place, key).join(moved, "_place")
    def given(f: str):
        return F.col(f"_new_{f}") if f in categories else F.col(f"_new_{f}").cast("double")

    scores = [F.struct(F.lit(f).alias("feature"), ensemble.score({f: given(f)}).alias("score")) for f in names]
    scored = wide.select(label, F.explode(F.array(F.struct(F.lit("").alias("feature"), ensemble.score().alias("score")), *scores)).alias("_s")).select(label, "_s.*")
    auc = stored(roc_auc_by(scored, "feature", label, "score", rows_per_task), "auc")
    whole = auc.where("feature = ''").select(F.lit(1).alias("_one"), F.col("auc").alias("auc"))
    parts = auc.where("feature <> ''").select(F.lit(1).alias("_one"), "feature", F.col("auc").alias("permuted_auc"))
    return parts.join(whole, "_one").select("feature", "auc", "permuted_auc", (F.col("auc") - F.col("permuted_auc")).alias("importance"))


def scaled_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """The reference's custom metric: 2 x AUC."""
    return roc_auc(df, label, score).select((F.col("auc") * 2).alias("auc2"))


def log_loss(df: DataFrame, label: str, prob: str, eps: float = 1e-15) -> DataFrame:
    """Mean binary cross-entropy, probabilities clipped to [eps, 1 - eps]."""
    p = F.least(F.greatest(F.col(prob).cast("double"), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label).cast("double")
    return df.agg((-F.avg(y * F.ln(p) + (1 - y) * F.ln(1 - p))).alias("log_loss"))
