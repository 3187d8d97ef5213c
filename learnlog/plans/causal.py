"""Plan A: causal features -> model (the reference's latest feature script).

question rows + question dim (part, tag PCA scores) -> content statistics ->
leak-free user / user-part / first-time history -> imputed feature table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.encoders import TagsEncoder
from ..functions.scalars import bool_to_int
from ..operators import history as h
from ..operators import state as stt
from ..operators import stats as st
from ..operators.joins import join_dim
from ..sources import fixtures as fx

# The reference keeps PCA components 0, 3 and 4 of a 5-component fit.
PCA_KEEP = ("PCA_0", "PCA_3", "PCA_4")

FEATURES = ["answered_correctly_avg_u", "answered_correctly_sum_u", "count_u", "answered_correctly_avg_c",
            "part", "prior_question_had_explanation", "prior_question_elapsed_time", "first_time",
            *PCA_KEEP, "part_avg_u", "part_sum_u", "part_count_u", "answered_correctly_sum_c",
            "answered_correctly_count_c", "answered_correctly_std_c"]


def question_dim_with_pca(questions: DataFrame) -> DataFrame:
    enc = TagsEncoder(5).fit(questions)
    return enc.transform(questions).select("question_id", "part", *PCA_KEEP)


def causal_features_from(log: DataFrame, questions: DataFrame, with_pca: bool = True) -> DataFrame:
    dim = question_dim_with_pca(questions) if with_pca else questions.select("question_id", "part")
    q = log.filter(F.col("content_type_id") == 0)
    q = join_dim(q, dim, "content_id", "question_id")
    feats = h.add_user_feats(q)
    feats = feats.join(st.content_stats(q), "content_id", "left")
    return feats.withColumn("prior_question_had_explanation",
                            bool_to_int("prior_question_had_explanation"))


# Plan A's columns without the PCA scores.
PLAN_A = [c for c in FEATURES if c not in PCA_KEEP]
CATEGORICAL = ["part", "prior_question_had_explanation"]


def plan_a_features(train: DataFrame, valid: DataFrame) -> DataFrame:
    """Plan A's train and valid rows, ``is_valid`` tells which: content
    statistics and the mean elapsed time from the train rows only, history of
    the train rows from their earlier rows, that of the valid rows from the
    state after all train rows (frozen). ``train`` and ``valid`` are question
    rows with ``part``."""
    rows = h.add_user_feats(train).withColumn("is_valid", F.lit(False)).unionByName(
        stt.apply_frozen_state(valid, stt.build_state(train)).withColumn("is_valid", F.lit(True)))
    mean = train.agg(F.avg("prior_question_elapsed_time")).first()[0]
    return (rows.join(st.content_stats(train), "content_id", "left")
            .withColumn("prior_question_had_explanation", bool_to_int("prior_question_had_explanation"))
            .withColumn("prior_question_elapsed_time", F.coalesce("prior_question_elapsed_time", F.lit(mean)))
            .select("row_id", "user_id", "content_id", "is_valid", "answered_correctly", *PLAN_A,
                    *[c for c in PCA_KEEP if c in train.columns]))


# Rates, which get 0.65 where there is none; other columns get 0.
RATES = ("answered_correctly_avg_u", "part_avg_u", "answered_correctly_avg_c")


def filled_plan_a(train: DataFrame, valid: DataFrame) -> DataFrame:
    """``plan_a_features`` with NULLs imputed."""
    return plan_a_features(train, valid).fillna(0.65, list(RATES)).fillna(0.0, [c for c in PLAN_A if c not in RATES])


def causal_features(spark: SparkSession, sf_dir: str, with_pca: bool = True) -> DataFrame:
    out = causal_features_from(fx.interactions(spark, sf_dir), fx.questions(spark, sf_dir), with_pca)
    return out.select("row_id", "user_id", "content_id", "timestamp", "answered_correctly",
                      *[c for c in FEATURES if with_pca or c not in PCA_KEEP])
