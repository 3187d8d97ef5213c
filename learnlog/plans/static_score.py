"""Static-statistics scoring (the reference's starter / v2 boosted-tree
scripts): frozen user, content and question statistics are joined to new
rows, NULLs become 0.5, and a model trained on the log scores them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import bool_to_int, split_tags_columns
from ..operators import splits as sp
from ..operators.joins import join_dim
from ..operators.model import GBTConfig, train_gbt

FEATURES = ["answered_correctly_user", "sum", "answered_correctly_content", "bundle_id", "part",
            "prior_question_elapsed_time", "prior_question_had_explanation_enc", "tags1", "tags2", "tags3"]
FILL = 0.5  # the reference's single fill value for every feature


@dataclass
class StaticStats:
    users: DataFrame      # user_id, answered_correctly_user, sum
    content: DataFrame    # content_id, answered_correctly_content
    questions: DataFrame  # question_id, bundle_id, part, tags1..tags3


def static_stats(log: DataFrame, questions: DataFrame) -> StaticStats:
    q = log.filter(F.col("content_type_id") == 0)
    y = F.col("answered_correctly")
    users = q.groupBy("user_id").agg(F.avg(y).alias("answered_correctly_user"), F.sum(y).cast("long").alias("sum"))
    content = q.groupBy("content_id").agg(F.avg(y).alias("answered_correctly_content"))
    qd = questions.select("question_id", "bundle_id", "part", *split_tags_columns("tags", 3))
    return StaticStats(users, content, qd)


def materialize(s: StaticStats, path: str) -> StaticStats:
    """Write the statistics once so a stream joins stored tables."""
    spark = s.users.sparkSession
    out = {}
    for name in ("users", "content", "questions"):
        getattr(s, name).write.mode("overwrite").parquet(f"{path}/{name}")
        out[name] = spark.read.parquet(f"{path}/{name}")
    return StaticStats(**out)


def featurise(rows: DataFrame, s: StaticStats) -> DataFrame:
    """Question rows + statistics (left joins), explanation flag as 0/1,
    every NULL feature -> 0.5."""
    r = rows.filter(F.col("content_type_id") == 0)
    r = r.join(s.users, "user_id", "left").join(s.content, "content_id", "left")
    r = join_dim(r, s.questions, "content_id", "question_id")
    r = r.withColumn("prior_question_had_explanation_enc", bool_to_int("prior_question_had_explanation"))
    return r.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(FILL)) for c in FEATURES})


CATEGORICAL = ["part", "tags1", "tags2", "tags3"]


def train(log: DataFrame, questions: DataFrame, cfg: GBTConfig = GBTConfig(max_iter=20)) -> PipelineModel:
    """Fit on the first 80% of question rows in time order, early-stop on the
    rest; the statistics are those of the first 80%, so the rest is unseen."""
    split = sp.ordered_split(log.filter(F.col("content_type_id") == 0))
    stats = static_stats(split.filter("split = 'train'"), questions)
    feats = featurise(split, stats).withColumn("is_valid", F.col("split") == "valid")
    return train_gbt(feats, FEATURES, cfg=cfg, categorical=CATEGORICAL)
