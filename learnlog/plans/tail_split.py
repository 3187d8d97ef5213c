"""Plan C: per-user tail split with nested horizons and lecture profiles
(the reference's lecture-feature script).

valid = each user's last 5 question rows, train = the 18 before; user stats
for valid come from all rows but valid, for train from the rest; question
rate is smoothed; the lecture profile and container load are attached; NULLs
get the reference's defaults. Static tables for scoring new rows are the
full-horizon versions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import bool_to_int, cap_container, round_half_even, shift_part, smooth_rate
from ..operators import splits as sp
from ..operators import stats as st
from ..operators.joins import attach_lecture_dim, join_dim
from ..schema import LECTURE_TYPES, PARTS

PROFILE = [f"part_{p}" for p in PARTS] + [f"type_of_{t}" for t in LECTURE_TYPES]
FEATURES = ["answered_correctly_user", "explanation_mean_user", "quest_pct", "avg_questions_seen",
            "prior_question_elapsed_time", "prior_question_had_explanation_enc", "part",
            *PROFILE, *[f"{c}_boolean" for c in PROFILE]]


@dataclass
class StaticTables:
    questions: DataFrame      # question_id, part, quest_pct, count
    container: DataFrame      # task_container_id, avg_questions, avg_questions_seen
    users: DataFrame          # user_id, answered_correctly_user, explanation_mean_user
    profile: DataFrame        # user_id, part_*, type_of_*, *_boolean
    content_mean: float
    explanation_prior: float
    elapsed_mean: float


def static_tables(log: DataFrame, questions: DataFrame, lectures: DataFrame) -> StaticTables:
    q = log.filter(F.col("content_type_id") == 0)
    profile = st.user_lecture_profile(attach_lecture_dim(log.filter(F.col("content_type_id") == 1), lectures))
    qs = st.named_stats(q, "content_id", {"quest_pct": F.avg("answered_correctly"), "count": F.count(F.lit(1))})
    qs = qs.withColumn("quest_pct", round_half_even("quest_pct", 5))
    qdim = questions.select("question_id", "part").join(qs, F.col("question_id") == F.col("content_id"), "left") \
                    .drop("content_id")
    content_mean = qdim.agg(F.avg("quest_pct")).first()[0]
    qdim = qdim.withColumn("quest_pct", smooth_rate("quest_pct", "count"))
    users = st.named_stats(q, "user_id", {
        "answered_correctly_user": F.avg("answered_correctly"),
        "explanation_mean_user": F.avg(bool_to_int("prior_question_had_explanation"))})
    scal = q.agg(F.avg("prior_question_elapsed_time").alias("e")).first()
    prior = users.agg(F.avg("explanation_mean_user")).first()[0]
    return StaticTables(qdim, st.container_load(q), users, profile, content_mean, prior, scal["e"])


def materialize(t: StaticTables, path: str) -> StaticTables:
    """Write the static tables once and read them back, so a stream joins
    stored tables instead of recomputing the aggregates every micro-batch."""
    spark = t.users.sparkSession
    frames = {}
    for name in ("questions", "container", "users", "profile"):
        getattr(t, name).write.mode("overwrite").parquet(f"{path}/{name}")
        frames[name] = spark.read.parquet(f"{path}/{name}")
    return StaticTables(**frames, content_mean=t.content_mean, explanation_prior=t.explanation_prior,
                        elapsed_mean=t.elapsed_mean)


def fill_defaults(df: DataFrame, t: StaticTables) -> DataFrame:
    fills = {c: 0 for c in PROFILE + [f"{c}_boolean" for c in PROFILE]}
    fills.update({"answered_correctly_user": 0.65, "explanation_mean_user": t.explanation_prior,
                  "quest_pct": t.content_mean, "part": 4, "avg_questions_seen": 1.0,
                  "prior_question_elapsed_time": t.elapsed_mean, "prior_question_had_explanation_enc": 0})
    return df.fillna({k: v for k, v in fills.items() if v is not None})


def featurise(rows: DataFrame, t: StaticTables, join_users: bool = True, cap: bool = True) -> DataFrame:
    """Attach static tables to question rows (left joins) and fill defaults.
    ``join_users=False`` when the rows already carry their user stats; ``cap``
    limits container ids, which is for scoring only."""
    r = rows.withColumn("task_container_id", cap_container()) if cap else rows
    r = r.join(t.container.select("task_container_id", "avg_questions_seen"), "task_container_id", "left")
    r = join_dim(r, t.questions.select("question_id", "quest_pct", "part"), "content_id", "question_id")
    r = r.withColumn("part", shift_part())
    if join_users:
        r = r.join(t.users, "user_id", "left")
    r = r.join(t.profile, "user_id", "left")
    r = r.withColumn("prior_question_had_explanation_enc", bool_to_int("prior_question_had_explanation"))
    return fill_defaults(r, t)


def split_features(log: DataFrame, questions: DataFrame, lectures: DataFrame) -> DataFrame:
    """Train (X) and valid rows with horizon-matched user stats; ``is_valid``."""
    t = static_tables(log, questions, lectures)
    q = log.filter(F.col("content_type_id") == 0)
    feats = featurise(sp.nested_horizon_stats(q), t, join_users=False, cap=False)
    return feats.withColumn("is_valid", F.col("split") == "valid")
