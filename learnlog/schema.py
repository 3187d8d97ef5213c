"""Explicit schemas of the learner log and its dimensions (no inference)."""

from pyspark.sql import types as T

INTERACTIONS = T.StructType([
    T.StructField("row_id", T.LongType(), False),
    T.StructField("timestamp", T.LongType(), False),
    T.StructField("user_id", T.LongType(), False),
    T.StructField("content_id", T.IntegerType(), False),
    T.StructField("content_type_id", T.IntegerType(), False),
    T.StructField("task_container_id", T.IntegerType(), True),
    T.StructField("user_answer", T.IntegerType(), True),
    T.StructField("answered_correctly", T.IntegerType(), True),
    T.StructField("prior_question_elapsed_time", T.DoubleType(), True),
    T.StructField("prior_question_had_explanation", T.BooleanType(), True),
])

QUESTIONS = T.StructType([
    T.StructField("question_id", T.IntegerType(), False),
    T.StructField("bundle_id", T.IntegerType(), True),
    T.StructField("correct_answer", T.IntegerType(), True),
    T.StructField("part", T.IntegerType(), True),
    T.StructField("tags", T.StringType(), True),
])

LECTURES = T.StructType([
    T.StructField("lecture_id", T.IntegerType(), False),
    T.StructField("tag", T.IntegerType(), True),
    T.StructField("part", T.IntegerType(), True),
    T.StructField("type_of", T.StringType(), True),
])

TEST_BATCHES = T.StructType(
    [f for f in INTERACTIONS.fields if f.name not in ("user_answer", "answered_correctly")]
    + [T.StructField("group_num", T.LongType(), False),
       T.StructField("prior_group_answers_correct", T.StringType(), True),
       T.StructField("prior_group_responses", T.StringType(), True)]
)

# Fixed values of the data model: question parts run 1..7 and lectures come in
# four types (with the space in "solving question" replaced by "_").
PARTS = [1, 2, 3, 4, 5, 6, 7]
LECTURE_TYPES = ["concept", "intention", "solving_question", "starter"]

# Sentinel for a NULL part when part is used as a grouping key (D16).
NULL_PART = -1

# Order key inside a user: timestamp with row_id as tiebreak (file order is
# not available in Spark).
ORDER = ("timestamp", "row_id")
