"""Views of the driver's tables in the shape of the learner log.

``interactions`` comes from ``events``, ``questions`` and ``lectures`` from
``part``, and the larger container-grain log from ``lineitem`` joined to
``orders``. The expressions are the fixed definitions agreed for the
fixtures; the oracle SQL builds the same views in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.prefix import Agg, null_safe_join, running
from ..session import stored

EPOCH = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"
DAY_MS = 86_400_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def content_id(event_id, k):
    """Half of the rows are about 100 common contents, the others reach all
    rows of ``part`` (five events per part at every scale factor)."""
    return F.when(event_id % 2 == 0, k).otherwise(F.floor(event_id / 5)).cast("int")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interaction log: one row per event, schema ``schema.INTERACTIONS``."""
    ev = read_table(spark, sf_dir, "events")
    base = ev.select(
        F.col("event_id").alias("row_id"),
        F.expr(f"timestampdiff(MILLISECOND, {EPOCH}, ts)").alias("timestamp"),
        "user_id",
        content_id(F.col("event_id"), F.get_json_object("props", "$.k").cast("int")).alias("content_id"),
        (F.col("event_type") == "view").cast("int").alias("content_type_id"),
        F.when(F.col("event_type") == "view", F.lit(-1))
         .otherwise((F.col("event_id") % 4).cast("int")).alias("user_answer"),
        F.when(F.col("event_type") == "view", F.lit(-1))
         .when(F.col("event_type").isin("purchase", "click"), F.lit(1))
         .otherwise(F.lit(0)).alias("answered_correctly"),
        F.col("value").alias("_value"),
        (F.col("event_type") == "error").alias("_error"),
    )
    # A user's first timestamp is the least of the earlier ones, or the row's own.
    ts = F.col("timestamp")
    lagged = running(
        base, ["user_id"],
        [Agg("prior_question_elapsed_time", "last", F.col("_value")),
         Agg("prior_question_had_explanation", "last", F.col("_error")),
         Agg("_neg_t0", "max", -ts)], spread_out=True)
    lagged = lagged.withColumn("task_container_id", F.floor(
        (ts - F.coalesce(-F.col("_neg_t0"), ts)) / F.lit(DAY_MS)).cast("int"))
    return lagged.select(
        "row_id", "timestamp", "user_id", "content_id", "content_type_id",
        "task_container_id", "user_answer", "answered_correctly",
        F.col("prior_question_elapsed_time").cast("double"),
        F.col("prior_question_had_explanation").cast("boolean"))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part").filter(F.col("p_partkey") % 20 != 19)
    return p.select(
        F.col("p_partkey").cast("int").alias("question_id"),
        F.floor(F.col("p_partkey") / 3).cast("int").alias("bundle_id"),
        (F.col("p_partkey") % 4).cast("int").alias("correct_answer"),
        (F.col("p_size") % 7 + 1).cast("int").alias("part"),
        F.when(F.col("p_partkey") % 19 == 0, F.lit(None).cast("string")).otherwise(
            F.concat_ws(" ", F.col("p_size").cast("string"),
                        ((F.col("p_partkey") % 23).cast("int") + 60).cast("string"),
                        (F.col("p_size") + 10).cast("string"))).alias("tags"),
    )


def lectures(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part").filter(F.col("p_partkey") % 25 != 24)
    t = F.col("p_type")
    return p.select(
        F.col("p_partkey").cast("int").alias("lecture_id"),
        F.col("p_size").cast("int").alias("tag"),
        ((F.col("p_partkey") % 7).cast("int") + 1).alias("part"),
        F.when(t.contains("PROMO"), "solving question")
         .when(t.contains("SMALL"), "intention")
         .when(t.contains("LARGE"), "starter")
         .otherwise("concept").alias("type_of"),
    )


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The larger log: order lines as answers, orders as containers.

    There is no unique row key, so only container-grain history applies.
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    return j.select(
        F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', o_orderdate)").alias("timestamp"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").cast("int").alias("content_id"),
        F.lit(0).alias("content_type_id"),
        F.col("o_orderkey").alias("task_container_id"),
        (F.col("l_returnflag") != "R").cast("int").alias("answered_correctly"),
    )


def packed_batches(spark: SparkSession, sf_dir: str, batch_rows: int = 1000) -> DataFrame:
    """``test_batches`` with one row per batch: ``group_num``, the rows in row
    order as the array ``_rows``, and the two texts. What moves between tasks is
    of the log's size; the texts come to each row in ``unpacked`` only.
    """
    lg = interactions(spark, sf_dir)
    first = ["row_id", "answered_correctly", "user_answer"]
    rows = F.sort_array(F.collect_list(F.struct(*first, *[c for c in lg.columns if c not in first])))
    packed = stored(lg.groupBy(F.floor(F.col("row_id") / F.lit(batch_rows)).cast("long").alias("group_num"))
                    .agg(rows.alias("_rows")), "batches")

    def as_text(field: str):
        return F.concat(F.lit("["), F.array_join(F.transform("_rows", lambda x: x[field].cast("string")), ", "),
                        F.lit("]"))

    texts = packed.select(F.col("group_num").alias("_of"), as_text("answered_correctly").alias("_ans"),
                          as_text("user_answer").alias("_resp"))
    # the batch before is found by its number, so that no task holds the texts of all batches
    before = running(packed.select("group_num"), [], [Agg("_before", "last", F.struct("group_num"))], order=("group_num",))
    before = before.where("_before is not null").select("group_num", F.col("_before.group_num").alias("_of"))
    prev = null_safe_join(before, texts, ["_of"], "inner").drop("_of")

    def text(c: str):
        return F.when(F.col("group_num").isNotNull(), F.coalesce(c, F.lit("[]")))

    return packed.join(prev, "group_num", "left").select(
        "group_num", "_rows", text("_ans").alias("prior_group_answers_correct"), text("_resp").alias("prior_group_responses"))


def unpacked(packed: DataFrame) -> DataFrame:
    """The rows of ``packed_batches``, those of a batch next to each other."""
    lists = [c for c in packed.columns if c not in ("group_num", "_rows")]
    out = packed.select("group_num", F.explode("_rows").alias("_r"), *lists)
    names = [c for c in out.schema["_r"].dataType.names if c not in ("user_answer", "answered_correctly")]
    return out.select("group_num", *[F.col(f"_r.{c}") for c in names], *lists)


def test_batches(spark: SparkSession, sf_dir: str, batch_rows: int = 1000) -> DataFrame:
    """Scoring batches in the reference's test format, built from the log.

    Batch ``group_num`` holds ``batch_rows`` consecutive row ids (row ids grow
    with time). Each row carries the answers and responses of the previous
    batch as text lists (``'[1, 0, -1]'``, in row order), empty for the first.
    A list holds at most ``batch_rows`` items, so no group grows with the data.
    """
    return unpacked(packed_batches(spark, sf_dir, batch_rows))
