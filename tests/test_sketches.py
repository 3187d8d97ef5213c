"""Distinct counts by mergeable sketches."""

import os

from pyspark.sql import functions as F

from learnlog.operators import sketches as sk


def frame(spark, n=20_000):
    return spark.range(n).select((F.col("id") % 7000).alias("user_id"), (F.xxhash64("id") % 90).alias("content_id"), (F.col("id") % 6).cast("int").alias("day"))


def estimates(df):
    return {r["column"]: r["n"] for r in sk.distinct_estimates(df).collect()}


def test_union_of_days_is_the_whole_and_near_the_exact_count(spark):
    df, cols = frame(spark), ["user_id", "content_id"]
    days = sk.daily_sketches(df, cols, F.col("day"))
    assert estimates(days) == estimates(sk.daily_sketches(df, cols, F.lit(0)))
    for c, n in estimates(days).items():
        exact = df.select(c).distinct().count()
        assert abs(n - exact) <= 3 * sk.STANDARD_ERROR * exact
    assert sk.distinct_estimates(days.where("false")).collect() == []


def test_an_update_touches_only_its_days_and_can_be_repeated(spark, tmp_path):
    df, cols, path = frame(spark), ["user_id", "content_id"], str(tmp_path / "table")
    df = df.withColumn("day", F.when(F.col("day") > 0, F.col("day")))       # one day is missing
    sk.write_sketches(sk.daily_sketches(df.where("day <> 3 or day is null"), cols, F.col("day")), path)

    def files():
        return {f"{d}/{f}" for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}

    before = files()
    new = df.where("day = 3").union(df.where("day = 5").limit(50))
    for _ in range(2):
        sk.update_sketches(spark, path, new, cols, F.col("day"))
    assert {f for f in before if "day=5" not in f} <= files() and any("day=3" in f for f in files())
    assert estimates(spark.read.parquet(path)) == estimates(sk.daily_sketches(df, cols, F.col("day")))
    sk.update_sketches(spark, path, df.where("day is null"), cols, F.col("day"))
    assert estimates(spark.read.parquet(path)) == estimates(sk.daily_sketches(df, cols, F.col("day")))
