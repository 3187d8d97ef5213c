"""Distinct counts kept as mergeable sketches, a row per day and column.

An exact distinct count expands rows by columns and starts anew when a day is
added. A HyperLogLog sketch per day and column is a few KB; sketches of days
merge into that of any span, and new rows touch only their own days. Merging is
idempotent: rows that are folded in twice, after a crash or a replay, change
nothing.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored

#: log2 of a sketch's registers, and the relative standard error that goes with it.
LOG_REGISTERS = 12
STANDARD_ERROR = 1.04 / 2 ** (LOG_REGISTERS / 2)


def daily_sketches(df: DataFrame, cols: Sequence[str], day: Column) -> DataFrame:
    """``(day, column, sketch)`` of the rows (a NULL day is a day of its own)."""
    per_day = df.groupBy(day.cast("int").alias("day")).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LOG_REGISTERS)).alias(c) for c in cols])
    return per_day.select("day", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("sketch")) for c in cols])).alias("s")).select("day", "s.*")


def merged(sketches: DataFrame, *by: str) -> DataFrame:
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def write_sketches(sketches: DataFrame, path: str) -> None:
    sketches.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def update_sketches(spark: SparkSession, path: str, new: DataFrame, cols: Sequence[str], day: Column) -> None:
    """Fold new rows into the table at ``path``: only files of their days are read and written."""
    fresh = stored(daily_sketches(new, cols, day), "sketches")
    days = [r["day"] for r in fresh.select("day").distinct().collect()]
    old = spark.read.parquet(path).where(F.col("day").isin([d for d in days if d is not None]) | (F.col("day").isNull() & F.lit(None in days)))
    write_sketches(stored(merged(old.select("day", "column", "sketch").union(fresh.select("day", "column", "sketch")), "day", "column"), "sketches"), path)


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """``(column, n)``: estimated distinct values over all days of ``sketches``."""
    return merged(sketches, "column").select("column", F.hll_sketch_estimate("sketch").alias("n"))
