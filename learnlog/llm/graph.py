"""Connected components of an edge table.

Alternating large-star and small-star rounds (Kiveris et al., 2014): each round
is a ``groupBy(node).min`` and a join back, so a node with very many edges is
pre-aggregated, and its join is one that adaptive execution can split. Every
round's edges are a table in the shared folder of ``spark.checkpoint.dir``,
which cuts the lineage; the table of the round before is then deleted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learnlog.session import scratch_path


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` as a table of its own in the shared folder, and its path."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _with_least(edges: DataFrame, low: DataFrame) -> DataFrame:
    """``edges(u, v)`` with the ``m`` of their ``u``.

    The key is cast so that the join shuffles both sides by itself rather than
    on the aggregate's partitions: adaptive execution splits only such a join,
    and a node with very many edges has to be split.
    """
    key = "decimal(20, 0)"
    return edges.withColumn("k", F.col("u").cast(key)).join(low.select(F.col("u").cast(key).alias("k"), "m"), "k")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: the smallest node it reaches.

    NULL ends and loops are ignored; an empty table gives an empty result.
    """
    spark = edges.sparkSession
    e, path = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .distinct(), "edges")
    before = None
    while True:
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = _with_least(both.where("v > u"), low).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (_with_least(large, low).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        nxt, to = written(small, "edges")
        delete(spark, path)
        e, path = nxt, to
        # a star forest is a fixed point: the same edges twice in a row
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select("v", "v").distinct())
