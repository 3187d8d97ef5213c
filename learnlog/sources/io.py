"""Readers and writers (survey 2.1): CSV with an explicit schema, inferred
CSV, schema casting, parquet feature tables."""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with a header and a fixed schema; ``columns`` prunes at read."""
    df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    return df.select(*columns) if columns else df


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with inferred types (an extra pass over the data; avoid on logs)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with every column as text, for ``cast_schema``."""
    return spark.read.option("header", True).csv(path)


def cast_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bulk cast to a schema; text that does not parse becomes NULL."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields
                       if f.name in df.columns])


#: Rows of a compressed CSV file, which only one task can read.
CSV_ROWS = 50_000


def write_csv(df: DataFrame, path: str, compress: bool = False) -> None:
    """CSV with a header. ``compress`` is for wide texts that neighbouring rows
    share (the answer lists of a batch): LZ4, ``CSV_ROWS`` rows to a file."""
    w = df.write.mode("overwrite").option("header", True)
    if compress:
        w = w.option("compression", "lz4").option("maxRecordsPerFile", CSV_ROWS)
    w.csv(path)


def write_features(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


#: Rows of a bucket, about; each bucket is one file and one task.
BUCKET_ROWS = 4_000_000


def write_bucketed(df: DataFrame, name: str, path: str, key: str = "user_id", order: Sequence[str] = (),
                   buckets: int | None = None) -> DataFrame:
    """``df`` as the table ``name`` with its files under ``path``: bucketed by
    ``key``, sorted by ``key`` and ``order``, and read back.

    Windows, groups and joins on ``key`` over such tables need no exchange (joins
    on more columns neither, with ``spark.sql.requireAllClusterKeysForCoPartition``
    off), if the tables have equally many buckets: pass ``buckets`` to fit.
    """
    n = buckets or max(1, math.ceil(df.count() / BUCKET_ROWS))
    # a task writes one bucket, so each bucket is one file and stays sorted
    (df.repartition(n, key).write.mode("overwrite").bucketBy(n, key).sortBy(key, *order)
     .option("path", path).format("parquet").saveAsTable(name))
    return df.sparkSession.table(name)


def buckets_of(spark: SparkSession, name: str) -> int:
    """Number of buckets of a stored table."""
    rows = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").collect()
    if not rows:
        raise ValueError(f"{name} has no buckets")
    return int(rows[0]["data_type"])
