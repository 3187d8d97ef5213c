"""Scoring a stream of batches with static tables and a fitted model
(survey 2.11 stream_static_score, stream_lecture_score, sink_predictions).

Stream-static left joins and ``PipelineModel.transform`` run inside the
streaming query itself; the file sink with a checkpoint gives exactly-once
output of ``(row_id, score)`` for question rows.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ensemble import Ensemble
from ..operators.model import predict_scores
from ..plans.tail_split import StaticTables, featurise


def score_stream(stream: DataFrame, model: PipelineModel, prepare, keep: tuple[str, ...] = ()) -> DataFrame:
    """Question rows of the stream, featurised by ``prepare`` -> (row_id, score, keep...)."""
    q = stream.filter(F.col("content_type_id") == 0)
    return predict_scores(model, prepare(q), keep=keep)


def ensemble_score_stream(stream: DataFrame, ensemble: Ensemble, prepare, keep: tuple[str, ...] = ()) -> DataFrame:
    """``score_stream`` with the ensemble as a column expression: no model object in the stream's tasks."""
    q = stream.filter(F.col("content_type_id") == 0)
    return prepare(q).select("row_id", ensemble.score().alias("score"), *keep)


def lecture_score_stream(stream: DataFrame, model: PipelineModel, tables: StaticTables, keep: tuple[str, ...] = ()) -> DataFrame:
    return score_stream(stream, model, lambda q: featurise(q, tables), keep)


def sink_predictions(scores: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> None:
    """Write the scores with a file sink until the input is drained."""
    w = (scores.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True))
    (w.partitionBy(*partition_by) if partition_by else w).start().awaitTermination()


def drain_to_parquet(spark: SparkSession, df: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    sink_predictions(df, path, checkpoint, partition_by)
    return spark.read.parquet(path)
