"""Boosted-tree model on the feature table (survey 2.10) with Spark ML.

The reference trains LightGBM with early stopping on a validation set; here
``GBTClassifier`` takes the validation rows through
``validationIndicatorCol`` and stops when the validation loss stops
improving. Training is distributed (histogram aggregation per tree level).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


@dataclass
class GBTConfig:
    max_iter: int = 40
    max_depth: int = 5
    step_size: float = 0.1
    max_bins: int = 128
    validation_tol: float = 0.001
    seed: int = 42


def train_gbt(df: DataFrame, features: Sequence[str], label: str = "answered_correctly",
              valid_col: str = "is_valid", cfg: GBTConfig = GBTConfig(), categorical: Sequence[str] = ()) -> PipelineModel:
    """Fit on rows with ``valid_col`` false, early-stop on rows with it true.
    NULL features are imputed by the caller (GBT needs numbers).

    ``categorical`` features (parts, tags, flags: small fixed domains, fewer
    than ``max_bins`` values) are indexed, so the trees split them by value
    sets; a value that training didn't have is a level of its own.
    """
    # every indexer and several steps of the fit read the rows anew: stored, they are computed once
    data = stored(df.select(*features, F.col(label).cast("double").alias("_label"), F.col(valid_col).cast("boolean").alias(valid_col)),
                  "training")
    index = [StringIndexer(inputCol=c, outputCol=f"_idx_{c}", stringOrderType="alphabetAsc", handleInvalid="keep") for c in categorical]
    cols = [f"_idx_{c}" if c in categorical else c for c in features]
    asm = VectorAssembler(inputCols=cols, outputCol="_features", handleInvalid="keep")
    gbt = GBTClassifier(featuresCol="_features", labelCol="_label", maxIter=cfg.max_iter,
                        maxDepth=cfg.max_depth, stepSize=cfg.step_size, maxBins=cfg.max_bins,
                        validationIndicatorCol=valid_col, validationTol=cfg.validation_tol,
                        seed=cfg.seed)
    return Pipeline(stages=[*index, asm, gbt]).fit(data)


def predict_scores(model: PipelineModel, df: DataFrame, key: str = "row_id", keep: Sequence[str] = ()) -> DataFrame:
    """(key, score, keep...) with score = P(answered correctly)."""
    p = model.transform(df)
    return p.select(key, vector_to_array("probability")[1].alias("score"), *keep)


def feature_importance(model: PipelineModel, features: Sequence[str], spark) -> DataFrame:
    imp = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)],
                                 "feature string, importance double")
