"""Distributed trainers for the three scores, with persistence of fitted state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginloom.operators.encoders import class_weights, lookup


def with_class_weight(df: DataFrame, target: str, out: str = "class_weight") -> DataFrame:
    w = class_weights(df, target).select(target, F.col("weight").alias(out))
    return lookup(df.where(F.col(target).isNotNull()), w, target)


def fit_risk_trees(train: DataFrame, features: Sequence[str], target: str, valid: DataFrame | None = None,
                   depth: int = 6, rate: float = 0.1, rounds: int = 200) -> PipelineModel:
    """Boosted trees for a 0/1 target; with ``valid`` training stops once the validation error stalls."""
    marked = train.select(*features, F.col(target).cast("double").alias("label"), F.lit(False).alias("is_valid"))
    gbt = GBTClassifier(maxDepth=depth, stepSize=rate, maxIter=rounds, seed=42)
    if valid is not None:
        marked = marked.unionByName(valid.select(
            *features, F.col(target).cast("double").alias("label"), F.lit(True).alias("is_valid")))
        gbt = gbt.setValidationIndicatorCol("is_valid")
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), gbt]).fit(marked)


def fit_propensity(train: DataFrame, features: Sequence[str], target: str, max_iter: int = 100) -> PipelineModel:
    """Class-weighted logistic model on scaled features."""
    marked = with_class_weight(train, target).withColumn("label", F.col(target).cast("double"))
    lr = LogisticRegression(weightCol="class_weight", maxIter=max_iter)
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), lr]).fit(marked)


def fit_delivery_days(train: DataFrame, features: Sequence[str], target: str, weight: str | None = None,
                      depth: int = 5, rounds: int = 50) -> PipelineModel:
    """Boosted regression trees on the group P90 of delivery days.

    Rows alike in features and target go through the rounds as one row of their summed weight.
    """
    rows = train.select(*features, F.col(target).cast("double").alias("label"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_w"))
    alike = rows.groupBy(*features, "label").agg(F.sum("_w").alias("_w"))
    gbt = GBTRegressor(maxDepth=depth, maxIter=rounds, seed=42, weightCol="_w")
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), gbt]).fit(alike)


def score_probability(model: PipelineModel, df: DataFrame, out: str = "score", threshold: float = 0.5) -> DataFrame:
    scored = model.transform(df).withColumn(out, vector_to_array("probability")[1])
    scored = scored.drop("features", "rawPrediction", "probability", "prediction")
    return scored.withColumn("predicted_class", (F.col(out) > threshold).cast("int"))


def score_value(model: PipelineModel, df: DataFrame, out: str = "predicted") -> DataFrame:
    return model.transform(df).withColumnRenamed("prediction", out).drop("features")


def importance_table(spark, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Feature importances normalised to one, largest first (one row per feature)."""
    values = model.stages[-1].featureImportances.toArray()
    total = float(values.sum()) or 1.0
    rows = [(f, float(v) / total) for f, v in zip(features, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
