"""Churn model: random forest on recency, frequency, value and rating.

The label is a function of ``recency``, which is also a feature, so the scores on held-out
customers are close to perfect by construction.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from silverbrook import schemas, settings
from silverbrook.functions import values as V


@dataclass
class ChurnModel:
    pipeline: PipelineModel
    metrics: dict[str, float]
    importances: dict[str, float] = field(default_factory=dict)


def is_training(key: str = "customer_id", share: int = 80, seed: int = settings.SEED) -> Column:
    """A fixed share of the keys by hash: a retried or recomputed task draws the same rows."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(100)) < share


def confusion_metrics(cells: list[Row]) -> dict[str, float]:
    """f1, precision and recall weighted by class size from (label, prediction, count) cells."""
    total = sum(c["count"] for c in cells)
    scores = {"f1": 0.0, "precision": 0.0, "recall": 0.0}
    for label in {c["label"] for c in cells}:
        hit = sum(c["count"] for c in cells if c["label"] == c["prediction"] == label)
        actual = sum(c["count"] for c in cells if c["label"] == label)
        guessed = sum(c["count"] for c in cells if c["prediction"] == label)
        precision, recall = hit / guessed if guessed else 0.0, hit / actual
        both = precision + recall
        weight = actual / total
        scores["precision"] += weight * precision
        scores["recall"] += weight * recall
        scores["f1"] += weight * (2 * precision * recall / both if both else 0.0)
    return scores


def train(features: DataFrame, path: str, trees: int = settings.CHURN_TREES) -> ChurnModel:
    """Fit on 80 % of the customers, keep the model under ``path``, measure it on the rest.

    ``features`` is read several times; hand in a stored table. The model is used as loaded
    back: a freshly fitted one drags its training summary, and the session with it, into
    every task.
    """
    training = features.filter(is_training())
    held_out = features.filter(~is_training())
    steps = [
        VectorAssembler(inputCols=settings.CHURN_FEATURES, outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
        RandomForestClassifier(
            featuresCol="features", labelCol="churned", numTrees=trees, seed=settings.SEED
        ),
    ]
    Pipeline(stages=steps).fit(training).write().overwrite().save(path)
    pipeline = PipelineModel.load(path)
    predicted = pipeline.transform(held_out)
    cells = (
        predicted.groupBy(
            F.col("churned").cast("double").alias("label"), F.col("prediction")
        )
        .count()
        .collect()
    )
    metrics = confusion_metrics(cells)
    area = BinaryClassificationEvaluator(
        labelCol="churned", rawPredictionCol="rawPrediction", metricName="areaUnderROC"
    )
    metrics["auc"] = area.evaluate(predicted)
    weights = pipeline.stages[-1].featureImportances.toArray()
    return ChurnModel(
        pipeline, metrics, dict(zip(settings.CHURN_FEATURES, map(float, weights)))
    )


def score(features: DataFrame, model: ChurnModel) -> DataFrame:
    """Churn probability and risk of every customer."""
    probability = vector_to_array("probability")[1]
    scored = model.pipeline.transform(features).withColumn("churn_probability", probability)
    return scored.withColumns(
        {
            "risk_label": V.risk_label("churn_probability"),
            "model_f1": F.lit(round(model.metrics["f1"], 4)),
            "model_auc": F.lit(round(model.metrics["auc"], 4)),
            "scored_at": F.current_timestamp(),
        }
    ).select(schemas.GOLD["ml_churn_scores"].fieldNames())


def run_rows(model: ChurnModel, trees: int = settings.CHURN_TREES) -> list[tuple[str, str, str]]:
    """Parameters and metrics of a run as (kind, name, value)."""
    params = {
        "algorithm": "RandomForest",
        "num_trees": trees,
        "churn_threshold_days": settings.CHURN_DAYS,
    }
    metrics = {**model.metrics, **{f"importance_{k}": v for k, v in model.importances.items()}}
    return [("param", k, str(v)) for k, v in params.items()] + [
        ("metric", k, repr(float(v))) for k, v in metrics.items()
    ]
