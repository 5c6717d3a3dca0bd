"""Evaluation of saved models and of production predictions."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.operators.metrics import (
    class_distribution,
    class_share_change,
    classification_metrics,
    classification_report,
    confusion_matrix,
    prediction_statistics,
    roc_auc,
)
from plumbline.session import cut_lineage


def probability_array(df: DataFrame, column: str = "probability") -> Column:
    if isinstance(df.schema[column].dataType, VectorUDT):
        return vector_to_array(F.col(column))
    return F.col(column)


def score_labelled(model: Transformer, df: DataFrame) -> DataFrame:
    """``label, prediction, probability`` (array), stored once for the metrics to share."""
    scored = model.transform(df)
    columns = [F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")]
    if "probability" in scored.columns:
        columns.append(probability_array(scored).alias("probability"))
    return cut_lineage(scored.select(columns), "scored")


def all_metrics(scored: DataFrame) -> DataFrame:
    """Long metric table; AUC rows are present when probabilities are."""
    out = classification_metrics(scored, "label", "prediction")
    if "probability" in scored.columns:
        out = out.unionByName(roc_auc(scored, "label", F.col("probability")))
    return out


def evaluate_model(model: Transformer, test: DataFrame) -> dict[str, DataFrame]:
    """Metrics, report and confusion matrix of a model on a labelled table."""
    scored = score_labelled(model, test)
    return {
        "metrics": all_metrics(scored),
        "report": classification_report(scored, "label", "prediction"),
        "confusion": confusion_matrix(scored, "label", "prediction"),
    }


def _distribution_rows(df: DataFrame, column: str) -> DataFrame:
    d = class_distribution(df, column).agg(
        F.max("total_samples").alias("total_samples"),
        F.max("num_classes").alias("num_classes"),
        F.max("class_imbalance_ratio").alias("class_imbalance_ratio"),
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in d.columns]
    )
    return d.select(F.inline(pairs))


def continuous_evaluation(model: Transformer, reference: DataFrame, predictions: DataFrame) -> DataFrame:
    """``metric, value`` rows: reference quality, production statistics, share changes.

    ``reference`` holds features and label, ``predictions`` a ``prediction``
    column. All reference rows are scored as one set.
    """
    scored = score_labelled(model, reference)
    name = F.when(F.col("label").isNull(), F.col("metric")).otherwise(F.concat_ws("_", "metric", "label"))
    quality = all_metrics(scored).where("metric not in ('total_samples', 'num_classes')")
    quality = quality.select(F.concat(F.lit("reference_"), name).alias("metric"), "value")
    stats = prediction_statistics(predictions).select(
        F.lit("production_total_predictions").alias("metric"), F.col("total_predictions").cast("double").alias("value")
    )

    def prefixed(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(F.concat(F.lit(prefix), F.col("metric")).alias("metric"), "value")

    predicted = predictions.select(F.col("prediction").cast("int").alias("prediction"))
    change = class_share_change(scored, predicted, "label", "prediction").select(
        F.format_string("class_%d_proportion_change", "class").alias("metric"), F.col("change").alias("value")
    )
    return (
        quality.unionByName(prefixed(_distribution_rows(scored, "label"), "reference_"))
        .unionByName(stats)
        .unionByName(prefixed(_distribution_rows(predicted, "prediction"), "production_"))
        .unionByName(change)
    )
