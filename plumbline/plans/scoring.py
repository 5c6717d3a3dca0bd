"""Scoring of request tables; the same plan serves batches and streams."""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import DataFrame, functions as F

from plumbline.functions.cleaning import add_crosses
from plumbline.functions.labels import class_name
from plumbline.schemas import REQUEST
from plumbline.sources.logs import append_log


def score(valid: DataFrame, transforms: PipelineModel, model: Transformer) -> DataFrame:
    """Cross, transform and predict; adds ``prediction`` and ``price_category``.

    Requests arrive cleaned, so the text cleaners are not applied.
    """
    scored = model.transform(transforms.transform(add_crosses(valid)))
    code = F.col("prediction").cast("int")
    return scored.select(
        *[F.col(f"`{c}`") for c in valid.columns], code.alias("prediction"), class_name(code).alias("price_category")
    )


def log_scored(scored: DataFrame, inputs_path: str, predictions_path: str) -> None:
    """Append inputs and predictions, joined by their request id."""
    append_log(scored.select("request_id", *REQUEST.names), inputs_path)
    append_log(scored.select("request_id", "prediction"), predictions_path)
