"""From scraped listings to train and test feature tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from plumbline.functions.cleaning import add_crosses, clean_listings, price
from plumbline.operators.features import (
    HASH_SLOTS,
    SEED,
    TEST_SHARE,
    assign_classes,
    feature_pipeline,
    fit_quantile_edges,
    quantile_target,
    stratified_split,
)
from plumbline.schemas import ALL_FEATURES, TARGET
from plumbline.sources.artifacts import save_model
from plumbline.sources.tables import read_table, write_snapshot


@dataclass
class Prepared:
    """Where a preparation run left its results."""

    folder: str
    transforms: PipelineModel

    @property
    def snapshot(self) -> str:
        return f"{self.folder}/reference"

    @property
    def train(self) -> str:
        return f"{self.folder}/train"

    @property
    def test(self) -> str:
        return f"{self.folder}/test"


def clean_priced(raw: DataFrame) -> DataFrame:
    """Cleaned listings with crosses and a numeric price, one projection."""
    return add_crosses(clean_listings(raw)).withColumn("price", price(F.col("price")))


def label_listings(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Cleaned listings with the price class instead of the price.

    The class boundaries come from all rows, before any split.
    """
    return quantile_target(clean_priced(raw), "price", TARGET, strict=strict).drop("price")


def prepare(
    raw: DataFrame,
    key: str,
    folder: str,
    slots: int = HASH_SLOTS,
    snapshot_columns: list[str] | None = None,
    test_share: float = TEST_SHARE,
    seed: int = SEED,
) -> Prepared:
    """Clean, cross, label, snapshot, split, fit on train, transform, write.

    The snapshot has every row; rows without a price class, null there, stay out
    of train and test.

    ``key`` identifies a raw row. The raw text is parsed once: the cleaned table
    is written, and the boundaries, the split, the fit and the outputs all read
    the few columns they need from it.
    """
    spark = raw.sparkSession
    clean_priced(raw).write.mode("overwrite").parquet(f"{folder}/cleaned")
    cleaned = read_table(spark, f"{folder}/cleaned")
    edges = fit_quantile_edges(cleaned, "price")
    labelled = assign_classes(cleaned, "price", TARGET, edges).drop("price")
    rows = stratified_split(labelled.where(F.col(TARGET).isNotNull()), key, TARGET, test_share, seed)
    result = Prepared(folder, None)
    write_snapshot(labelled, result.snapshot, snapshot_columns or [*ALL_FEATURES, TARGET])
    train, test = rows.where(~F.col("is_test")), rows.where("is_test")
    result.transforms = feature_pipeline(slots=slots).fit(train)
    save_model(result.transforms, f"{folder}/transforms")
    for part, path in ((train, result.train), (test, result.test)):
        result.transforms.transform(part).select(
            F.col(key), "features", F.col(TARGET).cast("double").alias("label")
        ).write.mode("overwrite").parquet(path)
    return result
