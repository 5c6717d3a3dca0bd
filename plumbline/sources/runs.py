"""The run-metrics store: long on write, wide on read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from plumbline.schemas import RUN_METRICS
from plumbline.sources.tables import read_or_empty

# Metric names of the two dashboards.
MONITOR_KEYS = [
    "category_psi",
    "cardinality_ratio",
    "prediction_kl",
    "total_alerts",
    "drift_severity",
    "feature_validation_alerts",
]
MODEL_KEYS = [
    "accuracy",
    "macro_precision",
    "macro_recall",
    "macro_f1",
    "weighted_precision",
    "weighted_recall",
    "weighted_f1",
    "roc_auc_macro",
    "roc_auc_weighted",
    "precision_low",
    "recall_low",
    "f1_low",
    "precision_medium",
    "recall_medium",
    "f1_medium",
    "precision_high",
    "recall_high",
    "f1_high",
]
TREND_KEYS = ["accuracy", "macro_precision", "macro_recall", "macro_f1"]
CLASSES = ["low", "medium", "high"]


def _stamp(run: dict) -> Column:
    """The run's start time; the time of writing for a run that names none."""
    return F.lit(run["start_time"]).cast("timestamp") if "start_time" in run else F.current_timestamp()


def metric_rows(df: DataFrame, run: dict[str, str], key: str = "metric", value: str = "value") -> DataFrame:
    """Numeric metrics of one run in the store's schema; missing values are left out."""
    return df.where(F.col(value).isNotNull()).select(
        F.lit(run["run_id"]).alias("run_id"),
        F.lit(run["experiment"]).alias("experiment"),
        F.lit(run["run_name"]).alias("run_name"),
        _stamp(run).alias("start_time"),
        F.lit("metric").alias("kind"),
        F.col(key).alias("key"),
        F.col(value).cast("double").alias("num_value"),
        F.lit(None).cast("string").alias("str_value"),
    )


def param_rows(spark: SparkSession, params: dict[str, object], run: dict[str, str]) -> DataFrame:
    """String parameters of one run in the store's schema."""
    pairs = spark.createDataFrame([(k, str(v)) for k, v in params.items()], "key string, str_value string")
    return pairs.select(
        F.lit(run["run_id"]).alias("run_id"),
        F.lit(run["experiment"]).alias("experiment"),
        F.lit(run["run_name"]).alias("run_name"),
        _stamp(run).alias("start_time"),
        F.lit("param").alias("kind"),
        "key",
        F.lit(None).cast("double").alias("num_value"),
        "str_value",
    )


def append_run(rows: DataFrame, path: str) -> None:
    rows.select(RUN_METRICS.names).write.mode("append").partitionBy("experiment").parquet(path)


def read_runs(spark: SparkSession, path: str, experiment: str | None = None) -> DataFrame:
    runs = read_or_empty(spark, path, RUN_METRICS)
    return runs if experiment is None else runs.where(F.col("experiment") == experiment)


def latest_runs(
    runs: DataFrame, keys: list[str], limit: int = 10, zero_fill: bool = False, params: list[str] | None = None
) -> DataFrame:
    """The newest ``limit`` runs, one row each, one column per key.

    The newest runs are found first, so only their rows are pivoted.
    """
    newest = (
        runs.groupBy("run_id").agg(F.max("start_time").alias("start_time"))
        .orderBy(F.desc("start_time"), "run_id").limit(limit)
    )
    rows = runs.drop("start_time").join(F.broadcast(newest), "run_id")
    wide = rows.groupBy("run_id", "start_time").agg(
        *[F.max(F.when((F.col("kind") == "metric") & (F.col("key") == k), F.col("num_value"))).alias(k) for k in keys],
        *[F.max(F.when((F.col("kind") == "param") & (F.col("key") == k), F.col("str_value"))).alias(k) for k in params or []],
    )
    return wide.na.fill(0.0, subset=keys) if zero_fill else wide


def latest_run(wide: DataFrame) -> DataFrame:
    return wide.orderBy(F.desc("start_time"), "run_id").limit(1)


def run_index(wide: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Adds ``run_index`` 0, 1, … oldest first, over the few runs of a wide table."""
    if required:
        wide = wide.na.drop(subset=required)
    order = Window.partitionBy(F.lit(0)).orderBy("start_time", "run_id")
    return wide.withColumn("run_index", (F.row_number().over(order) - 1).cast("int"))


def metric_series(indexed: DataFrame, keys: list[str] = TREND_KEYS) -> DataFrame:
    """``metric, run_index, value`` points; a gap keeps the other runs' index."""
    points = F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("value")) for k in keys])
    return indexed.select("run_index", F.inline(points)).where("value is not null")


def class_metric_rows(latest: DataFrame, classes: list[str] = CLASSES) -> DataFrame:
    """``class, precision, recall, f1`` of one run; classes without precision are left out."""
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("class"),
                F.col(f"precision_{c}").alias("precision"),
                F.col(f"recall_{c}").alias("recall"),
                F.col(f"f1_{c}").alias("f1"),
            )
            for c in classes
        ]
    )
    return latest.select(F.inline(rows)).where("precision is not null")


def latest_version(versions: DataFrame, name: str, version: str) -> DataFrame:
    """Per model the row of the numerically largest version."""
    rest = [c for c in versions.columns if c != name]
    best = versions.groupBy(name).agg(
        F.max_by(F.struct(*rest), F.col(version).try_cast("bigint")).alias("best")
    )
    return best.select(name, "best.*")
