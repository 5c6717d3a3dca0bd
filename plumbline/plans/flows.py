"""Whole runs that are recorded: each table is written once, and what is recorded is gathered meanwhile."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from plumbline.operators.monitor import METRICS, MonitorConfig, drift_metrics
from plumbline.operators.validate import validate
from plumbline.plans.evaluation import continuous_evaluation, evaluate_model
from plumbline.schemas import NOT_FEATURES
from plumbline.sources.runs import CLASSES, append_run, metric_rows, param_rows


@dataclass
class Run:
    """One run: its id and start time stand on every row, and all rows are appended together."""

    spark: SparkSession
    store: str
    experiment: str
    name: str
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    started: dt.datetime = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    values: dict[str, float] = field(default_factory=dict)
    params: dict[str, object] = field(default_factory=dict)

    def described(self) -> dict:
        return {"run_id": self.run_id, "experiment": self.experiment, "run_name": self.name, "start_time": self.started}

    def gather(self, df: DataFrame, path: str, **measures: Column) -> dict:
        """Write ``df`` to ``path`` and return the aggregates of its rows from that one pass."""
        seen = Observation()
        df.observe(seen, *[c.alias(k) for k, c in measures.items()]).write.mode("overwrite").parquet(path)
        return seen.get

    def record(self) -> None:
        """Append numbers and parameters; numbers that are missing or not finite are left out."""
        numbers = [(k, float(v)) for k, v in self.values.items() if v is not None and abs(v) != float("inf") and v == v]
        rows = metric_rows(self.spark.createDataFrame(numbers, "metric string, value double"), self.described())
        append_run(rows.unionByName(param_rows(self.spark, self.params, self.described())).coalesce(1), self.store)


def recorded_monitoring(
    ref: DataFrame,
    inputs: DataFrame,
    preds: DataFrame,
    store: str,
    folder: str,
    cfg: MonitorConfig = MonitorConfig(),
    skip: tuple[str, ...] = (*NOT_FEATURES, "request_id"),
) -> Run:
    """Monitor once: drift and checks are computed, stored and recorded in one pass each.

    Tables ``metrics`` and ``checks`` are written below ``folder`` under the run's id.
    """
    run = Run(ref.sparkSession, store, "monitoring", "monitor")
    path = f"{folder}/{run.run_id}"

    def of(metric: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col("value")))

    drift = run.gather(
        drift_metrics(ref, inputs, preds, cfg), f"{path}/metrics", **{m: of(m) for m in METRICS}, alerts=F.count_if("alert")
    )
    checks = run.gather(
        validate(ref, inputs, skip=skip),
        f"{path}/checks",
        alerts=F.count_if(F.col("level") == "alert"),
        warnings=F.count_if(F.col("level") == "warning"),
    )
    total = drift["alerts"] + checks["alerts"]
    run.values |= {m: drift[m] for m in METRICS}
    run.values |= {
        "drift_severity": min(drift["alerts"], 3),
        "feature_validation_alerts": checks["alerts"],
        "feature_validation_warnings": checks["warnings"],
        "total_alerts": total,
    }
    run.params |= {
        "drift_status": ("stable", "low", "medium", "high")[min(drift["alerts"], 3)],
        "feature_validation_passed": checks["alerts"] == 0,
        "retrain": total >= cfg.retrain_alerts,
    }
    run.record()
    return run


def metric_name() -> Column:
    """Name of a metric row in the run store: per-class metrics carry the class's name."""
    named = F.get(F.array(*[F.lit(c) for c in CLASSES]), F.col("label").try_cast("int"))
    return F.when(F.col("label").isNull(), F.col("metric")).otherwise(
        F.concat_ws("_", "metric", F.coalesce(named, F.col("label")))
    )


def recorded_training(
    train: DataFrame, test: DataFrame, fit: Callable[[DataFrame], Transformer], store: str, folder: str, **params: object
) -> tuple[Run, Transformer]:
    """Fit a model, evaluate it on the held-out rows and record its metrics."""
    run = Run(train.sparkSession, store, "training", "train")
    model = fit(train)
    found = evaluate_model(model, test)
    metrics = found["metrics"].select(metric_name().alias("metric"), "value")
    _gathered(run, metrics, f"{folder}/{run.run_id}/metrics")
    run.params |= {"model": type(model).__name__} | params
    run.record()
    return run, model


def recorded_evaluation(model: Transformer, ref: DataFrame, preds: DataFrame, store: str, folder: str) -> Run:
    """Continuous evaluation, recorded."""
    run = Run(ref.sparkSession, store, "evaluation", "continuous_evaluation")
    _gathered(run, continuous_evaluation(model, ref, preds), f"{folder}/{run.run_id}/evaluation")
    run.record()
    return run


def _gathered(run: Run, metrics: DataFrame, path: str) -> None:
    """A table of a few ``metric, value`` rows, stored and added to the run."""
    found = run.gather(metrics, path, rows=F.collect_list(F.struct("metric", "value")))
    run.values |= {r["metric"]: r["value"] for r in found["rows"]}
