"""The drift monitor, its alerts, and the tables shown next to it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline.functions.labels import class_code, fixed_format
from plumbline.functions.terms import CARDINALITY_SCALE, CATEGORICAL_SCALE
from plumbline.operators.counts import count_table
from plumbline.operators.drift import (
    cardinality_ratio,
    category_summary,
    categorical_psi,
    ks_by_feature,
    numerical_psi_by_feature,
    prediction_kl,
    share,
    tagged_numbers,
)
from plumbline.operators.profile import moments
from plumbline.operators.ranks import exact_quantiles
from plumbline.operators.validate import validate, validation_summary
from plumbline.functions import terms
from plumbline.schemas import NOT_FEATURES, category_columns, numeric_columns
from plumbline.session import one_row


@dataclass(frozen=True)
class MonitorConfig:
    """Columns, thresholds and divisors of the monitor."""

    # The default columns, thresholds and alert limits.
    category: str = "district"
    high_cardinality: str = "address"
    targets: tuple[str, ...] = ("price_category", "target")
    prediction: str = "prediction"
    psi_threshold: float = 0.25
    cardinality_threshold: float = 1.3
    kl_threshold: float = 0.15
    psi_scale: float = CATEGORICAL_SCALE * 3
    feature_psi_scale: float = CATEGORICAL_SCALE * 4
    warning_share: float = 0.8
    retrain_alerts: int = 3


METRICS = ("category_psi", "cardinality_ratio", "prediction_kl")


def _constant(df: DataFrame, value: float) -> DataFrame:
    """A one-row default that reads no data."""
    return df.sparkSession.range(1).select(F.lit(value).alias("value"))


def drift_metrics(ref: DataFrame, inputs: DataFrame, preds: DataFrame, cfg: MonitorConfig = MonitorConfig()) -> DataFrame:
    """Three rows ``metric, value, threshold, alert``.

    A measure whose column is missing on a side takes its neutral value:
    0 for the shares, 1 for the ratio.
    """
    if cfg.category in ref.columns and cfg.category in inputs.columns:
        psi = categorical_psi(ref, inputs, cfg.category, cfg.psi_scale).select(F.col("psi").alias("value"))
    else:
        psi = _constant(ref, 0.0)
    if cfg.high_cardinality in ref.columns and cfg.high_cardinality in inputs.columns:
        ratio = cardinality_ratio(ref, inputs, cfg.high_cardinality).select(
            F.col("cardinality_ratio").alias("value")
        )
    else:
        ratio = _constant(ref, 1.0)
    target = next((c for c in cfg.targets if c in ref.columns), None)
    if target and cfg.prediction in preds.columns:
        classes = ref
        if isinstance(ref.schema[target].dataType, T.StringType):
            classes = ref.withColumn(target, class_code(F.col(target)))
        kl = prediction_kl(classes, preds, target, cfg.prediction).select(F.col("kl").alias("value"))
    else:
        kl = _constant(ref, 0.0)
    limits = (cfg.psi_threshold, cfg.cardinality_threshold, cfg.kl_threshold)
    rows = [
        part.select(F.lit(m).alias("metric"), F.col("value").cast("double").alias("value"), F.lit(t).alias("threshold"))
        for m, part, t in zip(METRICS, (psi, ratio, kl), limits)
    ]
    return rows[0].unionAll(rows[1]).unionAll(rows[2]).withColumn("alert", F.col("value") > F.col("threshold"))


def drift_summary(metrics: DataFrame) -> DataFrame:
    """One row: the three values, alerts, severity 0..3 and status."""
    names = ["stable", "low", "medium", "high"]
    out = metrics.agg(
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in METRICS],
        F.count_if("alert").alias("alerts"),
    )
    severity = F.least(F.col("alerts"), F.lit(3)).cast("int")
    return out.withColumn("drift_severity", severity).withColumn(
        "drift_status", F.get(F.array(*[F.lit(n) for n in names]), severity)
    )


def retrain_decision(metrics: DataFrame, checks: DataFrame, cfg: MonitorConfig = MonitorConfig()) -> DataFrame:
    """One row: drift and validation results together and the retrain flag.

    Severity counts drift alerts only; validation alerts are added afterwards.
    """
    v = validation_summary(checks)
    total = F.col("alerts") + F.when(~F.col("v.passed"), F.col("v.alerts")).otherwise(0)
    return drift_summary(metrics).withColumn("v", one_row(v)).select(
        F.col("alerts").alias("drift_alerts"),
        "drift_severity",
        "drift_status",
        F.col("v.passed").alias("feature_validation_passed"),
        F.col("v.alerts").alias("feature_validation_alerts"),
        F.col("v.warnings").alias("feature_validation_warnings"),
        total.alias("total_alerts"),
        (total >= cfg.retrain_alerts).alias("retrain"),
    )


def drift_report(metrics: DataFrame) -> DataFrame:
    """Display rows ``metric, value, threshold, status``."""
    shown = F.when(F.col("metric") == "cardinality_ratio", F.format_string("%.2f", "value")).otherwise(
        F.format_string("%.3f", "value")
    )
    return metrics.select(
        "metric", shown.alias("value"), "threshold", F.when(F.col("alert"), "❌").otherwise("✅").alias("status")
    )


def feature_statistics(
    ref: DataFrame,
    prod: DataFrame,
    cfg: MonitorConfig = MonitorConfig(),
    skip: tuple[str, ...] = ("target", "price_category"),
) -> DataFrame:
    """One row per feature present on both sides, numeric and text features alike.

    Missing values are left out first. Numeric features drift when the KS
    p-value is below 0.05, text features when their PSI exceeds the threshold.
    """
    there = set(prod.columns)
    numeric = [c for c in numeric_columns(ref.schema, skip) if c in there]
    text = [c for c in category_columns(ref.schema, skip) if c in there]
    parts = []
    if numeric:
        tagged = tagged_numbers(ref, prod, numeric)
        m = moments(tagged, ["side", "feature"])
        q = exact_quantiles(tagged, "value", [0.5], by=["side", "feature"], bounded=True).drop("n")
        ends = m.where("side = 'ref' and n > 0").select("feature", "first", "last")
        m = m.join(F.broadcast(q), ["side", "feature"])

        def of(side: str, field: str) -> Column:
            return F.max(F.when(F.col("side") == side, F.col(field)))

        fields = [("mean", "mean"), ("std", "std"), ("median", "q0")]
        wide = (
            m.groupBy("feature")
            .agg(
                of("ref", "n").alias("ref_n"),
                of("prod", "n").alias("prod_n"),
                *[of(s, f).alias(f"{s}_{name}") for name, f in fields for s in ("ref", "prod")],
            )
            .where("ref_n > 0 and prod_n > 0")
            .drop("ref_n", "prod_n")
        )
        psi = numerical_psi_by_feature(tagged, ends=ends)
        ks = ks_by_feature(tagged).drop("ref_n", "prod_n")
        parts.append(
            wide.join(F.broadcast(psi), "feature")
            .join(F.broadcast(ks), "feature")
            .withColumn("type", F.lit("numerical"))
        )
    if text:
        counts = count_table(ref, prod, text).where("value is not null")
        s = category_summary(counts).where("ref_rows > 0 and prod_rows > 0")
        psi = (
            counts.join(F.broadcast(s.select("feature", "ref_rows", "prod_rows")), "feature")
            .withColumn(
                "term",
                terms.psi_term(share(F.col("n_ref"), F.col("ref_rows")), share(F.col("n_prod"), F.col("prod_rows"))),
            )
            .groupBy("feature")
            .agg(terms.scaled_sum(F.col("term"), cfg.feature_psi_scale).alias("psi"))
        )
        ratio = F.col("prod_unique") / F.greatest("ref_unique", F.lit(1)) / F.lit(CARDINALITY_SCALE)
        parts.append(
            s.select("feature", "ref_unique", "prod_unique", ratio.alias("cardinality_ratio"))
            .join(F.broadcast(psi), "feature")
            .withColumn("drift_detected", F.col("psi") > cfg.psi_threshold)
            .withColumn("type", F.lit("categorical"))
        )
    if not parts:
        raise ValueError("no feature is present on both sides")
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return out


def feature_table(stats: DataFrame) -> DataFrame:
    """Display form of the feature statistics."""
    return stats.select(
        "feature",
        "type",
        F.round("psi", 4).alias("psi"),
        F.when(F.col("drift_detected"), "⚠️ Yes").otherwise("✅ No").alias("drift_detected"),
    )


def drifted(stats: DataFrame) -> DataFrame:
    return stats.where("drift_detected")


def alert_board(metrics: DataFrame, stats: DataFrame, cfg: MonitorConfig = MonitorConfig()) -> DataFrame:
    """``level, metric, value, threshold, message``: critical, alert and warning rows.

    Only the category PSI has a warning zone, from 80 % of its threshold up to
    the threshold itself.
    """
    psi, ratio = F.col("metric") == "category_psi", F.col("metric") == "cardinality_ratio"
    value = F.when(ratio, F.format_string("%.2f", "value")).otherwise(F.format_string("%.4f", "value"))
    limit = F.col("threshold").cast("string")
    near = psi & ~F.col("alert") & (F.col("value") > F.col("threshold") * cfg.warning_share)
    message = (
        F.when(near, F.concat(F.lit("Categories are close to shifting: PSI "), value, F.lit(", limit "), limit))
        .when(psi, F.concat(F.lit("Categories have shifted: PSI "), value, F.lit(", limit "), limit))
        .when(ratio, F.concat(F.lit("Distinct values have grown: ratio "), value, F.lit(", limit "), limit))
        .otherwise(F.concat(F.lit("Predictions have shifted: KL "), value, F.lit(", limit "), limit))
    )
    system = metrics.where(F.col("alert") | near).select(
        F.when(F.col("alert"), "critical").otherwise("warning").alias("level"),
        "metric",
        value.alias("value"),
        limit.alias("threshold"),
        message.alias("message"),
    )
    features = drifted(stats).select(
        F.lit("alert").alias("level"),
        F.concat(F.lit("Feature: "), F.col("feature")).alias("metric"),
        F.concat(F.lit("PSI: "), fixed_format(F.col("psi"))).alias("value"),
        F.lit("N/A").alias("threshold"),
        F.concat(F.lit("Feature "), F.col("feature"), F.lit(" has shifted")).alias("message"),
    )
    return system.unionByName(features)


def overview(preds: DataFrame, latest_run: DataFrame, model_runs: DataFrame, cfg: MonitorConfig = MonitorConfig()) -> DataFrame:
    """One row: total predictions, active alerts, PSI with its flag, latest accuracy.

    ``latest_run`` has at most one row with ``total_alerts`` and
    ``category_psi``; ``model_runs`` has ``start_time`` and ``accuracy``.
    """
    run = one_row(
        latest_run.agg(
            F.max("total_alerts").cast("bigint").alias("alerts"), F.max("category_psi").alias("psi")
        )
    )
    accuracy = one_row(model_runs.agg(F.max_by("accuracy", "start_time").alias("accuracy")))["accuracy"]
    return preds.agg(F.count("*").alias("total_predictions")).withColumn("run", run).select(
        "total_predictions",
        F.col("run.alerts").alias("active_alerts"),
        F.col("run.psi").alias("category_psi"),
        (F.col("run.psi") > cfg.psi_threshold).alias("has_drift"),
        fixed_format(accuracy, 3).alias("accuracy"),
    )


@dataclass
class MonitorResult:
    metrics: DataFrame
    checks: DataFrame
    decision: DataFrame
    report: DataFrame


def monitor(ref: DataFrame, inputs: DataFrame, preds: DataFrame, cfg: MonitorConfig = MonitorConfig()) -> MonitorResult:
    """The whole monitoring run; only the small profile tables are computed at once."""
    metrics = drift_metrics(ref, inputs, preds, cfg)
    checks = validate(ref, inputs, skip=(*NOT_FEATURES, "request_id"))
    return MonitorResult(metrics, checks, retrain_decision(metrics, checks, cfg), drift_report(metrics))
