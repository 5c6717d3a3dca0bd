"""Checks of production columns against a reference profile."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.operators.counts import align_with_counts, count_table
from plumbline.operators.drift import category_summary
from plumbline.operators.profile import Profile, moments, numeric_long, outlier_shares
from plumbline.schemas import NOT_FEATURES, category_columns, numeric_columns

# Limits of the checks.
TOLERANCE = 0.1
SKEW_LIMIT = 2.0
HIGH_SHIFT = 0.2
OUTLIER_LIMIT = 0.05
MISSING_LIMIT = 0.05
NEW_VALUE_LIMIT = 0.1
P_LIMIT = 0.05
FLOOR = 1e-6

COLUMNS = [
    "feature",
    "type",
    "check",
    "status",
    "level",
    "severity",
    "ref_value",
    "prod_value",
    "value",
    "message",
]


def _row(check, status, level, severity, ref_value, prod_value, value, message) -> Column:
    def text(x):
        return x if isinstance(x, Column) else F.lit(x).cast("string")

    def number(x):
        return (x if isinstance(x, Column) else F.lit(x)).cast("double")

    return F.struct(
        F.lit(check).alias("check"),
        text(status).alias("status"),
        text(level).alias("level"),
        text(severity).alias("severity"),
        number(ref_value).alias("ref_value"),
        number(prod_value).alias("prod_value"),
        number(value).alias("value"),
        text(message).alias("message"),
    )


def _percent(x: Column) -> Column:
    return F.format_string("%.2f%%", x * 100.0)


def _rows_of(df: DataFrame, checks: list[Column]) -> DataFrame:
    """One output row per check that applies."""
    listed = F.filter(F.array(*checks), lambda c: c.isNotNull())
    return df.select("feature", "type", F.inline(listed)).select(COLUMNS)


def _empty_check() -> Column:
    return _row(
        "empty_column", "failed", "alert", None, None, None, None,
        F.concat(F.lit("Production has no value in "), F.col("feature")),
    )


def numeric_checks(
    stats: DataFrame,
    prod: DataFrame,
    columns: list[str],
    tolerance: float = TOLERANCE,
    skew_limit: float = SKEW_LIMIT,
    literal_missing: bool = False,
) -> DataFrame:
    """Checks of numeric columns; ``stats`` has the reference's ``feature, mean, std, skewness, missing_pct``."""
    long = numeric_long(prod, columns)
    now = moments(long, ["feature"])
    missing = F.lit(0.0) if literal_missing else F.col("missing_count") / F.col("n_rows")
    p = now.select(
        "feature",
        F.col("n").alias("p_n"),
        F.col("mean").alias("p_mean"),
        F.col("std").alias("p_std"),
        F.col("skewness").alias("p_skewness"),
        missing.alias("p_missing"),
    )
    r = stats.select(
        "feature",
        F.col("mean").alias("r_mean"),
        F.col("std").alias("r_std"),
        F.col("skewness").alias("r_skewness"),
        (F.lit(0.0) if literal_missing else F.col("missing_pct")).alias("r_missing"),
    )
    f = (
        r.where(F.col("feature").isin(columns))
        .join(F.broadcast(p), "feature", "left")
        .join(F.broadcast(outlier_shares(long)), "feature", "left")
        .withColumn("type", F.lit("numerical"))
        .withColumn("mean_shift", F.abs(F.col("p_mean") - F.col("r_mean")) / F.greatest(F.abs("r_mean"), F.lit(FLOOR)))
        .withColumn("std_shift", F.abs(F.col("p_std") - F.col("r_std")) / F.greatest("r_std", F.lit(FLOOR)))
    )
    moved = F.col("mean_shift") > tolerance
    checks = [
        F.when(F.coalesce("p_n", F.lit(0)) == 0, _empty_check()),
        F.when(
            F.col("p_n") > 0,
            _row(
                "mean_shift",
                F.when(moved, "failed").otherwise("passed"),
                F.when(moved, "alert").otherwise("pass"),
                F.when(moved, F.when(F.col("mean_shift") > HIGH_SHIFT, "high").otherwise("medium")),
                F.col("r_mean"),
                F.col("p_mean"),
                F.col("mean_shift"),
                F.when(moved, F.concat(F.lit("The mean moved by "), _percent(F.col("mean_shift")))),
            ),
        ),
        F.when(
            F.col("std_shift") > tolerance,
            _row(
                "std_shift", "failed", "warning", None, F.col("r_std"), F.col("p_std"), F.col("std_shift"),
                F.concat(F.lit("The standard deviation moved by "), _percent(F.col("std_shift"))),
            ),
        ),
        F.when(
            F.col("outlier_pct") > OUTLIER_LIMIT,
            _row(
                "outliers", "warning", "warning", None, None, F.col("outliers"), F.col("outlier_pct"),
                F.concat(_percent(F.col("outlier_pct")), F.lit(" of the values lie outside the fences")),
            ),
        ),
        F.when(
            F.abs("p_skewness") > skew_limit,
            _row(
                "skewness", "warning", "warning", None, F.col("r_skewness"), F.col("p_skewness"), F.col("p_skewness"),
                F.format_string("Skewness %.2f is beyond the limit", F.col("p_skewness")),
            ),
        ),
        F.when(
            (F.col("p_n") > 0) & (F.col("p_missing") > F.col("r_missing") + MISSING_LIMIT),
            _row(
                "missing_values", "warning", "warning", None, F.col("r_missing"), F.col("p_missing"),
                F.col("p_missing"),
                F.concat(
                    F.lit("Missing share "), _percent(F.col("p_missing")),
                    F.lit(" against "), _percent(F.col("r_missing")),
                ),
            ),
        ),
    ]
    return _rows_of(f, checks)


def category_checks(counts: DataFrame) -> DataFrame:
    """Checks of text columns from the aligned counts of both tables.

    Messages give the number of new values; ``counts.new_values`` lists them all.
    """
    f = (
        category_summary(counts)
        .where("ref_rows > 0")
        .withColumn("type", F.lit("categorical"))
        .withColumn("new_share", F.col("new_rows") / F.nullif(F.col("prod_rows").cast("double"), F.lit(0.0)))
    )
    high = F.col("new_share") > NEW_VALUE_LIMIT
    checks = [
        F.when(F.col("prod_rows") == 0, _empty_check()),
        F.when(
            F.col("new_values") > 0,
            _row(
                "new_categories",
                F.when(F.col("new_share") < NEW_VALUE_LIMIT, "warning").otherwise("failed"),
                F.when(high, "alert").otherwise("warning"),
                F.when(high, "high"),
                None,
                F.col("new_values"),
                F.col("new_share"),
                F.format_string(
                    "%d values unknown to the reference, in %.2f%% of the rows",
                    F.col("new_values"),
                    F.col("new_share") * 100.0,
                ),
            ),
        ),
        F.when(
            F.col("chi2_pvalue") < P_LIMIT,
            _row(
                "distribution_shift", "failed", "alert", "medium", F.col("chi2_df"), F.col("chi2"),
                F.col("chi2_pvalue"),
                F.format_string("Shares differ from the reference, p = %.4f", F.col("chi2_pvalue")),
            ),
        ),
    ]
    return _rows_of(f, checks)


def missing_column_checks(features: DataFrame) -> DataFrame:
    """Warnings for ``feature, type`` rows that production lacks."""
    message = F.concat(F.lit("Production lacks the column "), F.col("feature"))
    return _rows_of(features, [_row("missing_column", "warning", "warning", None, None, None, None, message)])


def _present(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """``feature, type`` of the columns that have any value."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in kinds])
    rows = [
        F.struct(F.lit(c).alias("feature"), F.lit(kind).alias("type"), F.col(f"`{c}`").alias("n"))
        for c, kind in kinds.items()
    ]
    return counts.select(F.inline(F.array(*rows))).where("n > 0").select("feature", "type")


def _stacked(parts: list[DataFrame]) -> DataFrame:
    if not parts:
        raise ValueError("the reference has no feature columns")
    return reduce(DataFrame.unionByName, parts)


def validate(
    ref: DataFrame,
    prod: DataFrame,
    tolerance: float = TOLERANCE,
    skew_limit: float = SKEW_LIMIT,
    literal_missing: bool = False,
    skip: tuple[str, ...] = NOT_FEATURES,
) -> DataFrame:
    """All checks of all features, one row each.

    ``level`` is ``alert``, ``warning`` or ``pass``; production passes when no
    row is an alert. The numeric columns share one set of scans, the text
    columns another, whatever their number.
    """
    numeric, text = numeric_columns(ref.schema, skip), category_columns(ref.schema, skip)
    there = set(prod.columns)
    parts = []
    columns = [c for c in numeric if c in there]
    if columns:
        stats = moments(numeric_long(ref, columns), ["feature"]).where("n > 0")
        stats = stats.withColumn("missing_pct", F.col("missing_count") / F.col("n_rows"))
        parts.append(numeric_checks(stats, prod, columns, tolerance, skew_limit, literal_missing))
    columns = [c for c in text if c in there]
    if columns:
        parts.append(category_checks(count_table(ref, prod, columns)))
    absent = {c: "numerical" for c in numeric if c not in there} | {c: "categorical" for c in text if c not in there}
    if absent:
        parts.append(missing_column_checks(_present(ref, absent)))
    return _stacked(parts)


def validate_against(
    profile: Profile,
    prod: DataFrame,
    tolerance: float = TOLERANCE,
    skew_limit: float = SKEW_LIMIT,
    literal_missing: bool = False,
) -> DataFrame:
    """As ``validate``, against a stored profile: the reference is not read again."""
    kinds = dict(tuple(r) for r in profile.features.select("feature", "type").collect())
    there = set(prod.columns)
    parts = []
    columns = [c for c, kind in kinds.items() if kind == "numerical" and c in there]
    if columns:
        parts.append(numeric_checks(profile.features, prod, columns, tolerance, skew_limit, literal_missing))
    columns = [c for c, kind in kinds.items() if kind == "categorical" and c in there]
    if columns:
        parts.append(category_checks(align_with_counts(profile.values, prod, columns)))
    absent = [c for c in kinds if c not in there]
    if absent:
        parts.append(missing_column_checks(profile.features.where(F.col("feature").isin(absent))))
    return _stacked(parts)


def validation_summary(checks: DataFrame) -> DataFrame:
    """One row ``passed, alerts, warnings``."""
    return checks.agg(
        F.count_if(F.col("level") == "alert").alias("alerts"),
        F.count_if(F.col("level") == "warning").alias("warnings"),
    ).select((F.col("alerts") == 0).alias("passed"), "alerts", "warnings")


def validation_report(checks: DataFrame, shown: int = 5) -> DataFrame:
    """Report lines: status, counts, the first alerts, and how many more there are."""
    s = validation_summary(checks)
    lines = F.array(
        F.struct(F.lit(0).alias("line"), F.concat(F.lit("Status: "), F.when(F.col("passed"), "✅ Passed").otherwise("❌ Failed")).alias("text")),
        F.struct(F.lit(1).alias("line"), F.format_string("Alerts: %d", "alerts").alias("text")),
        F.struct(F.lit(2).alias("line"), F.format_string("Warnings: %d", "warnings").alias("text")),
    )
    head = s.select(F.inline(lines))
    first = checks.where("level = 'alert'").orderBy("feature", "check").limit(shown)
    listed = F.sort_array(F.collect_list(F.struct("feature", "check", "message")))
    alerts = first.agg(listed.alias("a")).select(F.posexplode("a").alias("i", "a"))
    alerts = alerts.select(
        (F.col("i") + 3).cast("int").alias("line"),
        F.concat(F.lit("- "), F.col("a.feature"), F.lit(" ("), F.col("a.check"), F.lit("): "), F.coalesce("a.message", F.lit("N/A"))).alias("text"),
    )
    more = s.where(F.col("alerts") > shown).select(
        F.lit(3 + shown).alias("line"), F.format_string("... and %d more alerts", F.col("alerts") - shown).alias("text")
    )
    return head.unionByName(alerts).unionByName(more)
