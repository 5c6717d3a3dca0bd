"""Column profiles: moments, quantiles, modes, histograms."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from plumbline.functions.terms import share
from plumbline.operators.ranks import drop_nan, exact_quantiles, melt
from plumbline.schemas import NOT_FEATURES, category_columns, numeric_columns
from plumbline.session import broadcast_checked, one_row

# Fence width in interquartile ranges and the binning constants.
FENCE = 1.5
BINS = 10
LOWERING = 0.001
DISPLAY_BINS = 30


def numeric_long(df: DataFrame, columns: list[str], side: str | None = None) -> DataFrame:
    """``[side,] feature, value`` with NaN turned into null; nulls are kept."""
    long = melt(df, columns, "double").withColumn("value", drop_nan(F.col("value")))
    return long if side is None else long.withColumn("side", F.lit(side))


def moments(long: DataFrame, by: list[str]) -> DataFrame:
    """Per group, in one pass: count, missing, mean, sample std, min, max, skewness and
    excess kurtosis.

    There is a row per column (and side), so the table is fetched and kept
    while the other passes use it; more rows than can be fetched stay a plan.
    """
    v = F.col("value")
    table = long.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.skewness(v).alias("skewness"),
        F.kurtosis(v).alias("kurtosis"),
        F.count_if(v.isNull()).alias("missing_count"),
        F.count(v).alias("n"),
        F.min(v).alias("first"),
        F.max(v).alias("last"),
    )
    return broadcast_checked(table)


QUARTILES = [0.25, 0.5, 0.75]


def numeric_profile(df: DataFrame, columns: list[str], literal_missing: bool = False) -> DataFrame:
    """One row per numeric column; a column without values has no row.

    ``literal_missing`` reports missing values as counted after they have been
    dropped, that is 0.
    """
    long = numeric_long(df, columns)
    m = moments(long, ["feature"])
    quartiles = exact_quantiles(long, "value", QUARTILES, by=["feature"], bounded=True).drop("n")
    out = m.where("n > 0").join(F.broadcast(quartiles), "feature")
    missing = F.lit(0) if literal_missing else F.col("missing_count")
    return out.select(
        "feature",
        F.lit("numerical").alias("type"),
        "n",
        "mean",
        "std",
        F.col("q1").alias("median"),
        F.col("first").alias("min"),
        F.col("last").alias("max"),
        F.col("q0").alias("q25"),
        F.col("q2").alias("q75"),
        (F.col("q2") - F.col("q0")).alias("iqr"),
        "skewness",
        "kurtosis",
        missing.cast("bigint").alias("missing_count"),
        (missing / F.col("n_rows")).alias("missing_pct"),
    )


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``feature, value, n`` for many columns in one shuffle; nulls are a value."""
    return melt(df, columns, "string").groupBy("feature", "value").agg(F.count("*").alias("n"))


def categorical_profile(df: DataFrame, columns: list[str], literal_missing: bool = False) -> DataFrame:
    """One row per text column: distinct values, the mode and its share, missing.

    A tie for the mode goes to the smallest value.
    """
    present = F.col("value").isNotNull()
    out = (
        category_counts(df, columns)
        .groupBy("feature")
        .agg(
            F.count("value").alias("unique_count"),
            F.sum(F.when(present, F.col("n"))).alias("n"),
            F.sum("n").alias("n_rows"),
            F.min_by("value", F.when(present, F.struct(-F.col("n"), F.col("value")))).alias("most_frequent"),
            F.max(F.when(present, F.col("n"))).alias("mode_rows"),
        )
        .where("unique_count > 0")
    )
    missing = F.lit(0) if literal_missing else F.col("n_rows") - F.col("n")
    return out.select(
        "feature",
        F.lit("categorical").alias("type"),
        "n",
        "unique_count",
        "most_frequent",
        share(F.col("mode_rows"), F.col("n")).alias("most_frequent_pct"),
        missing.cast("bigint").alias("missing_count"),
        (missing / F.col("n_rows")).alias("missing_pct"),
    )


@dataclass
class Profile:
    """What a reference table looks like, to check later tables against.

    ``features`` has one row per column with values, ``values`` the count of
    every value of the text columns. Neither needs the table any more.
    """

    features: DataFrame
    values: DataFrame

    def save(self, folder: str) -> None:
        self.features.write.mode("overwrite").parquet(f"{folder}/features")
        self.values.write.mode("overwrite").parquet(f"{folder}/values")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> "Profile":
        return Profile(spark.read.parquet(f"{folder}/features"), spark.read.parquet(f"{folder}/values"))


def reference_profile(df: DataFrame, skip: tuple[str, ...] = NOT_FEATURES, literal_missing: bool = False) -> Profile:
    """Profile of every feature of a table."""
    numeric, text = numeric_columns(df.schema, skip), category_columns(df.schema, skip)
    if not numeric and not text:
        raise ValueError("the table has no feature columns")
    parts = []
    if numeric:
        parts.append(numeric_profile(df, numeric, literal_missing))
    if text:
        parts.append(categorical_profile(df, text, literal_missing))
        values = category_counts(df, text)
    else:
        values = df.sparkSession.createDataFrame([], "feature string, value string, n bigint")
    features = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return Profile(features, values)


def fences(quartiles: DataFrame, by: list[str]) -> DataFrame:
    """Outlier fences from ``q0`` (lower quartile) and ``q1`` (upper quartile)."""
    width = (F.col("q1") - F.col("q0")) * FENCE
    return quartiles.select(*by, (F.col("q0") - width).alias("low_fence"), (F.col("q1") + width).alias("high_fence"))


def outlier_shares(long: DataFrame) -> DataFrame:
    """Share of values beyond the data's own fences, per feature."""
    quartiles = exact_quantiles(long, "value", [0.25, 0.75], by=["feature"], bounded=True)
    limits = fences(quartiles, ["feature"])
    outside = (F.col("value") < F.col("low_fence")) | (F.col("value") > F.col("high_fence"))
    return (
        long.where(F.col("value").isNotNull())
        .join(F.broadcast(limits), "feature")
        .groupBy("feature")
        .agg(F.count_if(outside).alias("outliers"), F.avg(outside.cast("double")).alias("outlier_pct"))
    )


def box_stats(df: DataFrame, column: str) -> DataFrame:
    """One row: quartiles, median, and whiskers at the outermost values inside the fences."""
    long = numeric_long(df, [column]).where(F.col("value").isNotNull())
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75])
    limits = one_row(fences(q.select("q0", F.col("q2").alias("q1")), []))
    whiskers = one_row(
        long.where((F.col("value") >= limits["low_fence"]) & (F.col("value") <= limits["high_fence"])).agg(
            F.min("value").alias("low"), F.max("value").alias("high")
        )
    )
    return q.select(
        "n",
        F.col("q0").alias("q25"),
        F.col("q1").alias("median"),
        F.col("q2").alias("q75"),
        whiskers["low"].alias("whisker_low"),
        whiskers["high"].alias("whisker_high"),
    )


def value_ends(long: DataFrame) -> DataFrame:
    """``feature, first, last``: the smallest and largest value."""
    rows = long.where(F.col("value").isNotNull()).groupBy("feature")
    return rows.agg(F.min("value").alias("first"), F.max("value").alias("last"))


def bin_edges(ends: DataFrame, bins: int = BINS) -> DataFrame:
    """Equal-width, right-closed edges per feature: ``feature, edges``.

    The first edge is lowered by a thousandth of the range; a constant column
    is widened by a thousandth of its value on both sides instead.
    """
    flat = F.col("first") == F.col("last")
    pad = F.when(F.col("first") == 0, F.lit(LOWERING)).otherwise(F.abs(F.col("first")) * LOWERING)
    ends = ends.select(
        "feature",
        F.when(flat, F.col("first") - pad).otherwise(F.col("first")).alias("lo"),
        F.when(flat, F.col("last") + pad).otherwise(F.col("last")).alias("hi"),
        F.when(flat, F.lit(0.0)).otherwise((F.col("last") - F.col("first")) * LOWERING).alias("drop"),
    )
    step = (F.col("hi") - F.col("lo")) / bins
    edges = [F.col("lo") - F.col("drop")] + [F.col("lo") + i * step for i in range(1, bins)] + [F.col("hi")]
    return ends.select("feature", F.array(*edges).alias("edges"))


def bin_number(value: Column, edges: Column, bins: int = BINS) -> Column:
    """1-based bin; null outside the edges. The lowest edge belongs to bin 1."""
    above = sum((value > F.get(edges, F.lit(i))).cast("int") for i in range(1, bins))
    inside = (value >= F.get(edges, F.lit(0))) & (value <= F.get(edges, F.lit(bins)))
    return F.when(inside, F.lit(1) + above)


def bin_counts(tagged: DataFrame, bins: int = BINS, ends: DataFrame | None = None) -> DataFrame:
    """``feature, bin, n_ref, n_prod`` on edges fixed by the reference rows.

    ``tagged`` has ``side, feature, value``; production values outside the
    edges are dropped. ``ends`` are the reference's ``value_ends``, if known.
    """
    if ends is None:
        ends = value_ends(tagged.where("side = 'ref'"))
    edges = F.broadcast(bin_edges(ends, bins))
    return (
        tagged.where(F.col("value").isNotNull())
        .join(edges, "feature")
        .withColumn("bin", bin_number(F.col("value"), F.col("edges"), bins))
        .where("bin is not null")
        .groupBy("feature", "bin")
        .agg(F.count_if(F.col("side") == "ref").alias("n_ref"), F.count_if(F.col("side") == "prod").alias("n_prod"))
    )


def histogram(df: DataFrame, column: str, bins: int = BINS) -> DataFrame:
    """``bin, n`` on the column's own equal-width right-closed bins; empty bins are absent."""
    counts = bin_counts(numeric_long(df, [column], "ref"), bins)
    return counts.select("bin", F.col("n_ref").alias("n"))


def display_histogram(df: DataFrame, column: str, bins: int = DISPLAY_BINS) -> DataFrame:
    """``bin, bin_start, n`` on left-closed equal-width bins, the last one closed."""
    long = numeric_long(df, [column]).where(F.col("value").isNotNull())
    ends = one_row(long.agg(F.min("value").alias("lo"), F.max("value").alias("hi")))
    x = long.select("value", ends.alias("e")).select(
        "value", F.col("e.lo").alias("lo"), ((F.col("e.hi") - F.col("e.lo")) / bins).alias("w")
    )
    slot = F.when(F.col("w") > 0, F.least(F.floor((F.col("value") - F.col("lo")) / F.col("w")), F.lit(bins - 1)))
    return (
        x.select(F.coalesce(slot, F.lit(0)).cast("int").alias("bin"), "lo", "w")
        .groupBy("bin", "lo", "w")
        .agg(F.count("*").alias("n"))
        .select("bin", (F.col("lo") + F.col("bin") * F.col("w")).alias("bin_start"), "n")
    )


def range_by_class(df: DataFrame, value: str, by: str) -> DataFrame:
    """Min, max and count of a value per class."""
    return df.groupBy(by).agg(
        F.min(value).alias("min"), F.max(value).alias("max"), F.count(value).alias("n")
    )


def share_over(column: str, *by: str) -> Column:
    """A row's share of its group's total; for groups of a few rows (bins, classes)."""
    return share(F.col(column), F.sum(column).over(Window.partitionBy(*by)))
