"""Profiles kept per part of a table, such as a day, and merged without reading it again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.operators.profile import Profile, category_counts
from plumbline.operators.ranks import melt
from plumbline.schemas import NOT_FEATURES, category_columns, numeric_columns

# Size of the quantile sketch: ranks are within 0.7 % at 400, once in a hundred times not.
KLL_SIZE = 400
# Size of the distinct sketch as a power of two: counts are within 2 % mostly.
HLL_BITS = 12

NUMBERS = ["n_rows", "n", "mean", "m2", "m3", "m4", "first", "last", "quantiles"]


def numeric_state(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """``by…, feature, n_rows, n, mean, m2, m3, m4, first, last, quantiles``.

    ``m2`` to ``m4`` are sums of powers of the distances from the mean, ``quantiles``
    is a mergeable sketch. One pass over the rows for all columns.
    """
    long = melt(df, columns, "double", by)
    v = F.nanvl(F.col("value"), F.lit(None).cast("double"))
    n, variance = F.count(v), F.var_pop(v)
    skew, kurtosis = F.skewness(v), F.kurtosis(v)
    return long.groupBy(*by, "feature").agg(
        F.count("*").alias("n_rows"),
        n.alias("n"),
        F.avg(v).alias("mean"),
        (variance * n).alias("m2"),
        # Values that are all equal have no skewness, and no third power sum.
        F.coalesce(skew * n * F.pow(variance, 1.5), F.lit(0.0)).alias("m3"),
        F.coalesce((kurtosis + 3.0) * n * variance * variance, F.lit(0.0)).alias("m4"),
        F.min(v).alias("first"),
        F.max(v).alias("last"),
        F.kll_sketch_agg_double(v, F.lit(KLL_SIZE)).alias("quantiles"),
    )


def merged_numbers(states: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The state of the union of the parts whose ``numeric_state`` rows these are.

    Power sums move to the common mean by the distance of each part's own, so nothing
    is lost to cancellation however far the parts lie apart.
    """
    keys = [*(by or []), "feature"]
    own = Window.partitionBy(*keys)
    n, d = F.col("n"), F.coalesce(F.col("mean") - F.col("all_mean"), F.lit(0.0))
    m2, m3, m4 = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("m2", "m3", "m4"))
    # A row for each part and feature.
    placed = states.withColumn("all_mean", F.sum(F.col("mean") * n).over(own) / F.nullif(F.sum("n").over(own), F.lit(0)))
    sums = placed.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n").alias("n"),
        F.max("all_mean").alias("mean"),
        F.sum(m2 + n * d**2).alias("m2"),
        F.sum(m3 + 3 * d * m2 + n * d**3).alias("m3"),
        F.sum(m4 + 4 * d * m3 + 6 * d**2 * m2 + n * d**4).alias("m4"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )
    return sums.select(*keys, *NUMBERS)


def number_profile(state: DataFrame) -> DataFrame:
    """``numeric_profile`` of a merged state; quartiles are those of the sketch."""
    n, m2 = F.col("n").cast("double"), F.col("m2")
    spread = F.nullif(m2, F.lit(0.0))

    def quantile(p: float) -> Column:
        return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(p)))

    missing = (F.col("n_rows") - F.col("n")).cast("bigint")
    return state.where("n > 0").select(
        "feature",
        F.lit("numerical").alias("type"),
        "n",
        "mean",
        F.when(F.col("n") > 1, F.sqrt(m2 / (n - 1))).alias("std"),
        quantile(0.5).alias("median"),
        F.col("first").alias("min"),
        F.col("last").alias("max"),
        quantile(0.25).alias("q25"),
        quantile(0.75).alias("q75"),
        (quantile(0.75) - quantile(0.25)).alias("iqr"),
        (F.col("m3") / n / F.pow(spread / n, 1.5)).alias("skewness"),
        (F.col("m4") * n / (spread * spread) - 3.0).alias("kurtosis"),
        missing.alias("missing_count"),
        (missing / F.col("n_rows")).alias("missing_pct"),
    )


def text_profile(counts: DataFrame) -> DataFrame:
    """``categorical_profile`` of merged counts ``feature, value, n``."""
    present = F.col("value").isNotNull()
    out = counts.groupBy("feature").agg(
        F.count("value").alias("unique_count"),
        F.sum(F.when(present, F.col("n"))).alias("n"),
        F.sum("n").alias("n_rows"),
        F.min_by("value", F.when(present, F.struct(-F.col("n"), F.col("value")))).alias("most_frequent"),
        F.max(F.when(present, F.col("n"))).alias("mode_rows"),
    )
    missing = (F.col("n_rows") - F.col("n")).cast("bigint")
    return out.where("unique_count > 0").select(
        "feature",
        F.lit("categorical").alias("type"),
        "n",
        "unique_count",
        "most_frequent",
        (F.col("mode_rows") / F.col("n")).alias("most_frequent_pct"),
        missing.alias("missing_count"),
        (missing / F.col("n_rows")).alias("missing_pct"),
    )


class PartProfiles:
    """Profiles of the parts of a table in a folder, a part written once and read never again.

    Writing a part anew replaces it. ``profile`` merges any parts; missing parts are
    left out.
    """

    def __init__(self, folder: str):
        self.folder = folder

    def write(self, df: DataFrame, part: str, skip: tuple[str, ...] = NOT_FEATURES) -> None:
        """Store the state of one part of a table."""
        numeric, text = numeric_columns(df.schema, skip), category_columns(df.schema, skip)
        if numeric:
            self._replace(numeric_state(df, numeric, []), "numbers", part)
        if text:
            path = self._replace(category_counts(df, text), "values", part)
            kept = df.sparkSession.read.parquet(path)
            self._replace(kept.groupBy("feature").agg(F.hll_sketch_agg("value", F.lit(HLL_BITS)).alias("distinct")), "distinct", part)

    def _replace(self, df: DataFrame, kind: str, part: str) -> str:
        path = f"{self.folder}/{kind}/part={part}"
        df.write.mode("overwrite").parquet(path)
        return path

    def _read(self, spark, kind: str, parts: list[str] | None) -> DataFrame:
        rows = spark.read.parquet(f"{self.folder}/{kind}").withColumn("part", F.col("part").cast("string"))
        return rows if parts is None else rows.where(F.col("part").isin(parts))

    def values(self, spark, parts: list[str] | None = None) -> DataFrame:
        """``feature, value, n`` of the parts together."""
        return self._read(spark, "values", parts).groupBy("feature", "value").agg(F.sum("n").alias("n"))

    def distinct(self, spark, parts: list[str] | None = None) -> DataFrame:
        """``feature, n_distinct`` of the parts together, estimated from their sketches."""
        merged = self._read(spark, "distinct", parts).groupBy("feature").agg(F.hll_union_agg("distinct").alias("s"))
        return merged.select("feature", F.hll_sketch_estimate("s").alias("n_distinct"))

    def profile(self, spark, parts: list[str] | None = None) -> Profile:
        """The profile of the parts together, for ``validate_against``."""
        numbers = number_profile(merged_numbers(self._read(spark, "numbers", parts)))
        values = self.values(spark, parts)
        return Profile(numbers.unionByName(text_profile(values), allowMissingColumns=True), values)
