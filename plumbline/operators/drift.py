"""Distribution-shift measures between a reference and a production table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumbline.functions import terms
from plumbline.functions.terms import share
from plumbline.operators.counts import count_table
from plumbline.operators.profile import BINS, bin_counts, numeric_long, share_over
from plumbline.operators.ranks import ks_statistics
from plumbline.session import one_row


def tagged_numbers(ref: DataFrame, prod: DataFrame, columns: list[str]) -> DataFrame:
    """``feature, value, side`` rows of both tables."""
    return numeric_long(ref, columns, "ref").unionByName(numeric_long(prod, columns, "prod"))


def _with_shares(counts: DataFrame) -> DataFrame:
    """Aligned counts as shares ``e`` (reference) and ``a`` (production).

    Both are null when either side is empty, so that the sums come out as 0.
    """
    total = one_row(counts.agg(F.sum("n_ref").alias("ref"), F.sum("n_prod").alias("prod")))
    both = (F.col("t.ref") > 0) & (F.col("t.prod") > 0)
    return counts.withColumn("t", total).select(
        F.when(both, share(F.col("n_ref"), F.col("t.ref"))).alias("e"),
        F.when(both, share(F.col("n_prod"), F.col("t.prod"))).alias("a"),
    )


def psi_of_counts(counts: DataFrame, scale: float = terms.CATEGORICAL_SCALE) -> DataFrame:
    """``psi`` of one column's aligned counts, one row; 0 if a side is empty."""
    term = terms.psi_term(F.col("e"), F.col("a"))
    return _with_shares(counts).where("e is not null").agg(terms.scaled_sum(term, scale).alias("psi"))


def categorical_psi(
    ref: DataFrame,
    prod: DataFrame,
    column: str,
    scale: float = terms.CATEGORICAL_SCALE,
    dropna: bool = False,
) -> DataFrame:
    """Population stability index of a text column; missing is a category by default.

    ``scale=1`` gives the textbook value.
    """
    counts = count_table(ref, prod, [column])
    return psi_of_counts(counts.where("value is not null") if dropna else counts, scale)


def numerical_psi_by_feature(
    tagged: DataFrame,
    bins: int = BINS,
    scale: float = terms.NUMERICAL_SCALE,
    ends: DataFrame | None = None,
) -> DataFrame:
    """``feature, psi`` over bins whose edges come from the reference only."""
    shares = bin_counts(tagged, bins, ends).select(
        "feature", share_over("n_ref", "feature").alias("e"), share_over("n_prod", "feature").alias("a")
    )
    return shares.groupBy("feature").agg(
        terms.scaled_sum(terms.psi_term(F.col("e"), F.col("a")), scale).alias("psi")
    )


def numerical_psi(
    ref: DataFrame, prod: DataFrame, column: str, bins: int = BINS, scale: float = terms.NUMERICAL_SCALE
) -> DataFrame:
    """``psi`` of one numeric column, one row; 0 if a side is empty."""
    by_feature = numerical_psi_by_feature(tagged_numbers(ref, prod, [column]), bins, scale)
    return by_feature.agg(F.coalesce(F.max("psi"), F.lit(0.0)).alias("psi"))


def kl_of_counts(counts: DataFrame, scale: float = terms.KL_SCALE) -> DataFrame:
    """``kl`` of aligned class counts, one row; 0 if a side is empty."""
    shares = _with_shares(counts.where("value is not null")).where("e is not null")
    return shares.agg(terms.scaled_sum(terms.kl_term(F.col("e"), F.col("a")), scale).alias("kl"))


def prediction_kl(
    ref: DataFrame, prod: DataFrame, ref_column: str, prod_column: str, scale: float = terms.KL_SCALE
) -> DataFrame:
    """Divergence of production predictions from reference classes; missing is left out."""
    return kl_of_counts(count_table(ref, prod, [("class", ref_column, prod_column)]), scale)


def cardinality_of_counts(counts: DataFrame, scale: float = terms.CARDINALITY_SCALE) -> DataFrame:
    seen = F.col("value").isNotNull()
    out = counts.agg(
        F.count_if(seen & (F.col("n_ref") > 0)).alias("ref_unique"),
        F.count_if(seen & (F.col("n_prod") > 0)).alias("prod_unique"),
    )
    ratio = F.col("prod_unique") / F.greatest(F.col("ref_unique"), F.lit(1)) / F.lit(scale)
    return out.withColumn("cardinality_ratio", ratio)


def cardinality_ratio(
    ref: DataFrame,
    prod: DataFrame,
    column: str,
    scale: float = terms.CARDINALITY_SCALE,
    rsd: float | None = None,
) -> DataFrame:
    """Distinct values in production over those in the reference, over ``scale``.

    ``rsd`` counts with a mergeable sketch instead of exactly.
    """
    if rsd is None:
        return cardinality_of_counts(count_table(ref, prod, [column]), scale)
    sketch = F.approx_count_distinct(F.col(f"`{column}`"), rsd).alias("u")
    r, p = one_row(ref.agg(sketch))["u"], prod.agg(sketch)
    out = p.select(r.alias("ref_unique"), F.col("u").alias("prod_unique"))
    ratio = F.col("prod_unique") / F.greatest(F.col("ref_unique"), F.lit(1)) / F.lit(scale)
    return out.withColumn("cardinality_ratio", ratio)


def ks_by_feature(tagged: DataFrame, alpha: float = 0.05) -> DataFrame:
    """``feature, ref_n, prod_n, ks_statistic, ks_pvalue, drift_detected``."""
    out = ks_statistics(tagged).withColumn(
        "ks_pvalue", terms.ks_p_value(F.col("ks_statistic"), F.col("ref_n"), F.col("prod_n"))
    )
    return out.withColumn("drift_detected", F.col("ks_pvalue") < alpha)


def ks_test(ref: DataFrame, prod: DataFrame, column: str, alpha: float = 0.05) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test; no row if a side is empty."""
    return ks_by_feature(tagged_numbers(ref, prod, [column]), alpha).drop("feature")


def category_summary(counts: DataFrame) -> DataFrame:
    """Everything the categorical checks need, one row per feature.

    From aligned counts: totals and distinct values per side (missing left
    out), rows in values new to production, and the chi-square test of
    production against reference shares over the common values. The test is
    null unless there are at least two common values.
    """
    rows = counts.where("value is not null")
    common = (F.col("n_ref") > 0) & (F.col("n_prod") > 0)
    totals = rows.groupBy("feature").agg(
        F.sum("n_ref").alias("ref_rows"),
        F.sum("n_prod").alias("prod_rows"),
        F.count_if(F.col("n_ref") > 0).alias("ref_unique"),
        F.count_if(F.col("n_prod") > 0).alias("prod_unique"),
        F.count_if((F.col("n_ref") == 0) & (F.col("n_prod") > 0)).alias("new_values"),
        F.sum(F.when(F.col("n_ref") == 0, F.col("n_prod")).otherwise(0)).alias("new_rows"),
        F.count_if(common).alias("common"),
        F.sum(F.when(common, F.col("n_ref"))).alias("ref_common"),
        F.sum(F.when(common, F.col("n_prod"))).alias("prod_common"),
    )
    expected = F.col("n_ref") / F.col("ref_common") * F.col("prod_common")
    gap = F.col("n_prod") - expected
    chi = (
        rows.where(common)
        .join(F.broadcast(totals.select("feature", "ref_common", "prod_common")), "feature")
        .groupBy("feature")
        .agg(F.sum(gap * gap / expected).alias("chi2"))
    )
    tested = F.col("common") > 1
    return (
        totals.join(F.broadcast(chi), "feature", "left")
        .withColumn("chi2", F.when(tested, F.col("chi2")))
        .withColumn("chi2_df", F.when(tested, F.col("common") - 1))
        .withColumn("chi2_pvalue", terms.chi_square_p_value(F.col("chi2"), F.col("chi2_df")))
    )


def chi_square(ref: DataFrame, prod: DataFrame, columns: list[str]) -> DataFrame:
    """``feature, chi2, df, p_value`` for features with at least two common values."""
    return (
        category_summary(count_table(ref, prod, columns))
        .where("chi2 is not null")
        .select("feature", "chi2", F.col("chi2_df").alias("df"), F.col("chi2_pvalue").alias("p_value"))
    )
