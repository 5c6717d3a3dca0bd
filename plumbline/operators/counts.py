"""Value counts and the alignment of a reference with a production table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline.functions.terms import share
from plumbline.operators.ranks import melt
from plumbline.session import one_row


def value_counts(df: DataFrame, column: str, dropna: bool = True) -> DataFrame:
    """``value, n`` per distinct value."""
    out = df.select(F.col(f"`{column}`").alias("value"))
    if dropna:
        out = out.where(F.col("value").isNotNull())
    return out.groupBy("value").agg(F.count("*").alias("n"))


def top_counts(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values; ties go to the smaller value."""
    return value_counts(df, column).orderBy(F.desc("n"), "value").limit(k)


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """``value, n, share`` over the non-missing rows."""
    counts = value_counts(df, column)
    total = one_row(counts.agg(F.sum("n").alias("total")))
    return counts.withColumn("share", share(F.col("n"), total["total"]))


def top_shares(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    return value_shares(df, column).orderBy(F.desc("n"), "value").limit(k)


def distinct_count(df: DataFrame, column: str, rsd: float | None = None) -> DataFrame:
    """One row ``n_distinct``; ``rsd`` switches to the mergeable sketch."""
    c = F.col(f"`{column}`")
    agg = F.count_distinct(c) if rsd is None else F.approx_count_distinct(c, rsd)
    return df.agg(agg.alias("n_distinct"))


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type in which values of two columns are compared.

    Whole numbers meet as long, numbers of different kinds as double, so that
    class 0 is class 0.0. A type paired with itself stays; all else meets as text.
    """
    if a == b:
        return a
    if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
        return T.LongType()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    return T.StringType()


def in_type(c: Column, data_type: T.DataType) -> Column:
    """The column in that type; minus zero becomes zero."""
    c = c.cast(data_type)
    return c + F.lit(0.0).cast(data_type) if isinstance(data_type, (T.FloatType, T.DoubleType)) else c


def count_table(ref: DataFrame, prod: DataFrame, columns: list) -> DataFrame:
    """``feature, value, n_ref, n_prod`` for many columns, in one shuffle.

    A column is a name, or a ``(feature, reference column, production column)``
    triple. Missing values form their own group. A value absent on one side
    counts 0 there, so this table stands in for the full outer, semi and anti
    joins of the two value sets, and matches missing with missing. ``value`` is
    the text of the value in the ``common_type`` of both columns.
    """
    triples = [c if isinstance(c, tuple) else (c, c, c) for c in columns]

    def side(df: DataFrame, pick: int, is_ref: bool) -> DataFrame:
        renamed = df.select(
            *[
                in_type(F.col(f"`{t[pick]}`"), common_type(ref.schema[t[1]].dataType, prod.schema[t[2]].dataType)).alias(t[0])
                for t in triples
            ]
        )
        return melt(renamed, [t[0] for t in triples], "string").withColumn("is_ref", F.lit(is_ref))

    both = side(ref, 1, True).unionByName(side(prod, 2, False))
    return both.groupBy("feature", "value").agg(
        F.count_if("is_ref").alias("n_ref"), F.count_if(~F.col("is_ref")).alias("n_prod")
    )


def align_with_counts(ref_counts: DataFrame, prod: DataFrame, columns: list[str]) -> DataFrame:
    """``count_table`` from the reference's stored ``feature, value, n``."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    ref = ref_counts.where(F.col("feature").isin(columns)).select(
        "feature", "value", F.col("n").alias("r"), zero.alias("p")
    )
    rows = melt(prod, columns, "string").select("feature", "value", zero.alias("r"), one.alias("p"))
    both = ref.unionByName(rows).groupBy("feature", "value")
    return both.agg(F.sum("r").alias("n_ref"), F.sum("p").alias("n_prod"))


def new_values(counts: DataFrame) -> DataFrame:
    """Values seen in production only."""
    return counts.where("value is not null and n_ref = 0 and n_prod > 0")


def common_values(counts: DataFrame) -> DataFrame:
    """Values seen on both sides."""
    return counts.where("value is not null and n_ref > 0 and n_prod > 0")


def new_category_list(ref: DataFrame, prod: DataFrame, columns: list) -> DataFrame:
    """``feature, value, n_prod``: every value that production has and the reference lacks."""
    return new_values(count_table(ref, prod, columns)).select("feature", "value", "n_prod")


def aligned_top(ref: DataFrame, prod: DataFrame, column: str, k: int = 10, normalize: bool = True) -> DataFrame:
    """The two top-``k`` lists side by side.

    A value in only one list shows 0 for the other side, even if it occurs there.
    """
    measure = "share" if normalize else "n"
    zero = F.lit(0.0) if normalize else F.lit(0)

    def side(df: DataFrame, name: str) -> DataFrame:
        top = top_shares(df, column, k) if normalize else top_counts(df, column, k)
        return top.select("value", F.col(measure).alias(name))

    r, p = side(ref, "reference").alias("r"), side(prod, "production").alias("p")
    return r.join(p, F.col("r.value").eqNullSafe(F.col("p.value")), "full_outer").select(
        F.coalesce("r.value", "p.value").alias("value"),
        F.coalesce("reference", zero).alias("reference"),
        F.coalesce("production", zero).alias("production"),
    )


def compare_shares(ref: DataFrame, prod: DataFrame, ref_column: str, prod_column: str) -> DataFrame:
    """Shares of every class on both sides, 0 where absent, sorted by class.

    ``value`` has the ``common_type`` of the two columns.
    """
    counts = count_table(ref, prod, [("class", ref_column, prod_column)]).where("value is not null")
    total = one_row(counts.agg(F.sum("n_ref").alias("ref"), F.sum("n_prod").alias("prod")))
    data_type = common_type(ref.schema[ref_column].dataType, prod.schema[prod_column].dataType)

    def part(n: str, of: Column) -> Column:
        return F.coalesce(share(F.col(n), of), F.lit(0.0))

    return counts.select(
        F.col("value").cast(data_type).alias("value"),
        part("n_ref", total["ref"]).alias("reference"),
        part("n_prod", total["prod"]).alias("production"),
    ).orderBy("value")


def cardinality_growth(ref: DataFrame, prod: DataFrame, column: str) -> DataFrame:
    """Distinct values per data set, two rows."""
    return (
        distinct_count(ref, column)
        .select(F.lit("reference").alias("dataset"), F.col("n_distinct").alias("unique_values"))
        .unionAll(
            distinct_count(prod, column).select(
                F.lit("production").alias("dataset"), F.col("n_distinct").alias("unique_values")
            )
        )
    )


def hourly_counts(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(F.date_trunc("hour", F.col(ts)).alias("hour")).agg(F.count("*").alias("n"))


def recent_rows(df: DataFrame, ts: str | None, tie: str, n: int = 100) -> DataFrame:
    """The latest ``n`` rows, or the first ``n`` in key order without a timestamp."""
    order = [F.col(tie)] if ts is None or ts not in df.columns else [F.desc(ts), F.col(tie)]
    return df.orderBy(*order).limit(n)


def time_span(df: DataFrame, ts: str) -> DataFrame:
    """Latest timestamp and whole days between first and last."""
    t = F.col(ts).cast("timestamp")
    seconds = F.unix_micros(F.max(t)) - F.unix_micros(F.min(t))
    return df.agg(
        F.max(ts).alias("latest"), F.floor(seconds / F.lit(86_400_000_000.0)).cast("bigint").alias("span_days")
    )
