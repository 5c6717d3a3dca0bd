"""Classification metrics as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.functions.terms import share
from plumbline.operators.counts import value_shares
from plumbline.operators.ranks import class_auc
from plumbline.session import one_row

# The metrics that are compared between two evaluations.
COMPARED = ("accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1")
DEGRADED = 0.05
# A confusion matrix has a cell for each pair of classes, so there may be so many classes at most.
MOST_CLASSES = 1_000
SEVERE = 0.1


def _ratio(part: Column, whole: Column) -> Column:
    """Zero, not missing, when the denominator is zero."""
    return F.coalesce(share(part, whole), F.lit(0.0))


def pair_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``label, prediction, n`` for the pairs that occur."""
    return (
        df.select(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction"))
        .groupBy("label", "prediction")
        .agg(F.count("*").alias("n"))
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Every cell over the union of true and predicted classes, zeros included.

    More than ``MOST_CLASSES`` classes are an error.
    """
    pairs = pair_counts(df, label, prediction)
    classes = pairs.select(F.explode(F.array("label", "prediction")).alias("c")).distinct()
    found = one_row(classes.limit(MOST_CLASSES + 1).agg(F.collect_set("c").alias("all")))["all"]
    many = F.raise_error(F.lit(f"a confusion matrix has {MOST_CLASSES} classes at most")).cast("array<int>")
    every = F.when(F.size(found) <= MOST_CLASSES, found).otherwise(many)
    zeros = classes.select(F.col("c").alias("label"), F.explode(every).alias("prediction"), F.lit(0).alias("n"))
    return (
        pairs.unionByName(zeros).groupBy("label", "prediction").agg(F.sum("n").cast("bigint").alias("n"))
    )


def class_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``class, precision, recall, f1, support`` over the union of classes."""
    pairs = pair_counts(df, label, prediction)
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("label").alias("class"), hit.alias("tp"), F.col("n").alias("support"), zero.alias("predicted")),
        F.struct(F.col("prediction").alias("class"), zero.alias("tp"), zero.alias("support"), F.col("n").alias("predicted")),
    )
    totals = pairs.select(F.inline(sides)).groupBy("class").agg(
        F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted")
    )
    return totals.select(
        "class",
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"),
        "support",
        "tp",
    )


def _averages(classes: DataFrame) -> DataFrame:
    """One row: accuracy and the macro and weighted averages."""
    measures = ("precision", "recall", "f1")
    return classes.agg(
        _ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[_ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"weighted_{m}") for m in measures],
        F.sum("support").cast("bigint").alias("total_samples"),
        F.count_if(F.col("support") > 0).alias("num_classes"),
    )


def _to_rows(one: DataFrame, names: list[str], label: Column | None = None) -> DataFrame:
    label = F.lit(None).cast("string") if label is None else label.cast("string")
    pairs = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in names]
    )
    return one.select(label.alias("label"), F.inline(pairs)).select("metric", "label", "value")


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Long table ``metric, label, value``; ``label`` is null for overall metrics."""
    classes = class_metrics(df, label, prediction)
    overall = _averages(classes)
    return _to_rows(overall, overall.columns).unionByName(
        _to_rows(classes, ["precision", "recall", "f1"], F.col("class"))
    )


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per class and macro/weighted rows with support."""
    classes = class_metrics(df, label, prediction)
    a = _averages(classes)
    rows = F.array(
        *[
            F.struct(
                F.lit(f"{kind} avg").alias("class"),
                F.col(f"{kind}_precision").alias("precision"),
                F.col(f"{kind}_recall").alias("recall"),
                F.col(f"{kind}_f1").alias("f1"),
                F.col("total_samples").alias("support"),
            )
            for kind in ("macro", "weighted")
        ]
    )
    return classes.select(
        F.col("class").cast("string").alias("class"), "precision", "recall", "f1", F.col("support").cast("bigint").alias("support")
    ).unionByName(a.select(F.inline(rows)))


def roc_auc(df: DataFrame, label: str, scores: Column) -> DataFrame:
    """One-vs-rest AUC per class plus macro and weighted averages.

    ``scores`` is an array with one score per class code. With two true classes
    the only row is the AUC of class 1. No row when it is undefined: a class
    without a score or a single true class.
    """
    rows = df.select(F.col(label).cast("int").alias("y"), F.posexplode(scores).alias("class", "score"))
    scored = rows.select("class", "score", (F.col("class") == F.col("y")).alias("is_positive"))
    per_class = class_auc(scored)
    stats = one_row(
        df.agg(F.count_distinct(label).alias("classes"), F.max(F.size(scores)).alias("scores"))
    )
    a = per_class.agg(
        F.count("*").alias("k"),
        F.avg("auc").alias("macro"),
        _ratio(F.sum(F.col("auc") * F.col("positives")), F.sum("positives")).alias("weighted"),
        F.max(F.when(F.col("class") == 1, F.col("auc"))).alias("binary"),
    ).withColumn("s", stats)
    many = (F.col("s.classes") > 2) & (F.col("k") == F.col("s.scores")) & (F.col("k") == F.col("s.classes"))
    entries = F.array(
        F.when(many, F.struct(F.lit("roc_auc_macro").alias("metric"), F.col("macro").alias("value"))),
        F.when(many, F.struct(F.lit("roc_auc_weighted").alias("metric"), F.col("weighted").alias("value"))),
        F.when(F.col("s.classes") == 2, F.struct(F.lit("roc_auc").alias("metric"), F.col("binary").alias("value"))),
    )
    overall = a.select(F.inline(F.filter(entries, lambda e: e.isNotNull())))
    return overall.select("metric", F.lit(None).cast("string").alias("label"), "value").unionByName(
        per_class.select(
            F.lit("roc_auc_class").alias("metric"), F.col("class").cast("string").alias("label"), F.col("auc").alias("value")
        )
    )


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """``class, n, share`` with the totals and the imbalance ratio on every row."""
    shares = value_shares(df, label)
    t = shares.agg(
        F.sum("n").alias("total"), F.count("*").alias("k"), (F.max("n") / F.min("n")).alias("imbalance")
    )
    return shares.withColumn("t", one_row(t)).select(
        F.col("value").alias("class"),
        "n",
        "share",
        F.col("t.total").alias("total_samples"),
        F.col("t.k").alias("num_classes"),
        F.when(F.col("t.k") > 1, F.col("t.imbalance")).otherwise(1.0).alias("class_imbalance_ratio"),
    )


def prediction_statistics(df: DataFrame, scores: Column | None = None) -> DataFrame:
    """One row: predictions and the top-class probability's mean, population std, min, max."""
    out = [F.count("*").alias("total_predictions")]
    if scores is not None:
        top = F.array_max(scores)
        out += [
            F.avg(top).alias("mean_confidence"),
            F.stddev_pop(top).alias("std_confidence"),
            F.min(top).alias("min_confidence"),
            F.max(top).alias("max_confidence"),
        ]
    return df.agg(*out)


def compare_metrics(ref: DataFrame, prod: DataFrame, threshold: float = DEGRADED) -> DataFrame:
    """Change of the compared metrics; ``metric, value`` tables in, non-positive references skipped."""

    def side(df: DataFrame, name: str) -> DataFrame:
        rows = df.where(F.col("metric").isin(*COMPARED))
        return rows.groupBy("metric").agg(F.max("value").alias(name))

    both = side(ref, "reference").join(F.broadcast(side(prod, "production")), "metric").where("reference > 0")
    change = (F.col("production") - F.col("reference")) / F.col("reference")
    return both.select(
        "metric",
        "reference",
        "production",
        (F.col("production") - F.col("reference")).alias("absolute_change"),
        change.alias("relative_change"),
        (change < -threshold).alias("degraded"),
        F.when(change < -threshold, F.when(F.abs(change) > SEVERE, "high").otherwise("medium")).alias("severity"),
        F.when(
            change < -threshold,
            F.concat(F.col("metric"), F.lit(" degraded by "), F.format_string("%.2f%%", F.abs(change) * 100.0)),
        ).alias("message"),
    )


def class_share_change(ref: DataFrame, prod: DataFrame, ref_column: str, prod_column: str) -> DataFrame:
    """Change of each class's share, for classes present on both sides."""
    r = value_shares(ref, ref_column).select(F.col("value").alias("class"), F.col("share").alias("reference"))
    p = value_shares(prod, prod_column).select(F.col("value").alias("class"), F.col("share").alias("production"))
    return r.join(p, "class").withColumn("change", F.col("production") - F.col("reference"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``label, weight`` with weight n / (classes * class rows)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    t = one_row(counts.agg(F.sum("n").alias("total"), F.count("*").alias("k")))
    return counts.select(
        F.col(label), (t["total"] / (t["k"] * F.col("n")).cast("double")).alias("weight")
    )
