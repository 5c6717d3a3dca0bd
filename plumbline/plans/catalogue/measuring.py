"""Classification metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import metrics as X
from plumbline.plans.catalogue.base import CUT, HALVES, SCORES_SQL, day, prod_orders, query, ref_orders, scored_orders, table, tidy

CLASSES_SQL = """
pairs AS (SELECT label, prediction, count(*) AS n FROM scored GROUP BY 1, 2),
classes AS (SELECT label AS c FROM pairs UNION SELECT prediction FROM pairs),
per AS (
  SELECT c AS class, coalesce((SELECT sum(n) FROM pairs WHERE label = c AND prediction = c), 0) AS tp,
         coalesce((SELECT sum(n) FROM pairs WHERE label = c), 0) AS support,
         coalesce((SELECT sum(n) FROM pairs WHERE prediction = c), 0) AS predicted FROM classes
),
m AS (
  SELECT class, tp, support, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS precision,
         CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall,
         CASE WHEN support + predicted = 0 THEN 0 ELSE 2 * tp / (support + predicted) END AS f1 FROM per
),
overall AS (
  SELECT sum(tp) / sum(support) AS accuracy, avg(precision) AS macro_precision, avg(recall) AS macro_recall, avg(f1) AS macro_f1,
         sum(precision * support) / sum(support) AS weighted_precision, sum(recall * support) / sum(support) AS weighted_recall,
         sum(f1 * support) / sum(support) AS weighted_f1, sum(support) AS total_samples, count(*) FILTER (support > 0) AS num_classes FROM m
),
metrics AS (
  SELECT metric, NULL::VARCHAR AS label, value FROM (SELECT
    accuracy::DOUBLE AS accuracy, macro_precision::DOUBLE AS macro_precision, macro_recall::DOUBLE AS macro_recall, macro_f1::DOUBLE AS macro_f1,
    weighted_precision::DOUBLE AS weighted_precision, weighted_recall::DOUBLE AS weighted_recall, weighted_f1::DOUBLE AS weighted_f1,
    total_samples::DOUBLE AS total_samples, num_classes::DOUBLE AS num_classes FROM overall)
  UNPIVOT (value FOR metric IN (accuracy, macro_precision, macro_recall, macro_f1, weighted_precision, weighted_recall, weighted_f1, total_samples, num_classes))
  UNION ALL SELECT 'precision', class::VARCHAR, precision FROM m UNION ALL SELECT 'recall', class::VARCHAR, recall FROM m
  UNION ALL SELECT 'f1', class::VARCHAR, f1 FROM m
)"""

BINARY_SQL = "scored AS (SELECT quality AS label, CASE WHEN toxic = 1 OR doc_id % 9 = 0 THEN 0 ELSE 1 END AS prediction FROM labels)"
RENAMED_SQL = "scored3 AS (SELECT label, CASE WHEN prediction = 2 AND o_orderkey % 4 = 0 THEN 3 ELSE prediction END AS prediction FROM scored)"


def _labels(spark, sf_dir):
    """Document quality against a guess from toxicity."""
    guess = F.when((F.col("toxic") == 1) | (F.col("doc_id") % 9 == 0), 0).otherwise(1)
    return table(spark, sf_dir, "labels").select(F.col("quality").alias("label"), guess.alias("prediction"))


@query(
    "confusion_matrix",
    f"""WITH {SCORES_SQL}, {RENAMED_SQL}, classes AS (SELECT label AS c FROM scored3 UNION SELECT prediction FROM scored3)
       SELECT a.c AS label, b.c AS prediction, (SELECT count(*) FROM scored3 WHERE label = a.c AND prediction = b.c) AS n FROM classes a, classes b""",
)
def confusion_matrix(spark, sf_dir):
    """A fourth class occurs in the predictions only."""
    odd = (F.col("prediction") == 2) & (F.col("o_orderkey") % 4 == 0)
    df = scored_orders(spark, sf_dir).withColumn("prediction", F.when(odd, 3).otherwise(F.col("prediction")))
    return X.confusion_matrix(df, "label", "prediction")


@query(
    "classification_metrics",
    f"WITH {SCORES_SQL}, {CLASSES_SQL} SELECT metric, label, round(value, 6) AS value FROM metrics",
)
def classification_metrics(spark, sf_dir):
    return tidy(X.classification_metrics(scored_orders(spark, sf_dir), "label", "prediction"))


@query(
    "classification_metrics_binary",
    f"WITH {BINARY_SQL}, {CLASSES_SQL} SELECT metric, label, round(value, 6) AS value FROM metrics",
)
def classification_metrics_binary(spark, sf_dir):
    return tidy(X.classification_metrics(_labels(spark, sf_dir), "label", "prediction"))


@query(
    "classification_report",
    f"""WITH {SCORES_SQL}, {CLASSES_SQL} SELECT class::VARCHAR AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
         round(f1, 6) AS f1, support::BIGINT AS support FROM m
       UNION ALL SELECT 'macro avg', round(macro_precision, 6), round(macro_recall, 6), round(macro_f1, 6), total_samples::BIGINT FROM overall
       UNION ALL SELECT 'weighted avg', round(weighted_precision, 6), round(weighted_recall, 6), round(weighted_f1, 6), total_samples::BIGINT FROM overall""",
)
def classification_report(spark, sf_dir):
    return tidy(X.classification_report(scored_orders(spark, sf_dir), "label", "prediction"))


def _auc_sql(c: int) -> str:
    return f"""SELECT {c} AS class, sum(pos) AS positives,
      sum(pos * (before_neg + neg / 2)) / (sum(pos)::DOUBLE * sum(neg)) AS auc FROM (
        SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_neg FROM (
          SELECT p{c} AS s, sum((label = {c})::INT) AS pos, sum((label <> {c})::INT) AS neg FROM scored GROUP BY 1))"""


@query(
    "roc_auc_ovr",
    f"""WITH {SCORES_SQL}, a AS ({' UNION ALL '.join(_auc_sql(c) for c in range(3))})
       SELECT 'roc_auc_class' AS metric, class::VARCHAR AS label, round(auc, 9) AS value FROM a
       UNION ALL SELECT 'roc_auc_macro', NULL, round(avg(auc), 9) FROM a
       UNION ALL SELECT 'roc_auc_weighted', NULL, round(sum(auc * positives) / sum(positives), 9) FROM a""",
)
def roc_auc_ovr(spark, sf_dir):
    return tidy(X.roc_auc(scored_orders(spark, sf_dir), "label", F.col("scores")), 9)


@query(
    "class_distribution",
    """WITH c AS (SELECT o_orderstatus AS class, count(*) AS n FROM orders GROUP BY 1)
       SELECT class, n, round(n / sum(n) OVER (), 6) AS share, (sum(n) OVER ())::BIGINT AS total_samples, count(*) OVER () AS num_classes,
         round(max(n) OVER () / min(n) OVER (), 6) AS class_imbalance_ratio FROM c""",
)
def class_distribution(spark, sf_dir):
    return tidy(X.class_distribution(table(spark, sf_dir, "orders"), "o_orderstatus"))


@query(
    "prediction_stats",
    f"""WITH {SCORES_SQL} SELECT count(*) AS total_predictions, round(avg(greatest(p0, p1, p2)), 6) AS mean_confidence,
         round(stddev_pop(greatest(p0, p1, p2)), 6) AS std_confidence, round(min(greatest(p0, p1, p2)), 6) AS min_confidence,
         round(max(greatest(p0, p1, p2)), 6) AS max_confidence FROM scored""",
)
def prediction_stats(spark, sf_dir):
    return tidy(X.prediction_statistics(scored_orders(spark, sf_dir), F.col("scores")))


def _metrics_of_sql(prefix: str, rows: str) -> str:
    """The class metric tables over a subset, with prefixed names."""
    text = CLASSES_SQL
    for name in ("pairs", "classes", "per", "m", "overall", "metrics"):
        for old, new in ((f"{name} AS (", f"{prefix}_{name} AS ("), (f"FROM {name} ", f"FROM {prefix}_{name} "), (f"FROM {name})", f"FROM {prefix}_{name})"), (f"FROM {name}\n", f"FROM {prefix}_{name}\n")):
            text = text.replace(old, new)
    return text.replace("FROM scored ", f"FROM ({rows}) ")


@query(
    "compare_metrics",
    f"""WITH {SCORES_SQL}, {_metrics_of_sql('a', f"SELECT s.* FROM scored s JOIN orders o USING (o_orderkey) WHERE o_orderdate < TIMESTAMP '{CUT}'")},
       {_metrics_of_sql('b', f"SELECT s.label, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE s.prediction END AS prediction FROM scored s JOIN orders o USING (o_orderkey) WHERE o_orderdate >= TIMESTAMP '{CUT}'")},
       c AS (SELECT a.metric, a.value AS r, b.value AS p FROM a_metrics a JOIN b_metrics b ON a.metric = b.metric AND a.label IS NULL AND b.label IS NULL
             WHERE a.metric IN ('accuracy', 'macro_precision', 'macro_recall', 'macro_f1', 'weighted_f1') AND a.value > 0)
       SELECT metric, round(r, 6) AS reference, round(p, 6) AS production, round(p - r, 6) AS absolute_change, round((p - r) / r, 6) AS relative_change,
         (p - r) / r < -0.05 AS degraded, CASE WHEN (p - r) / r < -0.1 THEN 'high' WHEN (p - r) / r < -0.05 THEN 'medium' END AS severity,
         CASE WHEN (p - r) / r < -0.05 THEN metric || ' degraded by ' || printf('%.2f%%', abs((p - r) / r) * 100) END AS message FROM c""",
)
def compare_metrics(spark, sf_dir):
    """Metrics of the early orders against a worse scoring of the late ones."""
    df = scored_orders(spark, sf_dir)
    early = F.col("o_orderdate") < day(CUT)
    worse = F.when(F.col("o_orderkey") % 3 == 0, 0).otherwise(F.col("prediction"))
    return tidy(
        X.compare_metrics(
            X.classification_metrics(df.where(early), "label", "prediction"),
            X.classification_metrics(df.where(~early).withColumn("prediction", worse), "label", "prediction"),
        )
    )


@query(
    "class_share_change",
    f"""WITH {HALVES}, r AS (SELECT price_category AS class, count(*) / (SELECT count(*) FROM ref) AS share FROM ref GROUP BY 1),
       p AS (SELECT prediction AS class, count(*) / (SELECT count(*) FROM prod) AS share FROM prod GROUP BY 1)
       SELECT r.class, round(r.share, 6) AS reference, round(p.share, 6) AS production, round(p.share - r.share, 6) AS change FROM r JOIN p USING (class)""",
)
def class_share_change(spark, sf_dir):
    return tidy(
        X.class_share_change(ref_orders(spark, sf_dir), prod_orders(spark, sf_dir), "price_category", "prediction")
    )


@query(
    "class_weights",
    """WITH c AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)
       SELECT o_orderstatus, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n), 6) AS weight FROM c""",
)
def class_weights(spark, sf_dir):
    return tidy(X.class_weights(table(spark, sf_dir, "orders"), "o_orderstatus"))
