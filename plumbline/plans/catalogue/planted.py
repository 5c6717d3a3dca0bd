"""Models and evaluations on classes planted so that they cannot be mistaken.

The class of an order follows from its key and stands in the features with gaps far
wider than the noise, so a model that has learnt at all predicts it on the orders held
out, and everything said about the model follows in SQL.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from plumbline.plans import training as L
from plumbline.plans.boosting import SoftmaxBoosted, train_softmax_boosted
from plumbline.plans.catalogue.base import query, table, tidy
from plumbline.plans.catalogue.measuring import CLASSES_SQL
from plumbline.plans.evaluation import continuous_evaluation, evaluate_model
from plumbline.plans.flows import recorded_training
from plumbline.session import scratch_path
from plumbline.sources.runs import read_runs

PREDICTED = "SELECT o_orderkey, (o_orderkey % 3)::DOUBLE AS prediction, true AS sure FROM orders WHERE o_orderkey % 5 = 0"
SCORED = "scored AS (SELECT o_orderkey % 3 AS label, o_orderkey % 3 AS prediction FROM orders WHERE o_orderkey % 5 = 0)"


def planted(spark, sf_dir):
    """``o_orderkey, features, label`` of the orders to learn from and of those held out, a fifth."""
    key, kind = F.col("o_orderkey"), F.col("o_orderkey") % 3
    noise = (F.col("o_custkey") * 7919 % 1000) / 1000.0
    other = (key * 104729 % 1009) / 1009.0
    x = F.array(6.0 * kind + noise, F.when(kind == 1, 5.0).otherwise(0.0) + other, 3.0 * noise * other)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", array_to_vector(x).alias("features"), kind.cast("double").alias("label"))
    return rows.where(key % 5 != 0), rows.where(key % 5 == 0)


def _predictions(model, test):
    """The class of each held-out order, and whether its probability is above one half."""
    out = model.transform(test)
    probability = out["probability"] if isinstance(model, (SoftmaxBoosted, L.ForestBlocks)) else L.class_probabilities()
    return out.select("o_orderkey", "prediction", (F.array_max(probability) > 0.5).alias("sure"))


@query("planted_baseline", PREDICTED)
def planted_baseline(spark, sf_dir):
    train, test = planted(spark, sf_dir)
    return _predictions(L.train_baseline(train), test)


@query("planted_forest", PREDICTED)
def planted_forest(spark, sf_dir):
    train, test = planted(spark, sf_dir)
    return _predictions(L.train_forest(train), test)


@query("planted_forest_blocks", PREDICTED)
def planted_forest_blocks(spark, sf_dir):
    """A first block of trees, then a run that resumes after it to the full forest."""
    train, test = planted(spark, sf_dir)
    folder = scratch_path(spark, "planted-forest")
    L.train_forest_blocks(train, folder, trees=L.BLOCK)
    L.train_forest_blocks(train, folder)
    return _predictions(L.load_forest_blocks(folder), test)


@query("planted_tree", PREDICTED)
def planted_tree(spark, sf_dir):
    train, test = planted(spark, sf_dir)
    return _predictions(L.train_tree(train), test)


@query("planted_softmax", PREDICTED)
def planted_softmax(spark, sf_dir):
    """Three classes under one objective, saved and loaded back."""
    train, test = planted(spark, sf_dir)
    folder = scratch_path(spark, "planted-softmax")
    train_softmax_boosted(train, rounds=5).save(spark, folder)
    return _predictions(SoftmaxBoosted.load(spark, folder), test)


@query(
    "planted_confusion",
    f"""WITH {SCORED}, c AS (SELECT DISTINCT label FROM scored)
       SELECT a.label::INT AS label, b.label::INT AS prediction, (SELECT count(*) FROM scored s WHERE s.label = a.label AND s.prediction = b.label) AS n FROM c a, c b""",
)
def planted_confusion(spark, sf_dir):
    train, test = planted(spark, sf_dir)
    return evaluate_model(L.train_tree(train), test)["confusion"]


@query(
    "planted_metrics",
    f"""WITH {SCORED}, {CLASSES_SQL}
       SELECT metric, label, round(value, 6) AS value FROM metrics
       UNION ALL SELECT 'roc_auc_class', label::VARCHAR, 1.0 FROM (SELECT DISTINCT label FROM scored)
       UNION ALL SELECT unnest(['roc_auc_macro', 'roc_auc_weighted']), NULL, 1.0""",
)
def planted_metrics(spark, sf_dir):
    """Every metric of a saved forest that is loaded back."""
    train, test = planted(spark, sf_dir)
    folder = scratch_path(spark, "planted-forest")
    L.train_forest_blocks(train, folder, trees=L.BLOCK)
    return tidy(evaluate_model(L.load_forest_blocks(folder), test)["metrics"])


@query(
    "planted_continuous_evaluation",
    f"""WITH {SCORED}, {CLASSES_SQL}, prod AS (SELECT o_orderkey % 3 AS prediction FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 < o_orderkey % 3 + 3),
       shares AS (SELECT label AS c, count(*) / (SELECT count(*) FROM scored) AS r FROM scored GROUP BY 1),
       counts AS (SELECT 'reference_' AS side, count(*) AS n FROM scored GROUP BY label UNION ALL SELECT 'production_', count(*) FROM prod GROUP BY prediction),
       sides AS (SELECT side, sum(n) AS total, count(*) AS k, max(n) / min(n) AS ratio FROM counts GROUP BY side)
       SELECT 'reference_' || metric || coalesce('_' || label, '') AS metric, round(value, 6) AS value FROM metrics WHERE metric NOT IN ('total_samples', 'num_classes')
       UNION ALL SELECT 'reference_roc_auc_class_' || c, 1.0 FROM shares
       UNION ALL SELECT unnest(['reference_roc_auc_macro', 'reference_roc_auc_weighted']), 1.0
       UNION ALL SELECT 'production_total_predictions', count(*)::DOUBLE FROM prod
       UNION ALL SELECT side || 'total_samples', total::DOUBLE FROM sides
       UNION ALL SELECT side || 'num_classes', k::DOUBLE FROM sides
       UNION ALL SELECT side || 'class_imbalance_ratio', round(ratio, 6) FROM sides
       UNION ALL SELECT 'class_' || c || '_proportion_change', round(p - r, 6) FROM shares
         JOIN (SELECT prediction, count(*) / (SELECT count(*) FROM prod) AS p FROM prod GROUP BY 1) ON prediction = c""",
)
def planted_continuous_evaluation(spark, sf_dir):
    """A tree on the held-out orders as reference; predictions of other orders, some of the lower classes left out."""
    train, test = planted(spark, sf_dir)
    model = L.train_tree(train)
    key = F.col("o_orderkey")
    predictions = model.transform(train.where(key % 7 < key % 3 + 3)).select("prediction")
    return tidy(continuous_evaluation(model, test, predictions))


@query(
    "training_run_recorded",
    f"""WITH {SCORED}, {CLASSES_SQL}
       SELECT metric || CASE label WHEN '0' THEN '_low' WHEN '1' THEN '_medium' WHEN '2' THEN '_high' ELSE '' END AS key, round(value, 6) AS num_value, NULL::VARCHAR AS str_value FROM metrics
       UNION ALL SELECT 'roc_auc_class' || unnest(['_low', '_medium', '_high']), 1.0, NULL
       UNION ALL SELECT unnest(['roc_auc_macro', 'roc_auc_weighted']), 1.0, NULL
       UNION ALL SELECT unnest(['model', 'depth']), NULL, unnest(['DecisionTreeClassificationModel', '10'])""",
)
def training_run_recorded(spark, sf_dir):
    """What a training run leaves in the run store: one run, one start time."""
    train, test = planted(spark, sf_dir)
    out = scratch_path(spark, "training-run")
    run, _ = recorded_training(train, test, L.train_tree, f"{out}/runs", out, depth=10)
    rows = read_runs(spark, f"{out}/runs", "training").where(F.col("run_id") == run.run_id)
    return tidy(rows.select("key", "num_value", "str_value"))
