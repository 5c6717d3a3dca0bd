"""The run-metrics store and the tables read from it."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from plumbline.operators import monitor as M
from plumbline.operators.metrics import classification_metrics
from plumbline.plans.catalogue.base import EVENT_CUT, HALVES, SCORES_SQL, day, psi_sql, prod_orders, query, ref_orders, scored_orders, table, tidy
from plumbline.plans.catalogue.drifting import CFG, METRICS_SQL
from plumbline.plans.catalogue.measuring import CLASSES_SQL
from plumbline.session import scratch_path
from plumbline.sources import runs as R
from plumbline.sources.logs import append_log, append_rows, compact_log, read_log
from plumbline.sources.tables import source_status as status_of

KEYS = ["click", "error", "purchase", "signup", "view"]


def _event_runs(spark, sf_dir):
    """Users as runs, event types as metric names, mean values as metrics."""
    e = table(spark, sf_dir, "events").withColumn("run_id", F.col("user_id").cast("string"))
    start = e.groupBy("run_id").agg(F.min("ts").cast("timestamp").alias("start_time"))
    # Some runs have no value for ``error``, so that missing metrics occur.
    hole = (F.col("user_id") % 4 == 0) & (F.col("event_type") == "error")
    values = e.groupBy("run_id", F.col("event_type").alias("key")).agg(
        F.avg(F.when(~hole, F.col("value"))).alias("num_value")
    )
    return values.join(start, "run_id").withColumn("kind", F.lit("metric")).withColumn("str_value", F.lit(None).cast("string"))


_RUNS_SQL = """
starts AS (SELECT user_id, min(ts) AS start_time FROM events GROUP BY 1),
vals AS (SELECT user_id, event_type, avg(CASE WHEN user_id % 4 = 0 AND event_type = 'error' THEN NULL ELSE value END) AS v FROM events GROUP BY 1, 2),
newest AS (SELECT user_id::VARCHAR AS run_id, user_id, start_time FROM starts ORDER BY start_time DESC, run_id LIMIT {limit}),
wide AS (SELECT run_id, start_time, """ + ", ".join(
    f"max(v) FILTER (event_type = '{k}') AS {k}" for k in KEYS
) + " FROM newest JOIN vals USING (user_id) GROUP BY run_id, start_time)"


def _ntz(df):
    return df.withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))


@query(
    "run_metrics_wide",
    f"WITH {_RUNS_SQL.format(limit=10)} SELECT run_id, start_time, " + ", ".join(f"round(coalesce({k}, 0), 6) AS {k}" for k in KEYS) + " FROM wide",
)
def run_metrics_wide(spark, sf_dir):
    return tidy(_ntz(R.latest_runs(_event_runs(spark, sf_dir), KEYS, 10, zero_fill=True)))


@query(
    "latest_run",
    f"WITH {_RUNS_SQL.format(limit=10)} SELECT run_id, start_time, " + ", ".join(f"round({k}, 6) AS {k}" for k in KEYS) + " FROM wide ORDER BY start_time DESC, run_id LIMIT 1",
)
def latest_run(spark, sf_dir):
    return tidy(_ntz(R.latest_run(R.latest_runs(_event_runs(spark, sf_dir), KEYS, 10))))


@query(
    "run_index",
    f"""WITH {_RUNS_SQL.format(limit=20)} SELECT run_id, start_time, {', '.join(f'round({k}, 6) AS {k}' for k in KEYS)},
         (row_number() OVER (ORDER BY start_time, run_id) - 1)::INT AS run_index FROM wide WHERE error IS NOT NULL""",
)
def run_index(spark, sf_dir):
    return tidy(_ntz(R.run_index(R.latest_runs(_event_runs(spark, sf_dir), KEYS, 20), ["error"])))


@query(
    "metric_series",
    f"""WITH {_RUNS_SQL.format(limit=20)}, i AS (SELECT *, (row_number() OVER (ORDER BY start_time, run_id) - 1)::INT AS run_index FROM wide)
       SELECT 'error' AS metric, run_index, round(error, 6) AS value FROM i WHERE error IS NOT NULL
       UNION ALL SELECT 'view', run_index, round(view, 6) FROM i WHERE view IS NOT NULL""",
)
def metric_series(spark, sf_dir):
    indexed = R.run_index(R.latest_runs(_event_runs(spark, sf_dir), KEYS, 20))
    return tidy(R.metric_series(indexed, ["error", "view"]))


@query(
    "latest_version",
    """SELECT event_type AS model, max(event_id % 1000)::VARCHAR AS version,
         arg_max(value, (event_id % 1000) * 1000000000 + event_id // 1000) AS value
       FROM events GROUP BY 1""",
)
def latest_version(spark, sf_dir):
    """Event types as models; versions are texts that must be compared as numbers."""
    e = table(spark, sf_dir, "events")
    version = (F.col("event_id") % 1000).cast("string")
    latest = e.groupBy(F.col("event_type").alias("model"), version.alias("version")).agg(
        F.max_by("value", "event_id").alias("value")
    )
    return R.latest_version(latest, "model", "version")


def _class_rows(spark, sf_dir):
    metrics = classification_metrics(scored_orders(spark, sf_dir), "label", "prediction").where("label is not null")
    name = F.get(F.array(*[F.lit(c) for c in R.CLASSES]), F.col("label").cast("int"))
    rows = metrics.withColumn("metric", F.concat_ws("_", "metric", name)).drop("label")
    # The class ``medium`` has no metrics in this run.
    return rows.where(~F.col("metric").endswith("_medium"))


@query(
    "class_metrics_rows",
    f"""WITH {SCORES_SQL}, {CLASSES_SQL} SELECT CASE class WHEN 0 THEN 'low' ELSE 'high' END AS class, round(precision, 6) AS precision,
         round(recall, 6) AS recall, round(f1, 6) AS f1 FROM m WHERE class <> 1""",
)
def class_metrics_rows(spark, sf_dir):
    """One run's class metrics stored long, read wide, and turned into rows."""
    path = scratch_path(spark, "class-runs")
    run = {"run_id": "r1", "experiment": "training", "run_name": "forest"}
    R.append_run(R.metric_rows(_class_rows(spark, sf_dir), run), path)
    wide = R.latest_runs(R.read_runs(spark, path, "training"), R.MODEL_KEYS, 5)
    return tidy(R.class_metric_rows(R.latest_run(wide)))


@query(
    "metrics_append",
    f"""WITH {METRICS_SQL}, s AS (SELECT 'metric' AS kind, metric AS key, round(value, 6) AS num_value, NULL AS str_value FROM metrics)
       SELECT * FROM s UNION ALL SELECT 'metric', 'rows', (SELECT count(*)::DOUBLE FROM prod), NULL
       UNION ALL SELECT 'param', 'category', NULL, 'priority'""",
)
def metrics_append(spark, sf_dir):
    """A monitoring run appended in three writes and read back."""
    path = scratch_path(spark, "runs")
    run = {"run_id": "m1", "experiment": "monitoring", "run_name": "drift-check"}
    ref, prod = ref_orders(spark, sf_dir), prod_orders(spark, sf_dir)
    R.append_run(R.metric_rows(M.drift_metrics(ref, prod, prod, CFG), run), path)
    size = prod.agg(F.count("*").cast("double").alias("value")).select(F.lit("rows").alias("metric"), "value")
    R.append_run(R.metric_rows(size, run), path)
    R.append_run(R.param_rows(spark, {"category": CFG.category}, run), path)
    return tidy(R.read_runs(spark, path, "monitoring").select("kind", "key", "num_value", "str_value"))


@query(
    "overview",
    f"""WITH {METRICS_SQL}, {SCORES_SQL}, v AS (SELECT (SELECT value FROM metrics WHERE metric = 'category_psi') AS psi)
       SELECT (SELECT count(*) FROM prod) AS total_predictions, (SELECT count(*) FROM metrics WHERE value > threshold) AS active_alerts,
         round(psi, 6) AS category_psi, psi > 0.25 AS has_drift, printf('%.3f', (SELECT avg((label = prediction)::INT) FROM scored)) AS accuracy FROM v""",
)
def overview(spark, sf_dir):
    ref, prod = ref_orders(spark, sf_dir), prod_orders(spark, sf_dir)
    run = M.drift_summary(M.drift_metrics(ref, prod, prod, CFG)).select(F.col("alerts").alias("total_alerts"), "category_psi")
    quality = classification_metrics(scored_orders(spark, sf_dir), "label", "prediction").where("metric = 'accuracy'")
    model_runs = quality.select(F.lit("2024-01-01").cast("timestamp").alias("start_time"), F.col("value").alias("accuracy"))
    return tidy(M.overview(prod, run, model_runs, CFG))


@query(
    "source_status",
    """SELECT 'Reference Data' AS source, '✅ Available' AS status, count(*) AS rows FROM orders
       UNION ALL SELECT 'Production Inputs', '✅ Available', count(*) FROM events
       UNION ALL SELECT 'Production Predictions', '❌ Missing', NULL""",
)
def source_status(spark, sf_dir):
    return status_of(
        spark,
        {
            "Reference Data": f"{sf_dir}/orders.parquet",
            "Production Inputs": f"{sf_dir}/events.parquet",
            "Production Predictions": f"{sf_dir}/no-such-table.parquet",
        },
    )


@query(
    "append_logs",
    f"""SELECT event_id, event_type, value, NULL AS props, (ts < TIMESTAMP '{EVENT_CUT}') AS early, TRUE AS stamped FROM events WHERE ts < TIMESTAMP '{EVENT_CUT}'
       UNION ALL SELECT event_id, event_type, NULL, props, FALSE, TRUE FROM events WHERE ts >= TIMESTAMP '{EVENT_CUT}'""",
)
def append_logs(spark, sf_dir):
    """Two appends with different columns; the gaps read as null."""
    path = scratch_path(spark, "log")
    e = table(spark, sf_dir, "events")
    early = F.col("ts") < day(EVENT_CUT)
    append_log(e.where(early).select("event_id", "event_type", "value", F.lit(True).alias("early")), path)
    append_log(e.where(~early).select("event_id", "event_type", "props", F.lit(False).alias("early")), path)
    stamp = T.StructField("timestamp", T.TimestampType())
    schema = T.StructType([*e.select("event_id", "event_type", "value", "props").schema, T.StructField("early", T.BooleanType()), stamp])
    log = read_log(spark, path, schema)
    return log.select("event_id", "event_type", "value", "props", "early", F.col("timestamp").isNotNull().alias("stamped"))


@query(
    "compacted_log",
    """SELECT event_id, event_type, CASE WHEN event_id % 3 = 0 THEN value END AS value, ts::DATE AS day, 1::BIGINT AS files FROM events WHERE event_id % 3 < 2
       UNION ALL SELECT event_id, event_type, NULL, ts::DATE, 2 FROM events WHERE event_id % 3 = 2""",
)
def compacted_log(spark, sf_dir):
    """Events appended in four parts, the first three compacted to a file a day, the last appended after."""
    path = scratch_path(spark, "log")
    e = table(spark, sf_dir, "events").withColumn("timestamp", F.col("ts").cast("timestamp"))
    schema = T.StructType([*e.select("event_id", "event_type", "value", "timestamp").schema, T.StructField("day", T.DateType())])
    part = F.col("event_id") % 3
    append_log(e.where((part == 0) & (F.col("value") < 50)).select("event_id", "event_type", "value", "timestamp"), path)
    append_log(e.where((part == 0) & ~(F.col("value") < 50)).select("event_id", "event_type", "value", "timestamp"), path)
    append_log(e.where(part == 1).select("event_id", "event_type", "timestamp"), path)
    compact_log(spark, path, schema)
    append_log(e.where(part == 2).select("event_id", "event_type", "timestamp"), path)
    # Compacted rows are in one file for each of their days.
    log = read_log(spark, path, schema).withColumn("file", F.input_file_name())
    old = log.where(F.col("event_id") % 3 < 2)
    files = old.groupBy("day").agg(F.count_distinct("file").alias("files"))
    late = log.where(F.col("event_id") % 3 == 2).withColumn("files", F.lit(2).cast("bigint"))
    columns = ["event_id", "event_type", "value", "day", "files"]
    return old.join(files, "day").select(columns).unionByName(late.select(columns))


@query(
    "union_rows",
    f"""SELECT event_id, value, NULL AS props FROM events WHERE ts < TIMESTAMP '{EVENT_CUT}'
       UNION ALL BY NAME SELECT event_id, props FROM events WHERE ts >= TIMESTAMP '{EVENT_CUT}'""",
)
def union_rows(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    early = F.col("ts") < day(EVENT_CUT)
    return append_rows(e.where(early).select("event_id", "value"), e.where(~early).select("event_id", "props"))
