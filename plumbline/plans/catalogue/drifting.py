"""Drift measures, validation and the monitor on two halves of the orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import drift as D, monitor as M, validate as V
from plumbline.operators.profile import Profile, reference_profile
from plumbline.plans.catalogue.base import (
    EVENT_CUT,
    HALVES,
    PSI_TERM,
    aligned_sql,
    day,
    kl_sql,
    numeric_psi_sql,
    prod_orders,
    psi_sql,
    query,
    ref_orders,
    shares_sql,
    table,
    tidy,
)
from plumbline.operators.counts import new_category_list as new_category_table
from plumbline.plans.flows import recorded_monitoring
from plumbline.session import scratch_path
from plumbline.sources.runs import MONITOR_KEYS, latest_runs, read_runs

CFG = M.MonitorConfig(category="priority", high_cardinality="address")


def _halves(spark, sf_dir):
    return ref_orders(spark, sf_dir), prod_orders(spark, sf_dir)


@query("categorical_psi", f"WITH {HALVES} SELECT round({psi_sql('priority', 20)}, 6) AS psi")
def categorical_psi(spark, sf_dir):
    return tidy(D.categorical_psi(*_halves(spark, sf_dir), "priority"))


@query("categorical_psi_plain", f"WITH {HALVES} SELECT round({psi_sql('priority', 1, True)}, 6) AS psi")
def categorical_psi_plain(spark, sf_dir):
    return tidy(D.categorical_psi(*_halves(spark, sf_dir), "priority", scale=1, dropna=True))


@query("numerical_psi", f"WITH {HALVES} SELECT round({numeric_psi_sql('price')}, 6) AS psi")
def numerical_psi(spark, sf_dir):
    return tidy(D.numerical_psi(*_halves(spark, sf_dir), "price"))


@query("prediction_kl", f"WITH {HALVES} SELECT round({kl_sql('price_category', 'prediction', 3)}, 6) AS kl")
def prediction_kl(spark, sf_dir):
    return tidy(D.prediction_kl(*_halves(spark, sf_dir), "price_category", "prediction"))


@query("prediction_kl_mixed_types", f"WITH {HALVES} SELECT round({kl_sql('price_category', 'prediction', 3)}, 6) AS kl")
def prediction_kl_mixed_types(spark, sf_dir):
    """Whole-number classes against predictions that are doubles."""
    ref, prod = _halves(spark, sf_dir)
    prod = prod.withColumn("prediction", F.col("prediction").cast("double"))
    return tidy(D.prediction_kl(ref, prod, "price_category", "prediction"))


@query(
    "cardinality_ratio",
    f"""WITH {HALVES}, c AS (SELECT (SELECT count(DISTINCT address) FROM ref) AS r, (SELECT count(DISTINCT address) FROM prod) AS p)
       SELECT r AS ref_unique, p AS prod_unique, round(p / greatest(r, 1) / 2.5, 6) AS cardinality_ratio FROM c""",
)
def cardinality_ratio(spark, sf_dir):
    return tidy(D.cardinality_ratio(*_halves(spark, sf_dir), "address"))


KS_SERIES = """CASE WHEN z < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * list_sum(list_transform(range(1, 101),
  lambda i: CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END * exp(-2.0 * i * i * z * z))))) END"""


def ks_sql(rows: str) -> str:
    """``d, n, m, p`` from rows ``x, r, p``."""
    return f"""(SELECT d, n, m, {KS_SERIES} AS p FROM (SELECT d, n, m, d * sqrt(n * m / (n + m)) AS z FROM (
      SELECT max(abs(cr / n - cp / m)) AS d, any_value(n)::DOUBLE AS n, any_value(m)::DOUBLE AS m FROM (
        SELECT sum(r) OVER w AS cr, sum(p) OVER w AS cp, sum(r) OVER () AS n, sum(p) OVER () AS m FROM (
          SELECT x, sum(r) AS r, sum(p) AS p FROM ({rows}) WHERE x IS NOT NULL GROUP BY x) WINDOW w AS (ORDER BY x)))))"""


@query(
    "ks_test",
    f"""SELECT n::BIGINT AS ref_n, m::BIGINT AS prod_n, round(d, 9) AS ks_statistic, round(p, 9) AS ks_pvalue, p < 0.05 AS drift_detected
       FROM {ks_sql(f"SELECT value AS x, (ts < TIMESTAMP '{EVENT_CUT}')::INT AS r, (ts >= TIMESTAMP '{EVENT_CUT}')::INT AS p FROM events")}""",
)
def ks_test(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    early = F.col("ts") < day(EVENT_CUT)
    return tidy(D.ks_test(e.where(early), e.where(~early), "value"), 9)


def _chi_sql(column: str) -> str:
    return f"""(SELECT sum((np - x) * (np - x) / x) AS chi2, count(*) - 1 AS df FROM (
      SELECT np, nr / sum(nr) OVER () * sum(np) OVER () AS x FROM {aligned_sql(column, column, True)} WHERE nr > 0 AND np > 0))"""


# Upper tail for an even number of degrees of freedom, 2 or 4.
_TAIL = "exp(-chi2 / 2) * CASE df WHEN 2 THEN 1 WHEN 4 THEN 1 + chi2 / 2 END"


@query(
    "chi_square",
    f"""WITH {HALVES} SELECT 'priority' AS feature, round(chi2, 6) AS chi2, df, round({_TAIL}, 6) AS p_value FROM {_chi_sql('priority')}
       UNION ALL SELECT 'status', round(chi2, 6), df, round({_TAIL}, 6) FROM {_chi_sql('status')}""",
)
def chi_square(spark, sf_dir):
    return tidy(D.chi_square(*_halves(spark, sf_dir), ["priority", "status"]))


# --- validation ---------------------------------------------------------------


def _checks_inputs(spark, sf_dir, *more):
    """The halves with the columns to validate, and others; ``region`` is missing in production."""
    ref, prod = _halves(spark, sf_dir)
    key = F.col("o_orderkey")
    empty = F.lit(None).cast("double")
    ref = ref.select(
        "priority", "status", "price", (key % 7).cast("double").alias("level"),
        F.pow(key % 50, 6).alias("tail"), key.cast("double").alias("gone"), F.col("status").alias("region"),
        *[c for c in more if c in ref.columns],
    )
    prod = prod.select(
        "priority", "status", "price",
        F.when(key % 8 == 0, F.lit(None)).otherwise(key % 7).cast("double").alias("level"),
        F.pow(key % 50, 6).alias("tail"), empty.alias("gone"),
        *[c for c in more if c in prod.columns],
    )
    return ref, prod


_CHECK_TABLES = f"""{HALVES},
r AS (SELECT priority, status, price, (o_orderkey % 7)::DOUBLE AS level, pow(o_orderkey % 50, 6) AS tail, o_orderkey::DOUBLE AS gone FROM ref),
p AS (SELECT priority, status, price, CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE (o_orderkey % 7)::DOUBLE END AS level,
        pow(o_orderkey % 50, 6) AS tail, NULL::DOUBLE AS gone FROM prod)"""


def _moments_sql(column: str) -> str:
    def side(t: str) -> str:
        return f"""(SELECT avg(x) AS mean, stddev_samp(x) AS std, avg((x - m) * (x - m) * (x - m)) / pow(stddev_pop(x), 3) AS skew,
          (count(*) - count(x)) / count(*) AS missing, count(x) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3
          FROM (SELECT {column} AS x, avg({column}) OVER () AS m FROM {t}))"""

    return f"""(SELECT '{column}' AS feature, a.mean AS r_mean, b.mean AS p_mean, a.std AS r_std, b.std AS p_std, a.skew AS r_skew,
        b.skew AS p_skew, a.missing AS r_missing, b.missing AS p_missing,
        abs(b.mean - a.mean) / greatest(abs(a.mean), 1e-6) AS mean_shift, abs(b.std - a.std) / greatest(a.std, 1e-6) AS std_shift,
        (SELECT count(*) FROM p WHERE {column} < b.q1 - 1.5 * (b.q3 - b.q1) OR {column} > b.q3 + 1.5 * (b.q3 - b.q1)) AS outliers,
        b.n AS p_n
      FROM {side('r')} a, {side('p')} b)"""


def _numeric_checks_sql() -> str:
    m = "(" + " UNION ALL ".join(f"SELECT * FROM {_moments_sql(c)}" for c in ("price", "level", "tail")) + ")"
    return f"""m AS (SELECT *, outliers / p_n AS outlier_pct FROM {m}),
numeric_checks AS (
  SELECT feature, 'mean_shift' AS check_name, CASE WHEN mean_shift > 0.1 THEN 'failed' ELSE 'passed' END AS status,
    CASE WHEN mean_shift > 0.1 THEN 'alert' ELSE 'pass' END AS level,
    CASE WHEN mean_shift > 0.1 THEN CASE WHEN mean_shift > 0.2 THEN 'high' ELSE 'medium' END END AS severity,
    r_mean AS ref_value, p_mean AS prod_value, mean_shift AS value FROM m
  UNION ALL SELECT feature, 'std_shift', 'failed', 'warning', NULL, r_std, p_std, std_shift FROM m WHERE std_shift > 0.1
  UNION ALL SELECT feature, 'outliers', 'warning', 'warning', NULL, NULL, outliers, outlier_pct FROM m WHERE outlier_pct > 0.05
  UNION ALL SELECT feature, 'skewness', 'warning', 'warning', NULL, r_skew, p_skew, p_skew FROM m WHERE abs(p_skew) > 2
  UNION ALL SELECT feature, 'missing_values', 'warning', 'warning', NULL, r_missing, p_missing, p_missing FROM m WHERE p_missing > r_missing + 0.05
  UNION ALL SELECT 'gone', 'empty_column', 'failed', 'alert', NULL, NULL, NULL, NULL
)"""


def _category_checks_sql() -> str:
    def fresh(c: str) -> str:
        return f"""SELECT '{c}' AS feature, sum((nr = 0)::INT) AS new_values, sum(CASE WHEN nr = 0 THEN np ELSE 0 END) / sum(np) AS share
          FROM {aligned_sql(c, c, True)}"""

    def chi(c: str) -> str:
        return f"SELECT '{c}' AS feature, chi2, df, {_TAIL} AS p FROM {_chi_sql(c)}"

    return f"""fresh AS ({fresh('priority')} UNION ALL {fresh('status')}), chi AS ({chi('priority')} UNION ALL {chi('status')}),
category_checks AS (
  SELECT feature, 'new_categories' AS check_name, CASE WHEN share < 0.1 THEN 'warning' ELSE 'failed' END AS status,
    CASE WHEN share > 0.1 THEN 'alert' ELSE 'warning' END AS level, CASE WHEN share > 0.1 THEN 'high' END AS severity,
    NULL::DOUBLE AS ref_value, new_values::DOUBLE AS prod_value, share AS value FROM fresh WHERE new_values > 0
  UNION ALL SELECT feature, 'distribution_shift', 'failed', 'alert', 'medium', df, chi2, p FROM chi WHERE p < 0.05
  UNION ALL SELECT 'region', 'missing_column', 'warning', 'warning', NULL, NULL, NULL, NULL
)"""


CHECKS_SQL = f"""{_CHECK_TABLES}, {_numeric_checks_sql()}, {_category_checks_sql()},
checks AS (SELECT * FROM numeric_checks UNION ALL SELECT * FROM category_checks)"""


@query(
    "validation_checks",
    f"""WITH {CHECKS_SQL} SELECT feature, check_name AS "check", status, level, severity, round(ref_value, 5) AS ref_value,
         round(prod_value, 5) AS prod_value, round(value, 5) AS value FROM checks""",
)
def validation_checks(spark, sf_dir):
    return tidy(V.validate(*_checks_inputs(spark, sf_dir)).drop("type", "message"), 5)


@query(
    "validation_by_profile",
    f"""WITH {CHECKS_SQL} SELECT feature, check_name AS "check", status, level, severity, round(ref_value, 5) AS ref_value,
         round(prod_value, 5) AS prod_value, round(value, 5) AS value FROM checks""",
)
def validation_by_profile(spark, sf_dir):
    """The same checks against a profile that was saved and loaded."""
    ref, prod = _checks_inputs(spark, sf_dir)
    path = scratch_path(spark, "profile")
    reference_profile(ref).save(path)
    return tidy(V.validate_against(Profile.load(spark, path), prod).drop("type", "message"), 5)


@query(
    "validation_messages",
    f"""WITH {CHECKS_SQL} SELECT feature, check_name AS "check", CASE check_name
         WHEN 'mean_shift' THEN CASE WHEN level = 'alert' THEN printf('The mean moved by %.2f%%', value * 100) END
         WHEN 'std_shift' THEN printf('The standard deviation moved by %.2f%%', value * 100)
         WHEN 'outliers' THEN printf('%.2f%% of the values lie outside the fences', value * 100)
         WHEN 'skewness' THEN printf('Skewness %.2f is beyond the limit', value)
         WHEN 'missing_values' THEN printf('Missing share %.2f%% against %.2f%%', prod_value * 100, ref_value * 100)
         WHEN 'empty_column' THEN 'Production has no value in gone'
         WHEN 'missing_column' THEN 'Production lacks the column region'
         WHEN 'new_categories' THEN printf('%d values unknown to the reference, in %.2f%% of the rows', prod_value::BIGINT, value * 100)
         ELSE printf('Shares differ from the reference, p = %.4f', value) END AS message FROM checks""",
)
def validation_messages(spark, sf_dir):
    return V.validate(*_checks_inputs(spark, sf_dir)).select("feature", "check", "message")


@query(
    "new_category_list",
    f"""WITH {HALVES} SELECT 'address' AS feature, address AS value, count(*) AS n_prod FROM prod
       WHERE address IS NOT NULL AND address NOT IN (SELECT address FROM ref WHERE address IS NOT NULL) GROUP BY address
       UNION ALL SELECT 'priority', priority, count(*) FROM prod
       WHERE priority IS NOT NULL AND priority NOT IN (SELECT priority FROM ref WHERE priority IS NOT NULL) GROUP BY priority""",
)
def new_category_list(spark, sf_dir):
    """Every address and priority that only the later half has."""
    return new_category_table(*_halves(spark, sf_dir), ["address", "priority"])


@query(
    "validation_summary",
    f"""WITH {CHECKS_SQL} SELECT count(*) FILTER (level = 'alert') = 0 AS passed, count(*) FILTER (level = 'alert') AS alerts,
         count(*) FILTER (level = 'warning') AS warnings FROM checks""",
)
def validation_summary(spark, sf_dir):
    return V.validation_summary(V.validate(*_checks_inputs(spark, sf_dir)))


@query(
    "validation_report",
    f"""WITH {CHECKS_SQL}, a AS (SELECT row_number() OVER (ORDER BY feature, check_name) AS i, feature, check_name,
           CASE check_name WHEN 'mean_shift' THEN printf('The mean moved by %.2f%%', value * 100)
             WHEN 'empty_column' THEN 'Production has no value in gone'
             WHEN 'new_categories' THEN printf('%d values unknown to the reference, in %.2f%% of the rows', prod_value::BIGINT, value * 100)
             ELSE printf('Shares differ from the reference, p = %.4f', value) END AS message FROM checks WHERE level = 'alert'),
         c AS (SELECT count(*) FILTER (level = 'alert') AS alerts, count(*) FILTER (level = 'warning') AS warnings FROM checks)
       SELECT 0 AS line, 'Status: ' || CASE WHEN alerts = 0 THEN '✅ Passed' ELSE '❌ Failed' END AS text FROM c
       UNION ALL SELECT 1, 'Alerts: ' || alerts FROM c UNION ALL SELECT 2, 'Warnings: ' || warnings FROM c
       UNION ALL SELECT (i + 2)::INT, '- ' || feature || ' (' || check_name || '): ' || message FROM a WHERE i <= 2
       UNION ALL SELECT 5, '... and ' || (alerts - 2) || ' more alerts' FROM c WHERE alerts > 2""",
)
def validation_report(spark, sf_dir):
    return V.validation_report(V.validate(*_checks_inputs(spark, sf_dir)), shown=2)


# --- the monitor ----------------------------------------------------------------

METRICS_SQL = f"""{HALVES},
metrics AS (
  SELECT 'category_psi' AS metric, {psi_sql('priority', 60)} AS value, 0.25 AS threshold
  UNION ALL SELECT 'cardinality_ratio',
    (SELECT count(DISTINCT address) FROM prod) / greatest((SELECT count(DISTINCT address) FROM ref), 1) / 2.5, 1.3
  UNION ALL SELECT 'prediction_kl', {kl_sql('price_category', 'prediction', 3)}, 0.15
)"""


def _metrics(spark, sf_dir):
    ref, prod = _halves(spark, sf_dir)
    return M.drift_metrics(ref, prod, prod, CFG)


@query("drift_monitor", f"WITH {METRICS_SQL} SELECT metric, round(value, 6) AS value, threshold::DOUBLE AS threshold, value > threshold AS alert FROM metrics")
def drift_monitor(spark, sf_dir):
    return tidy(_metrics(spark, sf_dir))


@query(
    "drift_summary",
    f"""WITH {METRICS_SQL}, a AS (SELECT count(*) FILTER (value > threshold) AS alerts FROM metrics)
       SELECT round(max(value) FILTER (metric = 'category_psi'), 6) AS category_psi,
         round(max(value) FILTER (metric = 'cardinality_ratio'), 6) AS cardinality_ratio,
         round(max(value) FILTER (metric = 'prediction_kl'), 6) AS prediction_kl, any_value(alerts) AS alerts,
         least(any_value(alerts), 3)::INT AS drift_severity,
         ['stable', 'low', 'medium', 'high'][least(any_value(alerts), 3) + 1] AS drift_status FROM metrics, a""",
)
def drift_summary(spark, sf_dir):
    return tidy(M.drift_summary(_metrics(spark, sf_dir)))


@query(
    "drift_report",
    f"""WITH {METRICS_SQL} SELECT metric, CASE WHEN metric = 'cardinality_ratio' THEN printf('%.2f', value) ELSE printf('%.3f', value) END AS value,
         threshold::DOUBLE AS threshold, CASE WHEN value > threshold THEN '❌' ELSE '✅' END AS status FROM metrics""",
)
def drift_report(spark, sf_dir):
    return M.drift_report(_metrics(spark, sf_dir))


_CHECKS_ONLY = CHECKS_SQL.replace(HALVES + ",", "", 1)


@query(
    "retrain_decision",
    f"""WITH {METRICS_SQL}, {_CHECKS_ONLY},
       a AS (SELECT count(*) FILTER (value > threshold) AS drift FROM metrics),
       c AS (SELECT count(*) FILTER (level = 'alert') AS alerts, count(*) FILTER (level = 'warning') AS warnings FROM checks)
       SELECT drift AS drift_alerts, least(drift, 3)::INT AS drift_severity,
         ['stable', 'low', 'medium', 'high'][least(drift, 3) + 1] AS drift_status, alerts = 0 AS feature_validation_passed,
         alerts AS feature_validation_alerts, warnings AS feature_validation_warnings, drift + alerts AS total_alerts,
         drift + alerts >= 3 AS retrain FROM a, c""",
)
def retrain_decision(spark, sf_dir):
    return M.retrain_decision(_metrics(spark, sf_dir), V.validate(*_checks_inputs(spark, sf_dir)), CFG)


@query(
    "monitor_run_recorded",
    f"""WITH {METRICS_SQL}, {_CHECKS_ONLY},
       a AS (SELECT count(*) FILTER (value > threshold) AS drift FROM metrics),
       c AS (SELECT count(*) FILTER (level = 'alert') AS alerts, count(*) FILTER (level = 'warning') AS warnings FROM checks)
       SELECT max(round(value, 6)) FILTER (metric = 'category_psi') AS category_psi, max(round(value, 6)) FILTER (metric = 'cardinality_ratio') AS cardinality_ratio,
         max(round(value, 6)) FILTER (metric = 'prediction_kl') AS prediction_kl, any_value(drift + alerts)::DOUBLE AS total_alerts,
         any_value(least(drift, 3))::DOUBLE AS drift_severity, any_value(alerts)::DOUBLE AS feature_validation_alerts,
         any_value(drift + alerts >= 3)::VARCHAR AS retrain, 1::BIGINT AS start_times FROM metrics, a, c""",
)
def monitor_run_recorded(spark, sf_dir):
    """A monitoring run as the run store has it: the dashboard's keys, one start time for all rows."""
    ref, prod = _checks_inputs(spark, sf_dir, "address", "price_category", "prediction")
    out = scratch_path(spark, "monitor-run")
    run = recorded_monitoring(ref, prod, prod, f"{out}/runs", out, CFG, skip=("address", "price_category", "prediction"))
    rows = read_runs(spark, f"{out}/runs", "monitoring").where(F.col("run_id") == run.run_id)
    wide = latest_runs(rows, MONITOR_KEYS, params=["retrain"]).select(*MONITOR_KEYS, F.lower("retrain").alias("retrain"))
    return tidy(wide.withColumn("start_times", rows.select(F.count_distinct("start_time")).scalar()))


def _stats_inputs(spark, sf_dir):
    ref, prod = _halves(spark, sf_dir)
    return ref.drop("price_category"), prod.drop("prediction")


def _numeric_stats_sql(column: str) -> str:
    rows = f"SELECT {column}::DOUBLE AS x, 1 AS r, 0 AS p FROM ref UNION ALL SELECT {column}, 0, 1 FROM prod"
    return f"""SELECT '{column}' AS feature, 'numerical' AS type,
      (SELECT avg({column}) FROM ref) AS ref_mean, (SELECT avg({column}) FROM prod) AS prod_mean,
      (SELECT stddev_samp({column}) FROM ref) AS ref_std, (SELECT stddev_samp({column}) FROM prod) AS prod_std,
      (SELECT median({column}::DOUBLE) FROM ref) AS ref_median, (SELECT median({column}::DOUBLE) FROM prod) AS prod_median,
      {numeric_psi_sql(column)} AS psi, d AS ks_statistic, p AS ks_pvalue, NULL::BIGINT AS ref_unique, NULL::BIGINT AS prod_unique,
      NULL::DOUBLE AS cardinality_ratio, p < 0.05 AS drift_detected FROM {ks_sql(rows)}"""


def _text_stats_sql(column: str) -> str:
    return f"""SELECT '{column}' AS feature, 'categorical' AS type, NULL AS ref_mean, NULL AS prod_mean, NULL AS ref_std, NULL AS prod_std,
      NULL AS ref_median, NULL AS prod_median, psi, NULL AS ks_statistic, NULL AS ks_pvalue, r AS ref_unique, p AS prod_unique,
      p / greatest(r, 1) / 2.5 AS cardinality_ratio, psi > 0.25 AS drift_detected
    FROM (SELECT {psi_sql(column, 80, True)} AS psi, (SELECT count(DISTINCT {column}) FROM ref) AS r, (SELECT count(DISTINCT {column}) FROM prod) AS p)"""


STATS_SQL = " UNION ALL ".join(
    [_numeric_stats_sql(c) for c in ("o_orderkey", "price")] + [_text_stats_sql(c) for c in ("priority", "status", "address")]
)
_ROUNDED = ", ".join(
    f"round({c}, 6) AS {c}"
    for c in [
        "ref_mean", "prod_mean", "ref_std", "prod_std", "ref_median", "prod_median", "psi", "ks_statistic",
        "ks_pvalue", "cardinality_ratio",
    ]
)


@query(
    "feature_statistics",
    f"WITH {HALVES}, s AS ({STATS_SQL}) SELECT feature, type, {_ROUNDED}, ref_unique, prod_unique, drift_detected FROM s",
)
def feature_statistics(spark, sf_dir):
    return tidy(M.feature_statistics(*_stats_inputs(spark, sf_dir), CFG))


@query(
    "feature_table",
    f"""WITH {HALVES}, s AS ({STATS_SQL}) SELECT feature, type, round(psi, 4) AS psi,
         CASE WHEN drift_detected THEN '⚠️ Yes' ELSE '✅ No' END AS drift_detected FROM s""",
)
def feature_table(spark, sf_dir):
    return M.feature_table(M.feature_statistics(*_stats_inputs(spark, sf_dir), CFG))


@query(
    "alert_board",
    f"""WITH {METRICS_SQL}, s AS ({STATS_SQL}), t AS (
         SELECT *, CASE WHEN metric = 'cardinality_ratio' THEN printf('%.2f', value) ELSE printf('%.4f', value) END AS shown,
           threshold::DOUBLE::VARCHAR AS limit_text FROM metrics)
       SELECT CASE WHEN value > threshold THEN 'critical' ELSE 'warning' END AS level, metric, shown AS value, limit_text AS threshold,
         CASE WHEN metric = 'category_psi' AND value <= threshold THEN 'Categories are close to shifting: PSI ' || shown || ', limit ' || limit_text
           WHEN metric = 'category_psi' THEN 'Categories have shifted: PSI ' || shown || ', limit ' || limit_text
           WHEN metric = 'cardinality_ratio' THEN 'Distinct values have grown: ratio ' || shown || ', limit ' || limit_text
           ELSE 'Predictions have shifted: KL ' || shown || ', limit ' || limit_text END AS message
       FROM t WHERE value > threshold OR (metric = 'category_psi' AND value > threshold * 0.8)
       UNION ALL SELECT 'alert', 'Feature: ' || feature, 'PSI: ' || printf('%.4f', psi), 'N/A',
         'Feature ' || feature || ' has shifted' FROM s WHERE drift_detected""",
)
def alert_board(spark, sf_dir):
    stats = M.feature_statistics(*_stats_inputs(spark, sf_dir), CFG)
    return M.alert_board(_metrics(spark, sf_dir), stats, CFG)


@query("psi_terms", f"WITH {HALVES} SELECT v AS value, round({PSI_TERM}, 9) + 0.0 AS term FROM {shares_sql('priority', 'priority')}")
def psi_terms(spark, sf_dir):
    """The contribution of each category to its feature's PSI."""
    from plumbline.functions.terms import psi_term, share
    from plumbline.operators.counts import count_table
    from plumbline.session import one_row

    counts = count_table(*_halves(spark, sf_dir), ["priority"])
    t = one_row(counts.agg(F.sum("n_ref").alias("r"), F.sum("n_prod").alias("p")))
    return tidy(
        counts.select("value", psi_term(share(F.col("n_ref"), t["r"]), share(F.col("n_prod"), t["p"])).alias("term")), 9
    )
