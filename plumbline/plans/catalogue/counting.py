"""Counts, alignment, profiles and histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import counts as K, profile as P
from plumbline.plans.catalogue.base import HALVES, aligned_sql, prod_orders, query, ref_orders, shares_sql, table, tidy
from plumbline.sources.tables import fill_missing

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("value_counts", "SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1")
def value_counts(spark, sf_dir):
    return K.value_counts(table(spark, sf_dir, "events"), "event_type")


@query(
    "value_shares",
    "SELECT l_partkey AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM lineitem), 9) AS share FROM lineitem GROUP BY 1",
)
def value_shares(spark, sf_dir):
    return tidy(K.value_shares(table(spark, sf_dir, "lineitem"), "l_partkey"), 9)


@query(
    "top10_shares",
    """SELECT l_partkey AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM lineitem), 9) AS share
       FROM lineitem GROUP BY 1 ORDER BY n DESC, value LIMIT 10""",
)
def top10_shares(spark, sf_dir):
    return tidy(K.top_shares(table(spark, sf_dir, "lineitem"), "l_partkey", 10), 9)


@query("top20_counts", "SELECT l_partkey AS value, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, value LIMIT 20")
def top20_counts(spark, sf_dir):
    return K.top_counts(table(spark, sf_dir, "lineitem"), "l_partkey", 20)


def _top(side: str, measure: str) -> str:
    return f"""(SELECT address AS v, count(*) AS n, count(*) / (SELECT count(*) FROM {side}) AS share
        FROM {side} GROUP BY 1 ORDER BY n DESC, v LIMIT 10)"""


@query(
    "aligned_top10",
    f"""WITH {HALVES} SELECT coalesce(r.v, p.v) AS value, round(coalesce(r.share, 0), 9) AS reference,
         round(coalesce(p.share, 0), 9) AS production
       FROM {_top('ref', 'share')} r FULL JOIN {_top('prod', 'share')} p ON r.v = p.v""",
)
def aligned_top10(spark, sf_dir):
    return tidy(K.aligned_top(ref_orders(spark, sf_dir), prod_orders(spark, sf_dir), "address", 10), 9)


@query(
    "aligned_top10_counts",
    f"""WITH {HALVES} SELECT coalesce(r.v, p.v) AS value, coalesce(r.n, 0) AS reference, coalesce(p.n, 0) AS production
       FROM (SELECT priority AS v, count(*) AS n FROM ref WHERE priority IS NOT NULL GROUP BY 1) r
       FULL JOIN (SELECT priority AS v, count(*) AS n FROM prod WHERE priority IS NOT NULL GROUP BY 1) p ON r.v = p.v""",
)
def aligned_top10_counts(spark, sf_dir):
    return K.aligned_top(ref_orders(spark, sf_dir), prod_orders(spark, sf_dir), "priority", 10, normalize=False)


@query(
    "class_share_compare",
    f"""WITH {HALVES} SELECT v::INT AS value, round(e, 9) AS reference, round(a, 9) AS production
       FROM {shares_sql('price_category', 'prediction', True)}""",
)
def class_share_compare(spark, sf_dir):
    out = K.compare_shares(ref_orders(spark, sf_dir), prod_orders(spark, sf_dir), "price_category", "prediction")
    return tidy(out, 9)


@query(
    "class_share_compare_mixed_types",
    f"""WITH {HALVES} SELECT v::DOUBLE AS value, round(e, 9) AS reference, round(a, 9) AS production
       FROM {shares_sql('price_category', 'prediction', True)}""",
)
def class_share_compare_mixed_types(spark, sf_dir):
    """Whole-number classes against predictions that are doubles."""
    prod = prod_orders(spark, sf_dir).withColumn("prediction", F.col("prediction").cast("double"))
    return tidy(K.compare_shares(ref_orders(spark, sf_dir), prod, "price_category", "prediction"), 9)


@query(
    "cardinality_growth",
    f"""WITH {HALVES} SELECT 'reference' AS dataset, count(DISTINCT address) AS unique_values FROM ref
       UNION ALL SELECT 'production', count(DISTINCT address) FROM prod""",
)
def cardinality_growth(spark, sf_dir):
    return K.cardinality_growth(ref_orders(spark, sf_dir), prod_orders(spark, sf_dir), "address")


@query("distinct_count", "SELECT count(DISTINCT l_partkey) AS n_distinct FROM lineitem")
def distinct_count(spark, sf_dir):
    return K.distinct_count(table(spark, sf_dir, "lineitem"), "l_partkey")


@query(
    "aligned_counts",
    f"""WITH {HALVES} SELECT 'priority' AS feature, v AS value, nr::BIGINT AS n_ref, np::BIGINT AS n_prod FROM {aligned_sql('priority', 'priority')}
       UNION ALL SELECT 'address', v, nr::BIGINT, np::BIGINT FROM {aligned_sql('address', 'address')}""",
)
def aligned_counts(spark, sf_dir):
    return K.count_table(ref_orders(spark, sf_dir), prod_orders(spark, sf_dir), ["priority", "address"])


@query(
    "new_and_common_categories",
    f"""WITH {HALVES},
       fresh AS (SELECT priority FROM prod WHERE priority IS NOT NULL EXCEPT SELECT priority FROM ref),
       shared AS (SELECT priority FROM prod WHERE priority IS NOT NULL INTERSECT SELECT priority FROM ref)
       SELECT 'new' AS kind, p.priority AS value, count(*) AS n_prod FROM prod p JOIN fresh f ON p.priority = f.priority GROUP BY 2
       UNION ALL SELECT 'common', p.priority, count(*) FROM prod p JOIN shared s ON p.priority = s.priority GROUP BY 2""",
)
def new_and_common_categories(spark, sf_dir):
    counts = K.count_table(ref_orders(spark, sf_dir), prod_orders(spark, sf_dir), ["priority"])
    fresh = K.new_values(counts).select(F.lit("new").alias("kind"), "value", "n_prod")
    return fresh.unionByName(K.common_values(counts).select(F.lit("common").alias("kind"), "value", "n_prod"))


@query(
    "null_filters",
    """SELECT o_orderkey, filled, priority FROM (
         SELECT o_orderkey, o_totalprice, coalesce(CASE WHEN o_orderkey % 23 <> 0 THEN o_totalprice END, 0.0) AS filled,
           CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END AS priority FROM orders)
       WHERE priority IS NOT NULL AND o_totalprice BETWEEN 1000 AND 400000""",
)
def null_filters(spark, sf_dir):
    """Missing prices filled, rows without a priority dropped, a price range kept."""
    key = F.col("o_orderkey")
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.when(key % 23 != 0, F.col("o_totalprice")).alias("filled"),
        F.when(key % 10 != 0, F.col("o_orderpriority")).alias("priority"),
    )
    kept = df.na.drop(subset=["priority"]).where(F.col("o_totalprice").between(1000, 400000))
    return fill_missing(kept, {"filled": 0.0}).drop("o_totalprice")


def _numeric_profile_sql(column: str, missing: str) -> str:
    return f"""SELECT '{column}' AS feature, 'numerical' AS type, count(x) AS n, round(avg(x), 7) AS mean,
      round(stddev_samp(x), 7) AS std, round(median(x), 7) AS median, min(x) AS min, max(x) AS max,
      round(quantile_cont(x, 0.25), 7) AS q25, round(quantile_cont(x, 0.75), 7) AS q75,
      round(quantile_cont(x, 0.75) - quantile_cont(x, 0.25), 7) AS iqr,
      round(avg((x - m) * (x - m) * (x - m)) / pow(stddev_pop(x), 3), 7) + 0.0 AS skewness,
      round(kurtosis_pop(x), 7) AS kurtosis, count(*) - count(x) AS missing_count,
      round((count(*) - count(x)) / count(*), 7) AS missing_pct
    FROM (SELECT x, avg(x) OVER () AS m FROM (SELECT {missing} AS x FROM lineitem))"""


def _gappy_lines(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_NUMBERS)
    return df.withColumn("l_extendedprice", F.when(F.col("l_orderkey") % 23 != 0, F.col("l_extendedprice")))


@query(
    "numeric_profile",
    " UNION ALL ".join(
        _numeric_profile_sql(c, "CASE WHEN l_orderkey % 23 <> 0 THEN l_extendedprice END" if c == "l_extendedprice" else c)
        for c in LINE_NUMBERS
    ),
)
def numeric_profile(spark, sf_dir):
    return tidy(P.numeric_profile(_gappy_lines(spark, sf_dir), LINE_NUMBERS), 7)


def _categorical_profile_sql(column: str, expr: str) -> str:
    return f"""SELECT * FROM (WITH c AS (SELECT {expr} AS v, count(*) AS n FROM orders GROUP BY 1),
        t AS (SELECT sum(n) AS total, sum(n) FILTER (v IS NOT NULL) AS present FROM c)
      SELECT '{column}' AS feature, 'categorical' AS type, any_value(present)::BIGINT AS n, count(v) AS unique_count,
        (SELECT v FROM c WHERE v IS NOT NULL ORDER BY n DESC, v LIMIT 1) AS most_frequent,
        round(max(n) FILTER (v IS NOT NULL) / any_value(present), 6) AS most_frequent_pct,
        any_value(total - present)::BIGINT AS missing_count, round(any_value((total - present) / total), 6) AS missing_pct
      FROM c, t)"""


@query(
    "categorical_profile",
    " UNION ALL ".join(
        _categorical_profile_sql(c, e)
        for c, e in [
            ("o_orderpriority", "CASE WHEN o_orderkey % 23 <> 0 THEN o_orderpriority END"),
            ("o_orderstatus", "o_orderstatus"),
            ("o_custkey", "o_custkey::VARCHAR"),
        ]
    ),
)
def categorical_profile(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 23 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
        "o_orderstatus",
        F.col("o_custkey").cast("string").alias("o_custkey"),
    )
    return tidy(P.categorical_profile(df, ["o_orderpriority", "o_orderstatus", "o_custkey"]))


_ABOVE = " + ".join(f"(x > lo + {i} * ((hi - lo) / 10))::INT" for i in range(1, 10))


@query(
    "histogram10",
    f"""SELECT 1 + {_ABOVE} AS bin, count(*) AS n FROM (SELECT l_extendedprice AS x FROM lineitem),
         (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem) GROUP BY 1""",
)
def histogram10(spark, sf_dir):
    return P.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice")


@query(
    "histogram30",
    """SELECT bin, round(lo + bin * w, 6) AS bin_start, count(*) AS n FROM (
         SELECT least(floor((l_extendedprice - lo) / w), 29)::INT AS bin, lo, w FROM lineitem,
           (SELECT min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 30 AS w FROM lineitem))
       GROUP BY bin, lo, w""",
)
def histogram30(spark, sf_dir):
    return tidy(P.display_histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice"))


@query(
    "box_stats",
    """WITH x AS (SELECT least(l_extendedprice * l_tax * 10, 90000) + CASE WHEN l_orderkey % 97 = 0 THEN 250000 ELSE 0 END AS x FROM lineitem),
       q AS (SELECT count(x) AS n, quantile_cont(x, 0.25) AS a, median(x) AS b, quantile_cont(x, 0.75) AS c FROM x)
       SELECT any_value(n) AS n, round(any_value(a), 6) AS q25, round(any_value(b), 6) AS median, round(any_value(c), 6) AS q75,
         round(min(x), 6) AS whisker_low, round(max(x), 6) AS whisker_high
       FROM x, q WHERE x BETWEEN a - 1.5 * (c - a) AND c + 1.5 * (c - a)""",
)
def box_stats(spark, sf_dir):
    x = F.least(F.col("l_extendedprice") * F.col("l_tax") * 10, F.lit(90000.0))
    far = F.when(F.col("l_orderkey") % 97 == 0, 250000).otherwise(0)
    return tidy(P.box_stats(table(spark, sf_dir, "lineitem").select((x + far).alias("x")), "x"))


@query("hourly_counts", "SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1")
def hourly_counts(spark, sf_dir):
    out = K.hourly_counts(table(spark, sf_dir, "events"), "ts")
    return out.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@query(
    "recent_100",
    "SELECT event_id, ts, user_id, event_type, value FROM events ORDER BY ts DESC, event_id LIMIT 100",
)
def recent_100(spark, sf_dir):
    return K.recent_rows(table(spark, sf_dir, "events").drop("props"), "ts", "event_id", 100)


@query("time_span", "SELECT max(ts) AS latest, floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000)::BIGINT AS span_days FROM events")
def time_span(spark, sf_dir):
    return K.time_span(table(spark, sf_dir, "events"), "ts")


@query(
    "class_price_range",
    """WITH e AS (SELECT quantile_cont(o_totalprice, 0.4) AS e1, quantile_cont(o_totalprice, 0.8) AS e2 FROM orders)
       SELECT CASE WHEN o_totalprice <= e1 THEN 0 WHEN o_totalprice <= e2 THEN 1 ELSE 2 END AS price_class,
         min(o_totalprice) AS min, max(o_totalprice) AS max, count(o_totalprice) AS n FROM orders, e GROUP BY 1""",
)
def class_price_range(spark, sf_dir):
    from plumbline.operators.features import quantile_target

    df = quantile_target(table(spark, sf_dir, "orders").select("o_totalprice"), "o_totalprice", "price_class")
    return P.range_by_class(df, "o_totalprice", "price_class")
