"""Profiles and drift that are kept up to date instead of computed anew."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from plumbline.operators import sketches as S
from plumbline.plans.catalogue.base import KL_TERM, PSI_TERM, query, table, tidy
from plumbline.plans.catalogue.counting import LINE_NUMBERS, _numeric_profile_sql
from plumbline.session import scratch_path
from plumbline.streaming import accumulate as A, jobs as J

# Columns of a profile that merging leaves exact; quartiles are the sketch's.
EXACT = ["feature", "type", "n", "mean", "std", "min", "max", "skewness", "kurtosis", "missing_count", "missing_pct"]


@query(
    "merged_profile",
    "SELECT *, true AS quartiles_close FROM (SELECT "
    + ", ".join(f"round({c}, 5) AS {c}" if c in ("mean", "std", "skewness", "kurtosis", "missing_pct") else c for c in EXACT)
    + " FROM ("
    + " UNION ALL ".join(
        _numeric_profile_sql(c, "CASE WHEN l_orderkey % 23 <> 0 THEN l_extendedprice END" if c == "l_extendedprice" else c)
        for c in LINE_NUMBERS
    )
    + "))",
)
def merged_profile(spark, sf_dir):
    """Lines profiled in eight parts by ship month, and the parts merged.

    Quartiles are close if their ranks among all rows are within two hundredths.
    """
    folder = scratch_path(spark, "profiles")
    lines = table(spark, sf_dir, "lineitem")
    part = F.month("l_shipdate") % 8
    gappy = F.when(F.col("l_orderkey") % 23 != 0, F.col("l_extendedprice"))
    rows = lines.withColumn("l_extendedprice", gappy).select(part.alias("part"), *LINE_NUMBERS)
    states = S.numeric_state(rows, LINE_NUMBERS, ["part"])
    states.write.parquet(folder)
    merged = S.number_profile(S.merged_numbers(spark.read.parquet(folder)))
    wide = rows.select(*LINE_NUMBERS)
    found = merged.select("feature", "q25", "median", "q75").collect()
    close = []
    for r in found:
        c = F.col(r["feature"])
        for p, q in ((0.25, "q25"), (0.5, "median"), (0.75, "q75")):
            below, upto = F.avg((c < r[q]).cast("double")), F.avg((c <= r[q]).cast("double"))
            close.append(((below <= p + 0.02) & (upto >= p - 0.02)).alias(f"{r['feature']}_{q}"))
    flags = wide.agg(*close).first().asDict()
    ok = F.lit(False)
    for r in found:
        good = all(flags[f"{r['feature']}_{q}"] for q in ("q25", "median", "q75"))
        ok = F.when(F.col("feature") == r["feature"], F.lit(good)).otherwise(ok)
    return tidy(merged.select(*EXACT), 5).withColumn("quartiles_close", ok)


SLICES = 4
_MEASURES = f"""
  vals AS (SELECT DISTINCT b, event_type AS v FROM batches, events),
  tot AS (SELECT b, count(*) AS n FROM events, batches WHERE event_id % {SLICES} <= b GROUP BY 1),
  r AS (SELECT event_type AS v, count(*) / (SELECT count(*) FROM events WHERE event_type <> 'signup') AS e FROM events WHERE event_type <> 'signup' GROUP BY 1),
  c AS (SELECT b, event_type AS v, count(*) AS n FROM events, batches WHERE event_id % {SLICES} <= b GROUP BY 1, 2),
  s AS (SELECT vals.b, coalesce(r.e, 0) AS e, coalesce(c.n, 0) / tot.n AS a
        FROM vals JOIN tot USING (b) LEFT JOIN r ON r.v = vals.v LEFT JOIN c ON c.b = vals.b AND c.v = vals.v)"""


@query(
    "drift_log",
    f"""WITH batches AS (SELECT unnest(range({SLICES})) AS b), {_MEASURES}
       SELECT b AS batch_id, 'category_psi' AS metric, round(greatest(0, sum({PSI_TERM})) / 60, 9) AS value FROM s GROUP BY b
       UNION ALL SELECT b, 'prediction_kl', round(greatest(0, sum({KL_TERM})) / 3, 9) FROM s GROUP BY b
       UNION ALL SELECT b, 'cardinality_ratio', round(count(DISTINCT user_id) / (SELECT count(DISTINCT user_id) FROM events WHERE event_type <> 'signup') / 2.5, 9)
         FROM events, batches WHERE event_id % {SLICES} <= b GROUP BY b""",
)
def drift_log(spark, sf_dir):
    """Drift of all events so far after each of four batches, against all events but one type.

    The batch in the middle is written a second time, which must not count again.
    """
    out = scratch_path(spark, "drift-log")
    events = table(spark, sf_dir, "events")
    columns = {"category": "event_type", "entity": "user_id", "class": "event_type"}
    log = A.DriftLog(events.where(F.col("event_type") != "signup"), columns, columns, f"{out}/log", every=2)
    for i in range(SLICES):
        events.where(F.col("event_id") % SLICES == i).write.mode("append").parquet(f"{out}/events")
        stream = J.file_stream(spark, f"{out}/events", events.schema)
        log.start(stream, f"{out}/progress").awaitTermination()
    log.write(events.where(F.col("event_id") % SLICES == 1), 1)
    return tidy(log.metrics(spark).select("batch_id", "metric", "value"), 9)


SKETCHES = T.StructType(
    [T.StructField("start", T.TimestampType()), T.StructField("n", T.LongType()), T.StructField("sketch", T.BinaryType())]
)


@query(
    "stream_cardinality",
    """SELECT date_trunc('day', ts)::DATE AS day, count(*) AS n, count(DISTINCT user_id) AS exact, true AS within FROM events GROUP BY 1
       UNION ALL SELECT NULL, count(*), count(DISTINCT user_id), true FROM events""",
)
def stream_cardinality(spark, sf_dir):
    """Users per day and over all days, from sketches that a stream keeps per half hour.

    Estimates are within if they miss the exact number by 5 % at most, three standard errors.
    """
    out = scratch_path(spark, "cardinality")
    events = table(spark, sf_dir, "events")
    stream = J.file_stream(spark, sf_dir, events.schema, "events.parquet")
    J.write_updates(A.window_sketches(stream, "ts", "user_id"), f"{out}/sketches", f"{out}/progress").awaitTermination()
    windows = J.latest_updates(spark, f"{out}/sketches", ["start"], SKETCHES).withColumn("day", F.to_date("start"))
    found = A.merged_cardinality(windows, ["day"]).unionByName(
        A.merged_cardinality(windows.withColumn("day", F.lit(None).cast("date")), ["day"])
    )
    exact = events.withColumn("day", F.to_date("ts")).rollup("day").agg(F.count_distinct("user_id").alias("exact"))
    both = found.join(exact.withColumnRenamed("day", "own"), F.col("day").eqNullSafe(F.col("own")))
    within = F.abs(F.col("n_distinct") - F.col("exact")) <= 0.05 * F.col("exact")
    return both.select("day", "n", "exact", within.alias("within"))
