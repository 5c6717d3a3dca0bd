"""Streaming queries, run to the end of the available files and read back."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from plumbline.plans.catalogue.base import KL_TERM, PSI_TERM, query, table, tidy
from plumbline.plans.catalogue.learning import fitted_listings, request_texts
from plumbline.session import scratch_path
from plumbline.streaming import jobs as J

LATE = "1 hour"
COUNTS = T.StructType(
    [
        T.StructField("start", T.TimestampType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)


def _events(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return J.file_stream(spark, sf_dir, schema, "events.parquet")


def _counts(spark, sf_dir, period: str, keys: list[str]):
    out = scratch_path(spark, "stream")
    counts = J.windowed_counts(_events(spark, sf_dir), "ts", period, LATE, keys)
    J.write_updates(counts, f"{out}/counts", f"{out}/progress").awaitTermination()
    schema = T.StructType([f for f in COUNTS if f.name in ("start", "n", *keys)])
    return J.latest_updates(spark, f"{out}/counts", ["start", *keys], schema)


def _ntz(df, column="start"):
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


@query("stream_hourly", "SELECT date_trunc('hour', ts) AS start, count(*) AS n FROM events GROUP BY 1")
def stream_hourly(spark, sf_dir):
    return _ntz(_counts(spark, sf_dir, "1 hour", []))


@query(
    "stream_drift",
    f"""WITH ref AS (SELECT event_type AS v, count(*) / (SELECT count(*) FROM events WHERE event_type <> 'signup') AS e FROM events WHERE event_type <> 'signup' GROUP BY 1),
       c AS (SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS start, event_type AS v, count(*) AS n FROM events GROUP BY 1, 2),
       w AS (SELECT start, sum(n) AS total FROM c GROUP BY 1),
       vals AS (SELECT v FROM ref UNION SELECT v FROM c),
       s AS (SELECT w.start, w.total, coalesce(ref.e, 0) AS e, coalesce(c.n, 0) / w.total AS a
             FROM w CROSS JOIN vals LEFT JOIN ref ON ref.v = vals.v LEFT JOIN c ON c.start = w.start AND c.v = vals.v)
       SELECT start, any_value(total)::BIGINT AS n, round(greatest(0, sum({PSI_TERM})) / 20, 6) AS psi, round(greatest(0, sum({KL_TERM})) / 3, 6) AS kl
       FROM s GROUP BY start""",
)
def stream_drift(spark, sf_dir):
    """Drift of each half hour against all events but one type, so that type is new."""
    ref = J.reference_counts(table(spark, sf_dir, "events").where(F.col("event_type") != "signup"), "event_type")
    counts = _counts(spark, sf_dir, J.MONITOR_PERIOD, ["event_type"])
    return tidy(_ntz(J.window_drift(counts, ref, "event_type")))


@query(
    "stream_score",
    """SELECT o_orderkey::VARCHAR AS request_id, o_orderkey % 13 <> 0 AS valid, o_orderkey % 13 <> 0 AS has_class,
              CASE WHEN o_orderkey % 13 = 0 THEN 'GrossSquareMeters: not a number' END AS reasons
       FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def stream_score(spark, sf_dir):
    """Requests streamed from files through check, transforms, model and the two tables.

    The first batch is written a second time, which must not count again.
    """
    transforms, model, _ = fitted_listings(spark, sf_dir)
    out = scratch_path(spark, "scoring")
    requests = request_texts(spark, sf_dir)
    requests.write.parquet(f"{out}/requests")
    sink = J.ScoreSink(transforms, model, f"{out}/log", body="body")
    sink.start(J.file_stream(spark, f"{out}/requests", requests.schema), f"{out}/progress").awaitTermination()
    sink.write(spark.read.parquet(f"{out}/requests"), 0)
    known = F.col("price_category").isNotNull() & F.col("prediction").between(0, 2)
    scored = sink.read(spark, "scored").select("request_id", F.lit(True).alias("valid"), known.alias("has_class"), F.lit(None).cast("string").alias("reasons"))
    rejected = sink.read(spark, "rejected").select("request_id", F.lit(False), F.lit(False), F.array_join("reasons", "; "))
    return scored.union(rejected)
