"""Drift over a log that grows: counts kept up to date by a stream, and measured after each batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from plumbline.functions.terms import CARDINALITY_SCALE
from plumbline.operators.drift import cardinality_of_counts, kl_of_counts, psi_of_counts
from plumbline.operators.monitor import METRICS, MonitorConfig
from plumbline.operators.ranks import melt
from plumbline.session import cut_lineage
from plumbline.streaming.jobs import MONITOR_PERIOD

COUNTS = "feature string, value string, n bigint"
# Batches after which their counts become one table.
EVERY = 16
HLL_BITS = 12


def value_counts_of(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``feature, value, n``; ``columns`` names the column of each feature. Null is a value."""
    named = df.select(*[F.col(f"`{c}`").cast("string").alias(name) for name, c in columns.items()])
    return melt(named, list(columns), "string").groupBy("feature", "value").agg(F.count("*").alias("n"))


@dataclass(frozen=True)
class CountLog:
    """Counts of all rows that a stream has brought, as tables by batch.

    A batch writes its own counts under its id and nothing else, so a batch that is
    repeated replaces them. Every ``every`` batches the counts so far become one table,
    from the table before and the batches since. The counts up to a batch are therefore a
    function of batches with lower ids alone, however often any of them is written.
    """

    folder: str
    every: int = EVERY

    def add(self, counts: DataFrame, batch_id: int) -> None:
        counts.write.mode("overwrite").parquet(f"{self.folder}/delta/batch_id={batch_id}")
        if (batch_id + 1) % self.every == 0:
            whole = self._since(counts.sparkSession, batch_id - self.every, batch_id)
            whole.write.mode("overwrite").parquet(f"{self.folder}/whole/upto={batch_id}")

    def upto(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """``feature, value, n`` of all batches up to this one."""
        return self._since(spark, (batch_id + 1) // self.every * self.every - 1, batch_id)

    def _since(self, spark: SparkSession, table: int, batch_id: int) -> DataFrame:
        deltas = [f"{self.folder}/delta/batch_id={i}" for i in range(max(table, -1) + 1, batch_id + 1)]
        tables = [f"{self.folder}/whole/upto={table}"] if table >= 0 else []
        rows = spark.read.schema(COUNTS).parquet(*tables, *deltas)
        return rows.groupBy("feature", "value").agg(F.sum("n").alias("n"))


def drift_of_counts(ref: DataFrame, counts: DataFrame, cfg: MonitorConfig = MonitorConfig()) -> DataFrame:
    """Three rows ``metric, value, threshold, alert`` as ``monitor.drift_metrics``, from counts of both sides.

    Features are ``category``, ``entity`` (of high cardinality) and ``class``.
    """
    zero = F.lit(0).cast("bigint")
    both = ref.select("feature", "value", F.col("n").alias("n_ref"), zero.alias("n_prod"))
    both = both.union(counts.select("feature", "value", zero, "n"))
    both = both.groupBy("feature", "value").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_prod").alias("n_prod"))
    of = {name: both.where(F.col("feature") == name).drop("feature") for name in ("category", "entity", "class")}
    values = (
        psi_of_counts(of["category"], cfg.psi_scale).toDF("value"),
        cardinality_of_counts(of["entity"]).select(F.col("cardinality_ratio").alias("value")),
        kl_of_counts(of["class"]).toDF("value"),
    )
    limits = (cfg.psi_threshold, cfg.cardinality_threshold, cfg.kl_threshold)
    rows = [v.select(F.lit(m).alias("metric"), "value", F.lit(t).alias("threshold")) for m, v, t in zip(METRICS, values, limits)]
    return rows[0].union(rows[1]).union(rows[2]).withColumn("alert", F.col("value") > F.col("threshold"))


class DriftLog:
    """Drift of everything a stream has brought against a reference, written after each batch."""

    def __init__(self, ref: DataFrame, ref_columns: dict[str, str], columns: dict[str, str], path: str, cfg: MonitorConfig = MonitorConfig(), every: int = EVERY):
        self.ref = cut_lineage(value_counts_of(ref, ref_columns), "reference-counts")
        self.columns, self.path, self.cfg = columns, path, cfg
        self.counts = CountLog(f"{path}/counts", every)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch; writing it again changes nothing."""
        self.counts.add(value_counts_of(batch, self.columns), batch_id)
        measured = drift_of_counts(self.ref, self.counts.upto(batch.sparkSession, batch_id), self.cfg)
        measured.write.mode("overwrite").parquet(f"{self.path}/metrics/batch_id={batch_id}")

    def start(self, stream: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        return (
            stream.writeStream.option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .foreachBatch(self.write)
            .start()
        )

    def metrics(self, spark: SparkSession) -> DataFrame:
        """``metric, value, threshold, alert, batch_id``."""
        schema = "metric string, value double, threshold double, alert boolean, batch_id bigint"
        return spark.read.schema(schema).parquet(f"{self.path}/metrics")


def window_sketches(stream: DataFrame, ts: str, column: str, period: str = MONITOR_PERIOD, late: str = "1 hour") -> DataFrame:
    """``start, n, sketch``: rows and a mergeable sketch of the distinct values per window."""
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    out = timed.groupBy(F.window("_ts", period).alias("w")).agg(
        F.count("*").alias("n"), F.hll_sketch_agg(F.col(column).cast("string"), F.lit(HLL_BITS)).alias("sketch")
    )
    return out.select(F.col("w.start").alias("start"), "n", "sketch")


def merged_cardinality(sketches: DataFrame, by: list[str]) -> DataFrame:
    """``by…, n, n_distinct`` of windows put together, without their rows."""
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.hll_union_agg("sketch").alias("s"))
    return merged.select(*by, "n", F.hll_sketch_estimate("s").alias("n_distinct"))


def cardinality_against(cardinality: DataFrame, ref: DataFrame, column: str) -> DataFrame:
    """Adds ``cardinality_ratio`` against the reference's distinct values, from a sketch as well."""
    sketch = ref.agg(F.hll_sketch_agg(F.col(column).cast("string"), F.lit(HLL_BITS)).alias("s"))
    known = F.coalesce(sketch.select(F.hll_sketch_estimate("s")).scalar(), F.lit(0))
    ratio = F.col("n_distinct") / F.greatest(known, F.lit(1)) / F.lit(CARDINALITY_SCALE)
    return cardinality.withColumn("cardinality_ratio", ratio)
