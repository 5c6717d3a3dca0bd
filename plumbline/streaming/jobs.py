"""Streaming counts, drift per window, and scoring.

Every job keeps its progress in a checkpoint folder; outputs are files, so a
restarted job continues and no result passes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from plumbline.functions import terms
from plumbline.functions.terms import share
from plumbline.plans.scoring import score
from plumbline.session import cut_lineage, one_row
from plumbline.sources.requests import check_requests, rejected_requests, valid_requests
from plumbline.sources.tables import try_read

# Fixed value: length of a monitoring period.
MONITOR_PERIOD = "30 minutes"


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str | None = None) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(folder)


def windowed_counts(
    stream: DataFrame, ts: str, period: str, late: str = "1 hour", keys: list[str] | None = None
) -> DataFrame:
    """``start, keys…, n`` per tumbling window; works on batches as well."""
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp"))
    counts = timed.withWatermark("_ts", late).groupBy(F.window("_ts", period).alias("w"), *(keys or []))
    return counts.agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *(keys or []), "n")


def write_updates(
    result: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, mode: str = "update",
    then: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Write each micro-batch to its own folder below ``path``.

    Rewriting a repeated batch replaces the same folder, so results count once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/batch_id={batch_id}"
        if then is None:
            batch.write.mode("overwrite").parquet(target)
            return
        # ``then`` may read the batch several times; compute it once.
        batch.persist()
        then(batch).write.mode("overwrite").parquet(target)
        batch.unpersist()

    return (
        result.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(write)
        .start()
    )


def latest_updates(spark: SparkSession, path: str, keys: list[str], schema: T.StructType) -> DataFrame:
    """The newest version of each key among the written batches."""
    rest = [f.name for f in schema if f.name not in keys]
    batches = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])).parquet(path)
    newest = batches.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_v"))
    return newest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in rest])


def reference_counts(ref: DataFrame, column: str) -> DataFrame:
    """``value, n_ref`` of the static reference."""
    return ref.select(F.col(column).cast("string").alias("value")).groupBy("value").agg(F.count("*").alias("n_ref"))


def window_drift(
    counts: DataFrame,
    ref_counts: DataFrame,
    column: str,
    psi_scale: float = terms.CATEGORICAL_SCALE,
    kl_scale: float = terms.KL_SCALE,
) -> DataFrame:
    """``start, n, psi, kl`` per window against the reference.

    Both are 0 against an empty reference. A reference value absent from a window still contributes to its PSI. Those
    terms are summed once over the whole reference, and each window corrects
    the total for the values it does have, so windows are never multiplied by
    values.
    """
    ref_total = one_row(ref_counts.agg(F.sum("n_ref").alias("n")))["n"]
    zero = F.lit(0.0)
    shares = ref_counts.select("value", share(F.col("n_ref"), ref_total).alias("e"))
    absent = one_row(shares.agg(F.sum(terms.psi_term(F.col("e"), zero)).alias("t")))["t"]
    c, r = counts.alias("c"), shares.alias("r")
    total = counts.groupBy("start").agg(F.sum("n").alias("n_window")).alias("t")
    joined = (
        c.join(total, F.col("c.start") == F.col("t.start"))
        .join(r, F.col(f"c.{column}").cast("string").eqNullSafe(F.col("r.value")), "left")
        .select(
            F.col("c.start").alias("start"),
            "t.n_window",
            F.coalesce("r.e", zero).alias("e"),
            share(F.col("c.n"), F.col("t.n_window")).alias("a"),
        )
    )
    e, a = F.col("e"), F.col("a")
    sums = joined.groupBy("start", F.col("n_window").alias("n")).agg(
        F.sum(terms.psi_term(e, a) - terms.psi_term(e, zero)).alias("psi"), F.sum(terms.kl_term(e, a)).alias("kl")
    )

    def scaled(value: Column, scale: float) -> Column:
        return F.when(ref_total > 0, F.greatest(zero, value)).otherwise(zero) / F.lit(scale)

    return sums.select(
        "start", "n", scaled(F.col("psi") + absent, psi_scale).alias("psi"), scaled(F.col("kl"), kl_scale).alias("kl")
    )


def drift_stream(
    stream: DataFrame, ref_counts: DataFrame, ts: str, column: str, path: str, checkpoint: str,
    late: str = "1 hour", trigger: dict | None = None,
) -> StreamingQuery:
    """Drift of every window once it has closed; all of a window's counts arrive together.

    The reference counts are computed once and stored, not once per micro-batch.
    """
    ref_counts = cut_lineage(ref_counts, "reference-counts")
    counts = windowed_counts(stream, ts, MONITOR_PERIOD, late, [column])
    return write_updates(
        counts, path, checkpoint, trigger, mode="append", then=lambda batch: window_drift(batch, ref_counts, column)
    )


def window_cardinality(stream: DataFrame, ts: str, column: str, late: str = "1 hour", rsd: float = 0.02) -> DataFrame:
    """``start, n_distinct`` by a mergeable sketch; exact distinct does not merge."""
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    out = timed.groupBy(F.window("_ts", MONITOR_PERIOD).alias("w")).agg(
        F.approx_count_distinct(column, rsd).alias("n_distinct")
    )
    return out.select(F.col("w.start").alias("start"), "n_distinct")


class ScoreSink:
    """Scored and rejected requests of each micro-batch, in two tables that agree.

    A batch is read and checked once, then written as scored and as rejected rows under
    its id, then marked as done. Readers take done batches only, so neither table has a
    batch without the other; a batch that is repeated after its mark changes nothing.
    """

    def __init__(self, transforms: PipelineModel, model: Transformer, path: str, body: str | None = None):
        self.transforms, self.model, self.path, self.body = transforms, model, path, body

    def write(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if try_read(spark, f"{self.path}/done/batch_id={batch_id}") is not None:
            return
        checked = cut_lineage(check_requests(batch, body=self.body), "checked-requests")
        stamp = F.current_timestamp().alias("timestamp")
        scored = score(valid_requests(checked), self.transforms, self.model).select("*", stamp)
        rejected = rejected_requests(checked).select("*", stamp)
        for name, rows in (("scored", scored), ("rejected", rejected)):
            rows.write.mode("overwrite").parquet(f"{self.path}/{name}/batch_id={batch_id}")
        counts = checked.agg(F.count("*").alias("requests"))
        counts.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/done/batch_id={batch_id}")

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """``scored`` or ``rejected`` rows of the batches that are done."""
        done = spark.read.parquet(f"{self.path}/done").select("batch_id").distinct()
        return spark.read.parquet(f"{self.path}/{name}").join(F.broadcast(done), "batch_id", "left_semi")

    def start(self, stream: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        return (
            stream.writeStream.option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .foreachBatch(self.write)
            .start()
        )
