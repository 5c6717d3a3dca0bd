"""Append-only logs of scored inputs and predictions, by day, and their compaction."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from plumbline.sources.tables import read_or_empty

MANIFEST = T.StructType(
    [
        T.StructField("folder", T.StringType()),
        T.StructField("replaces", T.ArrayType(T.StringType())),
    ]
)


def append_log(df: DataFrame, path: str, stamp: str = "timestamp") -> None:
    """Append rows with the time of writing, below the day of it; earlier files are never rewritten."""
    if stamp not in df.columns:
        df = df.withColumn(stamp, F.current_timestamp())
    df.withColumn("day", F.to_date(stamp)).write.mode("append").partitionBy("day").parquet(path)


def _appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    kept = T.StructType([*[f for f in schema if f.name != "day"], T.StructField("day", T.DateType())])
    return read_or_empty(spark, path, kept)


def _manifest(spark: SparkSession, path: str) -> list:
    # Folders that begin with an underscore are no part of the log for Spark's reader.
    return read_or_empty(spark, f"{path}/_manifest", MANIFEST).collect()


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows ever appended; columns a row was written without read as null.

    The declared schema is used as it is, so no footer is read to plan. Files that a
    compaction has replaced are left out, and its own are read instead.
    """
    rows = _appended(spark, path, schema)
    entries = _manifest(spark, path)
    if entries:
        gone = {name for e in entries for name in e["replaces"]}
        live = [f for f in rows.inputFiles() if f not in gone]
        folders = [e["folder"] for e in entries if e["folder"] not in gone]
        plain = spark.read.schema(rows.schema)
        parts = [plain.parquet(f"{path}/_compact/{name}") for name in folders]
        if live:
            parts.append(plain.option("basePath", path).parquet(*live))
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
    return rows.select(schema.names)


def compact_log(spark: SparkSession, path: str, schema: T.StructType, files: int = 1) -> bool:
    """Put all files that have been appended so far together, ``files`` a day; whether there were any.

    The new files are written first; one row of the manifest then puts them in the
    place of those they were made from. What is appended meanwhile is none of these and
    stays. Reading before, during and after gives the same rows.
    """
    rows = _appended(spark, path, schema)
    done = {name for e in _manifest(spark, path) for name in e["replaces"]}
    live = [f for f in rows.inputFiles() if f not in done]
    if not live:
        return False
    folder = uuid.uuid4().hex
    old = spark.read.schema(rows.schema).option("basePath", path).parquet(*live)
    spread = old.repartition("day") if files == 1 else old.repartition("day", F.pmod(F.monotonically_increasing_id(), F.lit(files)))
    spread.write.partitionBy("day").parquet(f"{path}/_compact/{folder}")
    entry = spark.createDataFrame([(folder, live)], MANIFEST)
    entry.coalesce(1).write.mode("append").parquet(f"{path}/_manifest")
    return True


def append_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name; columns missing on a side are null there."""
    return old.unionByName(new, allowMissingColumns=True)
