"""Scans and snapshots of tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plumbline.schemas import INDEX_COLUMN, RAW_LISTING


# Texts that stand for a missing field.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_listings(
    spark: SparkSession, path: str, schema: T.StructType = RAW_LISTING, multiline: bool = False
) -> DataFrame:
    """CSV with header, in the fields of ``schema`` and found by name; the scraped row index is left out.

    A field that the header lacks is null, as is every text of ``MISSING_TEXTS``;
    columns that the schema lacks are not read. Quotes inside a quoted field are
    doubled. ``multiline`` allows line breaks there, at the price that a file is
    no longer split. All files of a path share one header.
    """
    raw = spark.read.options(header=True, escape='"', multiLine=multiline).csv(path)

    def field(f: T.StructField) -> Column:
        if f.name not in raw.columns:
            return F.lit(None).cast(f.dataType).alias(f.name)
        c = F.col(f"`{f.name}`")
        return F.when(~c.isin(MISSING_TEXTS), c).try_cast(f.dataType).alias(f.name)

    return raw.select(*[field(f) for f in schema if f.name != INDEX_COLUMN])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def try_read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table at ``path``, or None if there is none or it has no files yet."""
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path`` in the declared schema, empty if it is missing.

    Columns that a file lacks are null; no file is opened to find out.
    """
    found = try_read(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def with_timestamp(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Text or date column read as a timestamp; absent column is fine."""
    return df.withColumn(column, F.col(column).try_cast("timestamp")) if column in df.columns else df


def write_snapshot(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Reference snapshot; all columns unless a subset is asked for."""
    (df.select(columns) if columns else df).write.mode("overwrite").parquet(path)


def source_status(spark: SparkSession, sources: dict[str, str]) -> DataFrame:
    """``source, status, rows`` for each named path; rows is null where it is missing."""
    out = None
    for name, path in sources.items():
        found = try_read(spark, path)
        if found is None:
            rows = spark.range(1).select(F.lit(None).cast("bigint").alias("rows"))
        else:
            rows = found.agg(F.count("*").alias("rows"))
        line = rows.select(
            F.lit(name).alias("source"),
            F.lit("❌ Missing" if found is None else "✅ Available").alias("status"),
            "rows",
        )
        out = line if out is None else out.unionAll(line)
    return out


def table_size(df: DataFrame) -> DataFrame:
    """One row: row count and column count."""
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def fill_missing(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Null and NaN replaced by a default."""

    def filled(name: str, default) -> Column:
        c = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            c = F.nanvl(c, F.lit(None).cast("double"))
        return F.coalesce(c, F.lit(default))

    return df.withColumns({k: filled(k, v) for k, v in defaults.items()})
