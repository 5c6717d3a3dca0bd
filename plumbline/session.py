"""Session helpers shared by the operators."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BROADCAST_ROWS = 10_000


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("plumbline")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="plumbline-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folder()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique path below the shared folder."""
    return f"{shared_folder(spark)}/plumbline/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Unlike a local checkpoint the result survives the loss of executors, and
    columns computed from the partition layout become plain stored values.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_row(df: DataFrame) -> Column:
    """The only row of an ungrouped aggregate, as a struct usable in any plan.

    An uncorrelated scalar subquery: evaluated once, no join, and Spark raises
    if the frame has more than one row.
    """
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")).scalar()


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` when it has at most ``max_rows`` rows, else return it as is.

    At most ``max_rows + 1`` rows reach the driver; beyond the bound the caller's
    join stays an ordinary shuffled join.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
