"""A corpus pipeline: toxicity, line dedup, near-duplicates, mixing, packing.

Each stage gets the rows its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.llm import line_dedup, mixing, near_dedup, packing, toxicity
from plumbline.llm.common import col, scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go.

    A null text is scored as an empty one and stays as it is; rows that share an id are
    judged apart. Without labels, or with labels of one class, all get one score.
    """
    return toxicity.acceptable_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs go, and documents of which nothing else is left.

    Documents that had no words before stay, null texts among them.
    """
    out = line_dedup.deduplicated_lines(docs)
    emptied = (F.col("__lines_removed") > 0) & ~F.coalesce(col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return out.where(~emptied).select(*[col(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays.

    Rows without an id stay, as do documents without words. Rows that share an id are
    one document and go or stay together.
    """
    groups = near_dedup.near_groups(docs)
    dropped = groups.where(~F.col("kept")).select(F.col("doc_id").alias("__dropped")).distinct()
    return docs.join(dropped, col("doc_id") == F.col("__dropped"), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    A mix is measured in words, so documents without words, null texts among them, are
    never taken. A null source is a source of its own.
    """
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their ids and their places in sequences.

    An empty or null text is a piece of the end id alone; a null id is kept as null.
    """
    return packing.packed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# Models, suffix ranks and searches are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
