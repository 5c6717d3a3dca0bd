"""Exact duplicates by sorting contents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.llm.common import stored, texts_of

# Leading characters in the range key. They only place rows; equality is of whole texts.
HEAD = 32


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    keep: str = "smallest",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Rows are range-partitioned by Spark's sampled splitters over (leading
    characters, content hash, salt of the id), sorted with the whole text as last
    key, and equal neighbours form a run. The salt has as many values as there are
    shuffle partitions, so a group with a third of all rows spreads over a third of
    them; its runs are joined by the digest of the whole text, one row per run, and its
    rows find their run by digest and salt.
    Whole texts are shuffled once.

    Null texts equal empty ones. A row with a null id counts in its group but stays
    only if the group has no other id. Of rows that share the id which stays, one is
    kept. An empty table gives an empty result; extra columns are not read.
    """
    spark = docs.sparkSession
    pick = {"smallest": F.min, "largest": F.max}[keep]
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = texts_of(docs, id_col, text_col)
    if normalise is not None:
        rows = rows.withColumn("text", normalise(F.col("text")))
    placed = rows.select(
        "doc_id",
        "text",
        F.substring("text", 1, HEAD).alias("head"),
        F.xxhash64("text").alias("hash"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"),
    ).repartitionByRange("head", "hash", "salt")
    run = Window.partitionBy("head", "hash", "salt", "text")
    first = F.col("doc_id").asc_nulls_last() if keep == "smallest" else F.col("doc_id").desc_nulls_last()
    runs = placed.select(
        "doc_id",
        "salt",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        F.row_number().over(run.orderBy(first)).alias("place"),
        F.count("*").over(run).alias("run_size"),
    )
    runs = stored(runs, "exact-runs")
    groups = (
        runs.where("place = 1")
        .groupBy("digest")
        .agg(pick("doc_id").alias("keep_id"), F.sum("run_size").alias("group_size"))
        .where("group_size > 1")
    )
    # One row for each run of a group, so that its rows are joined by digest and salt and stay spread.
    heads = runs.where("place = 1").select("digest", "salt").join(groups, "digest")
    joined = runs.join(heads, ["digest", "salt"], "left")
    keep_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (keep_id.eqNullSafe(F.col("doc_id")) & (F.col("place") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
