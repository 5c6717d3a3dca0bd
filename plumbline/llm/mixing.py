"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.llm.common import WORD, col, stored
from plumbline.operators.ranks import running_totals

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``.

    Sources in code point order, null last, take the weights in turn. Together the
    targets are ``share`` of all sizes; none is above ``epochs`` times its source's
    size, and what is above goes to the others by weight. That is the level at which
    a vessel of each source's weight as width and cap as height fills: sources in
    the order of cap by weight are full as long as the level beyond them is higher.
    One row per source passes through the windows, never the documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy(F.lit(1))
    turn = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(w) for w in weights])
    per = per.select(
        "source",
        "source_size",
        F.get(cycle, turn % len(weights)).alias("weight"),
        F.sum("source_size").over(everything).alias("total"),
    ).withColumn("full_at", F.lit(float(epochs)) * F.col("source_size") / F.col("weight"))
    by_level = everything.orderBy("full_at", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    budget = F.lit(share) * F.col("total")
    per = per.withColumn(
        "level",
        (budget - F.lit(epochs) * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        / F.sum("weight").over(rest),
    )
    per = per.withColumn("place", F.row_number().over(by_level))
    open_ones = F.when(F.col("full_at") > F.col("level"), F.struct("place", "level"))
    cap = F.lit(float(epochs)) * F.col("source_size")
    return per.withColumn("at", F.min(open_ones).over(everything)["level"]).select(
        "source",
        "source_size",
        F.when(F.col("at").isNull(), cap).otherwise(F.least(cap, F.col("weight") * F.col("at"))).alias("target"),
    )


def mix(
    sized: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: str = "mix"
) -> DataFrame:
    """The mixed stream of ``row_id, doc_id, source, size`` rows: one row per row and epoch.

    Each source serves its documents in an order shuffled by digest, again in
    another order for each further epoch. A document's virtual finish time is its
    source's words so far divided by the source's target; the stream is ordered by
    it over all sources and ends where the budget is spent. At virtual time 1 every
    source has given exactly its target, so the document then being served is cut
    there: at most one per source. Adds ``source_size, target, epoch, finish,
    position`` (words of the stream before it) and ``taken`` (words taken of it).
    Both running sums are over range partitions; no source is one task's work.
    Rows of no words, and rows past the end, have ``taken`` 0.
    """
    targets = source_targets(sized, weights, share, epochs)
    served = sized.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    served = served.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))).withColumn(
        "draw",
        F.md5(F.concat_ws(":", F.lit(seed), F.col("epoch").cast("string"), F.col("doc_id").cast("string"))),
    )
    queued = running_totals(served, ["epoch", "draw", "row_id"], ["size"], by=["source"])
    room = F.floor("target") - F.col("before_size")
    queued = queued.withColumn("given", F.greatest(F.lit(0), F.least(F.col("size"), room)).cast("bigint")).withColumn(
        "finish",
        F.when(F.col("target") > 0, (F.col("before_size") + F.col("size")) / F.col("target")).otherwise(F.lit(0.0)),
    )
    stream = running_totals(queued.drop("before_size"), ["finish", "draw", "row_id", "epoch"], ["given"])
    budget = sized.agg(F.coalesce(F.floor(F.lit(share) * F.sum("size")), F.lit(0)).alias("words"))
    left = budget.select("words").scalar() - F.col("before_given")
    return stream.select(
        "row_id",
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "epoch",
        "finish",
        F.col("before_given").alias("position"),
        F.greatest(F.lit(0), F.least(F.col("given"), left)).cast("bigint").alias("taken"),
    )


def sized_rows(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """``row_id, doc_id, source, size`` of every row, stored so that row ids hold still."""
    return stored(
        docs.select(
            F.monotonically_increasing_id().alias("row_id"),
            col(id_col).alias("doc_id"),
            col(source_col).alias("source"),
            word_count(col(text_col)).alias("size"),
        ),
        "mix-sizes",
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix of ``docs`` with its own columns: a row for each time a document is taken.

    The document in which a source's share ends keeps its first words only, and a
    column ``n_chars``, if there, then counts what is left. Documents without words
    have no place in a mix of words. Null texts have no words. Rows may share ids.
    """
    names = docs.columns
    row, copies = "__mix_row", "__mix_copies"
    kept = stored(docs.withColumn(row, F.monotonically_increasing_id()), "mix-documents")
    sized = kept.select(
        F.col(row).alias("row_id"),
        col("doc_id").alias("doc_id"),
        col("source").alias("source"),
        word_count(col("text")).alias("size"),
    )
    stream = mix(stored(sized, "mix-sizes"), **options).where("taken > 0")
    takes = stream.groupBy("row_id").agg(
        F.collect_list(F.struct("epoch", "taken", "size")).alias(copies)
    )
    out = kept.join(takes, F.col(row) == F.col("row_id")).withColumn("__mix_one", F.explode(copies))
    first_words = F.array_join(
        F.slice(
            F.regexp_extract_all(col("text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)),
            F.lit(1),
            F.col("__mix_one.taken").cast("int"),
        ),
        "",
    )
    cut = F.col("__mix_one.taken") < F.col("__mix_one.size")
    out = out.withColumn("__mix_text", F.when(cut, first_words).otherwise(col("text")))

    def value(name: str) -> Column:
        if name == "text":
            return F.col("__mix_text").alias(name)
        if name == "n_chars":
            return F.when(cut, F.length("__mix_text").cast("bigint")).otherwise(col(name)).alias(name)
        return col(name)

    return out.select(*[value(n) for n in names])
