"""Exact order statistics and running totals without a one-task sort.

Two building blocks:

``order_statistics`` finds each wanted rank by counting rows by cells: first by parts
of octaves, then by equal parts between the least and the greatest value of the cells
that hold a rank, and by value where a cell has few rows, until each rank has one value:
two or three counts as a rule, five at most, for all groups and ranks together. Tables
of counts are all that is shuffled, and how values are distributed does not matter.

``running_totals`` sorts by range partitions, stores the partition number, and
adds the totals of the earlier partitions, so a global cumulative sum is spread
over all tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.session import broadcast_checked, cut_lineage

# Cells of an octave in the first count, and parts of a cell that a later count tells apart.
STEPS = 16
CELLS = 2**16


def melt(df: DataFrame, columns: list[str], data_type: str, keep: list[str] | None = None) -> DataFrame:
    """One row per (row, column): ``feature, value`` next to the kept columns."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast(data_type).alias("value"))
            for c in columns
        ]
    )
    return df.select(*(keep or []), F.inline(pairs))


def drop_nan(value: Column) -> Column:
    """NaN to null, the one missing marker used here."""
    return F.nanvl(value, F.lit(None).cast("double"))


def _match(left: str, right: str, keys: list[str]) -> list[Column]:
    return [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]


def double_key(x: Column) -> Column:
    """A bigint that orders doubles as their values do, distinct for distinct ones.

    It is the exponent followed by the mantissa, negated for negative values. The
    scale is a power of two, so all steps are exact; the logarithm may miss the
    exponent by one, which the mantissa shows. NaN has none.
    """
    size = F.abs(x)
    least, most = -1022, 1023
    guess = F.greatest(F.least(F.floor(F.log2(size)), F.lit(most)), F.lit(least)).cast("int")
    scaled = size / F.pow(F.lit(2.0), guess)
    power = guess + F.when(scaled >= 2, 1).when((scaled < 1) & (guess > least), -1).otherwise(0)
    # Below the least exponent the mantissa is below 1, and stands alone.
    mantissa = (size / F.pow(F.lit(2.0), power) * 2.0**52).cast("bigint")
    key = (power - least).cast("bigint") * (1 << 52) + mantissa
    key = F.when(size == 0, 0).when(size == float("inf"), (most - least + 2) << 52).otherwise(key)
    return F.when(F.isnan(x), None).when(x < 0, -key).otherwise(key)


def octave_cell(x: Column) -> Column:
    """A number that never falls where doubles rise: their sign and a ``STEPS``-th of an octave."""
    place = F.floor(F.log2(F.abs(x)) * STEPS)
    # The least double is 2^-1074, and infinity, here the greatest bigint, is put beyond all others.
    place = F.least(place, F.lit(1025 * STEPS)) + 1075 * STEPS
    return F.when(x == 0, 0.0).otherwise(F.signum(x) * place)


def _small(df: DataFrame, bounded: bool) -> tuple[DataFrame, bool]:
    """A table that the next count reads, and that is not computed again, and if all its cells have one value."""
    if bounded:
        rows = df.collect()
        return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)), not any(r["lo"] < r["hi"] for r in rows)
    df = cut_lineage(df, "order-statistics")
    return broadcast_checked(df), df.where("lo < hi").isEmpty()


def order_statistics(
    df: DataFrame, value: str, ranks: list, by: list[str] | None = None, bounded: bool = True
) -> DataFrame:
    """Exact values at given ranks per group: ``by…, target, n, low, high``.

    ``ranks`` lists pairs of functions from the row count to a 0-based rank; the
    values at both are ``low`` and ``high``. Values are numbers, missing ones are
    skipped. With ``bounded`` the groups are known to be few (columns of a schema);
    otherwise tables with a row for each group are fetched only after a size check.
    """
    by = by or []
    keys = [f"g{i}" for i in range(len(by))]
    base = df.select(*[F.col(f"`{b}`").alias(k) for b, k in zip(by, keys)], F.col(f"`{value}`").alias("v"))
    base = base.where(F.col("v").isNotNull())
    if base.schema["v"].dataType.typeName() in ("float", "double"):
        base = base.where(~F.isnan("v"))
    base = base.withColumn("cell", octave_cell(F.col("v").cast("double")))
    wanted = F.array(
        *[
            F.struct(F.lit(i).alias("target"), F.lit(side).alias("side"), rank(F.col("n")).cast("bigint").alias("rank"))
            for i, pair in enumerate(ranks)
            for side, rank in enumerate(pair)
        ]
    )
    ends = [F.count("*").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi")]

    def placed(counts: DataFrame, group: list[str], order: list[str]) -> DataFrame:
        # No more rows to a group than one count tells apart.
        earlier = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumn("before", F.coalesce(F.sum("c").over(earlier), F.lit(0)))

    def holding(found: DataFrame) -> tuple[DataFrame, bool]:
        found = found.where(F.expr("rank >= before and rank < before + c"))
        left = (F.col("rank") - F.col("before")).alias("rank")
        return _small(found.select(*keys, "n", "target", "side", left, "cell", "c", "lo", "hi"), bounded)

    counts = placed(base.groupBy(*keys, "cell").agg(*ends), keys, ["cell"])
    counts = counts.withColumn("n", F.sum("c").over(Window.partitionBy(*keys)))
    found, done = holding(counts.select(*keys, "n", "cell", "c", "lo", "hi", "before", F.inline(wanted)))
    out = found.where("lo = hi")
    while not done:
        state = found.where("lo < hi")
        group = [*keys, "cell", "lo", "hi"]
        heads = state.select(*group, F.col("c").alias("rows")).distinct()
        heads = F.broadcast(heads) if bounded else heads
        same = _match("b", "t", [*keys, "cell"]) + [F.col("b.v").between(F.col("t.lo"), F.col("t.hi"))]
        rows = base.alias("b").join(heads.alias("t"), reduce(Column.__and__, same))
        # Ends differ and have one sign, so that the first and the last part are different ones.
        part = (F.col("v") - F.col("t.lo")).cast("double") / (F.col("t.hi") - F.col("t.lo")).cast("double")
        rows = rows.select(
            *[F.col(f"t.{g}").alias(f"in_{g}") for g in group],
            "v",
            F.floor(part * CELLS).alias("part"),
            F.when(F.col("rows") <= CELLS, F.col("v")).alias("exact"),
        )
        within = [F.col(f"b.in_{g}").eqNullSafe(F.col(f"t.{g}")) for g in group]
        group = [f"in_{g}" for g in group]
        counts = placed(rows.groupBy(*group, "part", "exact").agg(*ends), group, ["part", "exact"])
        found = counts.alias("b").join(state.alias("t"), reduce(Column.__and__, within)).select(
            *[f"t.{x}" for x in [*keys, "n", "target", "side", "rank", "cell"]], *[f"b.{x}" for x in ["c", "lo", "hi", "before"]]
        )
        found, done = holding(found)
        out = out.unionByName(found.where("lo = hi"))

    def at(side: int) -> Column:
        return F.max(F.when(F.col("side") == side, F.col("lo")))

    out = out.groupBy(*keys, "target", "n").agg(at(0).alias("low"), at(1).alias("high"))
    return out.select(*[F.col(k).alias(b) for k, b in zip(keys, by)], "target", "n", "low", "high")


def exact_quantiles(
    df: DataFrame, value: str, probs: list[float], by: list[str] | None = None, bounded: bool | None = None
) -> DataFrame:
    """Linearly interpolated quantiles, one row per group: ``by…, n, q0, q1, …``.

    Missing values are skipped; a group without values has no row. Without
    ``by`` the result always has one row, with nulls on empty input.
    ``bounded`` as in ``order_statistics``; keys are held to be data unless said
    otherwise.
    """
    by = by or []
    bounded = not by if bounded is None else bounded

    def target(p: float):
        return lambda n: F.floor((n - 1) * F.lit(float(p))), lambda n: F.ceil((n - 1) * F.lit(float(p)))

    values = order_statistics(df, value, [target(p) for p in probs], by, bounded)

    def pick(column: str, i: int) -> Column:
        return F.max(F.when(F.col("target") == i, F.col(column).cast("double")))

    wide = values.groupBy(*by).agg(
        F.max("n").alias("n"), *[pick(c, i).alias(f"{c}{i}") for i in range(len(probs)) for c in ("low", "high")]
    )
    out = []
    for i, p in enumerate(probs):
        position = (F.col("n") - 1) * F.lit(float(p))
        weight = position - F.floor(position)
        between = F.col(f"low{i}") + (F.col(f"high{i}") - F.col(f"low{i}")) * weight
        # Equal neighbours may be infinite.
        out.append(F.when(F.col(f"low{i}") == F.col(f"high{i}"), F.col(f"low{i}")).otherwise(between).alias(f"q{i}"))
    return wide.select(*by, "n", *out)


def running_totals(
    df: DataFrame, order: list[str], sums: list[str], by: list[str] | None = None, tasks: int | None = None
) -> DataFrame:
    """Adds ``before_<c>``: the sum of ``c`` over the earlier rows of the group.

    The rows must be distinct on ``by + order`` (aggregate first), so that no
    key can be hot. Rows are range partitioned on ``by + order`` and stored with
    their partition number; totals of earlier partitions come from a table of
    one row per group and partition. ``tasks`` fixes the number of partitions,
    which otherwise follows the session and the size of the data.
    """
    by = by or []
    keys = [*by, *order]
    ranged = df.repartitionByRange(*keys) if tasks is None else df.repartitionByRange(tasks, *keys)
    part = cut_lineage(ranged.withColumn("part", F.spark_partition_id()), "running-totals")
    totals = part.groupBy(*by, "part").agg(*[F.sum(c).alias(f"total_{c}") for c in sums])
    earlier = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "part", *[F.coalesce(F.sum(f"total_{c}").over(earlier), F.lit(0)).alias(f"offset_{c}") for c in sums]
    )
    inside = Window.partitionBy("part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = part.select(
        "*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"local_{c}") for c in sums]
    )
    joined = local.alias("l").join(
        offsets.alias("o"),
        reduce(Column.__and__, _match("l", "o", ["part", *by])),
    )
    return joined.select(
        *[f"l.{c}" for c in df.columns],
        *[(F.col(f"l.local_{c}") + F.col(f"o.offset_{c}")).alias(f"before_{c}") for c in sums],
    )


def ks_statistics(tagged: DataFrame) -> DataFrame:
    """Two-sample KS statistic per feature from ``side, feature, value`` rows."""
    clean = tagged.where(F.col("value").isNotNull())
    counts = clean.groupBy("feature", "value").agg(
        F.count_if(F.col("side") == "ref").alias("n_ref"),
        F.count_if(F.col("side") == "prod").alias("n_prod"),
    )
    run = running_totals(counts, ["value"], ["n_ref", "n_prod"], by=["feature"])
    run = run.select(
        "feature",
        (F.col("before_n_ref") + F.col("n_ref")).alias("c_ref"),
        (F.col("before_n_prod") + F.col("n_prod")).alias("c_prod"),
    )
    # The last running count of a feature is its total.
    sizes = run.groupBy("feature").agg(F.max("c_ref").alias("ref_n"), F.max("c_prod").alias("prod_n"))
    sizes = sizes.where("ref_n > 0 and prod_n > 0")
    gap = F.abs(F.col("c_ref") / F.col("ref_n") - F.col("c_prod") / F.col("prod_n"))
    return (
        run.join(F.broadcast(sizes), "feature")
        .groupBy("feature", "ref_n", "prod_n")
        .agg(F.max(gap).alias("ks_statistic"))
    )


def class_auc(scored: DataFrame) -> DataFrame:
    """One-vs-rest ROC AUC per class from ``class, score, is_positive`` rows.

    Rank-sum form with average ranks for ties. A class without positives or
    without negatives has no row.
    """
    counts = scored.groupBy("class", "score").agg(
        F.count_if("is_positive").alias("pos"), F.count_if(~F.col("is_positive")).alias("neg")
    )
    run = running_totals(counts, ["score"], ["neg"], by=["class"])
    return (
        run.groupBy("class")
        .agg(
            F.sum(F.col("pos") * (F.col("before_neg") + F.col("neg") / 2.0)).alias("wins"),
            F.sum("pos").alias("positives"),
            F.sum("neg").alias("negatives"),
        )
        .where("positives > 0 and negatives > 0")
        .select(
            "class",
            "positives",
            "negatives",
            (F.col("wins") / (F.col("positives").cast("double") * F.col("negatives"))).alias("auc"),
        )
    )


def dense_codes(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values in sorted order with codes 0, 1, 2, …"""
    values = df.select(F.col(f"`{column}`").alias("value")).where("value is not null").distinct()
    run = running_totals(values.withColumn("one", F.lit(1).cast("bigint")), ["value"], ["one"])
    return run.select("value", F.col("before_one").alias("code"))
