"""Shards of equal bytes by a k-d tree over metadata, with distributed weighted medians.

All of it is built-in functions: no Python runs in the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.common import col, stored
from plumbline.operators.ranks import dense_codes, running_totals
from plumbline.session import broadcast_checked

DIMENSIONS = ("lang", "source", "size")
# A dimension's coordinate is a number of so many bits, and a hash parts equal ones.
COORD_BITS = 20
HASH_BITS = 43
# Bits of a median found in one count, and the counters of one count over all cells of a level.
DIGIT_BITS = 16
COUNTERS = 1 << 20


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """``doc_id, size, text_crc32, hash, m0, m1, …``: no text, metadata as it is.

    ``size`` as a dimension is the bytes of the row, not a column of that name.
    """
    text = F.coalesce(col(text_col), F.lit(""))
    size = F.octet_length(text).cast("bigint") + 1
    name = F.concat_ws(":", col(id_col).cast("string"), text)
    return docs.select(
        col(id_col).alias("doc_id"),
        size.alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.conv(F.substring(F.md5(name), 1, 11), 16, 10).cast("bigint").bitwiseAND(F.lit((1 << HASH_BITS) - 1)).alias("hash"),
        *[(size if d == "size" else col(d)).alias(f"m{i}") for i, d in enumerate(dimensions)],
    )


def placed(rows: DataFrame, count: int) -> DataFrame:
    """``m0, …`` of ``sized`` rows as ``d0, …``: coordinates from 0 to ``2^COORD_BITS - 1``.

    Texts go by the order of their distinct values, numbers by their logarithm above
    the least; null comes first in either. Each dimension is stretched over the
    whole range, which makes widths comparable.
    """
    most = (1 << COORD_BITS) - 1
    for i in range(count):
        name = f"m{i}"
        if rows.schema[name].dataType.typeName() == "string":
            codes = dense_codes(rows, name).select(F.col("value").alias(name), (F.col("code") + 1).alias(f"c{i}"))
            codes = stored(codes, "shard-codes")
            highest = codes.select(F.max(f"c{i}")).scalar()
            rows = rows.join(broadcast_checked(codes), name, "left").withColumn(f"c{i}", F.coalesce(f"c{i}", F.lit(0)))
            place = F.when(F.col(f"c{i}") > 0, (F.col(f"c{i}") / highest * most)).otherwise(0)
        else:
            low, high = (rows.select(f(F.col(name).cast("double"))).scalar() for f in (F.min, F.max))
            wide = F.log2(high - low + 1)
            value = F.log2(F.col(name).cast("double") - low + 1)
            place = F.when((wide > 0) & F.col(name).isNotNull(), value / wide * most).otherwise(0)
        rows = rows.withColumn(f"d{i}", F.floor(place).cast("bigint")).drop(name, f"c{i}")
    return rows


def key_of(count: int) -> Column:
    """Coordinate along the cell's dimension, then the hash, in one number."""
    along = F.coalesce(*[F.when(F.col("dim") == i, F.col(f"d{i}")) for i in range(count)])
    return F.shiftleft(along, HASH_BITS).bitwiseOR(F.col("hash"))


def cuts(rows: DataFrame, count: int, most_cells: int) -> DataFrame:
    """``shard, dim, left, cut`` of the cells with two or more leaves to come.

    A cell is cut along its widest dimension at the weighted median, or at
    another share if its leaves are odd: keys below ``cut`` go left. The key at that
    weight is found bit by bit from the top: each count sums the bytes by the next
    bits of the keys that begin as the median does. Counters stay the same however
    many rows there are, and no row is moved. The median's own key goes where its
    larger part belongs.
    """
    wide = [(F.max(f"d{i}") - F.min(f"d{i}")).alias(f"w{i}") for i in range(count)]
    cells = rows.where("leaves > 1").groupBy("shard", "leaves").agg(F.sum("size").alias("bytes"), *wide)
    widest = F.greatest(*[F.col(f"w{i}") for i in range(count)]) if count > 1 else F.col("w0")
    dim = F.coalesce(*[F.when(F.col(f"w{i}") == widest, F.lit(i)) for i in range(count)])
    left = F.floor(F.col("leaves") / 2).cast("int")
    state = cells.select(
        "shard",
        dim.alias("dim"),
        left.alias("left"),
        (F.col("bytes") * left / F.col("leaves")).alias("want"),
        F.lit(0).cast("bigint").alias("prefix"),
    )
    step = max(2, min(DIGIT_BITS, (COUNTERS // most_cells).bit_length() - 1))
    below = COORD_BITS + HASH_BITS
    while below > 0:
        bits = min(step, below)
        below -= bits
        state = stored(state, "shard-cells")
        # At most one row for each cell, and cells are fewer than shards.
        met = rows.where("leaves > 1").join(F.broadcast(state), "shard").withColumn("key", key_of(count))
        met = met.where(F.shiftright("key", below + bits) == F.col("prefix"))
        digit = F.shiftright("key", below).bitwiseAND(F.lit((1 << bits) - 1))
        sums = met.groupBy("shard", "dim", "left", "want", "prefix", digit.alias("digit")).agg(F.sum("size").alias("bytes"))
        keys = ["shard", "dim", "left", "want", "prefix"]
        # A row for each digit, in order, with the bytes before it: as many as there are counters.
        listed = sums.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("digit", "bytes"))).alias("found"))
        start = F.struct(F.lit(None).cast("bigint").alias("digit"), F.lit(0).cast("bigint").alias("before"), F.lit(0).cast("bigint").alias("bytes"))

        def onward(at: Column, x: Column) -> Column:
            reached = at["before"] + at["bytes"]
            move = at["digit"].isNull() | (reached < F.col("want"))
            return F.when(move, F.struct(x["digit"].alias("digit"), reached.alias("before"), x["bytes"].alias("bytes"))).otherwise(at)

        hit = listed.select(*keys, F.aggregate("found", start, onward).alias("hit"))
        state = hit.select(
            "shard",
            "dim",
            "left",
            (F.col("want") - F.col("hit.before")).alias("want"),
            F.shiftleft("prefix", bits).bitwiseOR(F.col("hit.digit")).alias("prefix"),
            F.col("hit.bytes").alias("bytes"),
        )
        if below:
            state = state.drop("bytes")
    most = F.when(2 * F.col("want") >= F.col("bytes"), 1).otherwise(0)
    return stored(state.select("shard", "dim", "left", (F.col("prefix") + most).alias("cut")), "shard-cuts")


def kd_shards(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    dimensions: tuple[str, ...] = DIMENSIONS,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    A row's size is its text's bytes in UTF-8 and one. The tree has ``shards``
    leaves, or so many that each has about ``target_bytes``: a cell is split at the
    weighted median of its widest metadata dimension (of equals, the first named)
    until each part is one leaf. Rows that are equal along it, such as those of one hot
    source, are parted by a hash of id and text, so shards differ by little more than a
    row. ``slot`` numbers a shard's rows from 0, in the order of that hash.

    Null texts are empty, null metadata comes first, a null id is a value like any
    other. Rows equal in id and text go to one shard. With fewer rows than shards some
    shards stay empty. An empty table gives an empty result; only the named columns
    are read.
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give either shards or target_bytes")
    count = len(dimensions)
    rows = stored(placed(stored(sized(docs, id_col, text_col, dimensions), "shard-sizes"), count), "shard-places")
    if shards is None:
        total = rows.agg(F.sum("size").alias("n")).first()["n"] or 0
        shards = max(1, -(-total // target_bytes))
    rows = rows.withColumns({"shard": F.lit(0), "leaves": F.lit(shards)})
    cells = 1
    while cells < shards:
        cut = cuts(rows, count, cells)
        met = rows.join(F.broadcast(cut), "shard", "left")
        right = F.coalesce(key_of(count) >= F.col("cut"), F.lit(False))
        leaves = F.when(F.col("left").isNull(), F.col("leaves")).when(right, F.col("leaves") - F.col("left"))
        rows = met.withColumns(
            {"leaves": leaves.otherwise(F.col("left")), "shard": F.col("shard") + F.when(right, F.col("left")).otherwise(0)}
        ).drop("dim", "left", "cut")
        rows = stored(rows, "shard-rows")
        cells *= 2
    rows = rows.select("doc_id", "size", "text_crc32", "hash", "shard", F.monotonically_increasing_id().alias("row"))
    rows = stored(rows, "shard-leaves").withColumn("one", F.lit(1).cast("bigint"))
    numbered = running_totals(rows, ["hash", "row"], ["one"], by=["shard"])
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("before_one").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
