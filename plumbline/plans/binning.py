"""Values of features on which trees choose their splits."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from plumbline.session import cut_lineage

# Quantile bins of a feature, wide gaps that bound bins too, parts of its range in which they are sought.
BINS = 32
GAPS = 16
CELLS = 1024
# A quantile bin may be cut at 0, a bin keeps its least and greatest value, and 0 is a value of its own.
MAX_BINS = 2 * (BINS + GAPS + 1) + 1


def feature_bins(train: DataFrame) -> DataFrame:
    """``feature, bins``: least and greatest value of each bin of ``features``, in order.

    Bins end at quantiles, at 0 and in the widest gaps. A gap wider than a cell has
    another cell, or none, on either side and cannot be missed. Values are those of a
    vector that are finite and not 0, so sparse ones stay sparse. Features with at
    most ``MAX_BINS - 1`` values, each a cell of its own, are left out.
    """
    v = F.unwrap_udt("features")
    at = F.coalesce(v["indices"], F.transform(v["values"], lambda _, i: i))
    rows = train.select(F.inline(F.arrays_zip(at.alias("feature"), v["values"].alias("value"))))
    rows = rows.where((F.col("value") != 0) & (F.abs("value") < float("inf")))
    shares = [i / BINS for i in range(1, BINS)]
    shape = rows.groupBy("feature").agg(
        F.min("value").alias("least"), F.max("value").alias("most"), F.percentile_approx("value", shares, 10 * BINS).alias("cuts")
    )
    place = F.try_divide(F.col("value") - F.col("least"), F.col("most") - F.col("least"))
    cells = (
        rows.join(F.broadcast(shape), "feature")
        .withColumn("part", F.struct(F.col("value") > 0, F.size(F.filter("cuts", lambda c: c < F.col("value")))))
        .groupBy("feature", "part", F.floor(F.coalesce(place, F.lit(0.0)) * CELLS).alias("cell"))
        .agg(F.min("value").alias("low"), F.max("value").alias("high"))
    )
    # At most a few thousand cells of a feature, however many rows.
    one = Window.partitionBy("feature")
    up = one.orderBy("low")
    cells = cells.withColumn("gap", F.col("low") - F.lag("high").over(up)).withColumn("changed", F.col("part") != F.lag("part").over(up))
    cells = cells.withColumn("wide", F.row_number().over(one.orderBy(F.desc_nulls_last("gap"), "low")) <= GAPS)
    cells = cells.withColumn("bin", F.count_if(F.col("changed") | (F.col("wide") & F.col("gap").isNotNull())).over(up))
    bins = cells.groupBy("feature", "bin").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.count("*").alias("n"), F.bool_or(F.col("low") < F.col("high")).alias("merged")
    )
    return (
        bins.groupBy("feature")
        .agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("bins"), F.sum("n").alias("n"), F.bool_or("merged").alias("merged"))
        .where(F.col("merged") | (F.col("n") >= MAX_BINS))
        .select("feature", "bins")
    )


def binned_features(train: DataFrame) -> DataFrame:
    """``train`` with each feature's value replaced by the nearer end of its bin, stored once.

    Spark's trees split a feature between two of its values if these are no more than
    ``maxBins``, and at quantiles else, which pass a gap by. Of the values here there are
    at most ``MAX_BINS``. Each midpoint of two parts the rows as it parts the ends, so
    a tree that has learnt from the ends applies to the rows as they are.
    """
    ends = {}
    for r in feature_bins(train).collect():
        values = np.unique([x for b in r["bins"] for x in b])
        ends[r["feature"]] = values, values[:-1] / 2 + values[1:] / 2

    def nearest(batches):
        for batch in batches:
            v = batch.column("features")
            size = pc.fill_null(pc.list_value_length(v.field("values")), 0).to_numpy()
            flat = v.field("values").flatten().to_numpy(zero_copy_only=False).copy()
            first = np.concatenate([[0], np.cumsum(size)])
            feature = np.arange(first[-1]) - np.repeat(first[:-1], size)
            named = v.field("indices").is_valid().to_numpy(zero_copy_only=False)
            feature[np.repeat(named, size)] = v.field("indices").flatten().to_numpy()
            order = np.argsort(feature, kind="stable")
            names, begin = np.unique(feature[order], return_index=True)
            for f, at in zip(names.tolist(), np.split(order, begin[1:])):
                if f in ends:
                    values, middles = ends[f]
                    at = at[(flat[at] != 0) & np.isfinite(flat[at])]
                    flat[at] = values[np.searchsorted(middles, flat[at])]
            made = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(flat))
            parts = [made if f.name == "values" else v.field(f.name) for f in v.type]
            made = pa.StructArray.from_arrays(parts, names=[f.name for f in v.type])
            yield pa.RecordBatch.from_arrays([made if c == "features" else batch.column(c) for c in batch.schema.names], batch.schema.names)

    if not ends:
        return train
    return cut_lineage(train.mapInArrow(nearest, train.schema), "binned-features")
