"""Targets, encodings, splits, and the fitted transforms that need state."""

from __future__ import annotations

from math import isnan, sqrt

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param.shared import HasInputCols, HasOutputCol, HasOutputCols, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.functions.cleaning import as_text
from plumbline.operators.metrics import class_weights
from plumbline.operators.profile import categorical_profile, moments, numeric_long
from plumbline.operators.ranks import dense_codes, drop_nan, exact_quantiles, melt, order_statistics, running_totals
from plumbline.schemas import HIGH_CARD_FEATURES, LOW_CARD_FEATURES, NUMERIC_FEATURES
from plumbline.session import BROADCAST_ROWS, broadcast_checked, cut_lineage, one_row

# Class boundaries, split, seed and hash width.
TARGET_QUANTILES = (0.0, 0.4, 0.8, 1.0)
TEST_SHARE = 0.2
SEED = 42
HASH_SLOTS = 2**14


# --- targets ---------------------------------------------------------------


def class_code_of(x: Column, edges: list[Column], strict: bool = True) -> Column:
    """Number of the right-closed interval between the edges; null for null.

    Equal edges raise in strict mode, else they collapse into one.
    """
    code = F.lit(0)
    distinct = F.lit(True)
    for low, high in zip(edges, edges[1:]):
        distinct = distinct & (high > low)
    for low, edge in zip(edges, edges[1:-1]):
        code = code + ((x > edge) & (edge > low)).cast("int")
    if strict:
        code = F.when(distinct, code).otherwise(F.raise_error(F.lit("quantile edges must be unique")).cast("int"))
    return F.when(x.isNotNull(), code)


def _number(column: str) -> Column:
    return drop_nan(F.col(f"`{column}`").cast("double"))


def quantile_target(
    df: DataFrame,
    column: str,
    output: str,
    quantiles: tuple = TARGET_QUANTILES,
    strict: bool = True,
) -> DataFrame:
    """Adds the class code of the quantile interval, lowest value included."""
    edges = one_row(exact_quantiles(numeric_long(df, [column]), "value", list(quantiles)).drop("n"))
    ends = [F.col(f"_edges.q{i}") for i in range(len(quantiles))]
    return (
        df.withColumn("_edges", edges)
        .withColumn(output, class_code_of(_number(column), ends, strict))
        .drop("_edges")
    )


def fit_quantile_edges(df: DataFrame, column: str, quantiles: tuple = TARGET_QUANTILES) -> list[float]:
    """The edges as numbers, for a target that several jobs will use."""
    row = exact_quantiles(numeric_long(df, [column]), "value", list(quantiles)).drop("n").first()
    return [] if row is None or row[0] is None else list(row)


def assign_classes(df: DataFrame, column: str, output: str, edges: list[float], strict: bool = True) -> DataFrame:
    """Adds the class code for fitted edges."""
    if not edges:
        return df.withColumn(output, F.lit(None).cast("int"))
    return df.withColumn(output, class_code_of(_number(column), [F.lit(e) for e in edges], strict))


# --- splits ----------------------------------------------------------------


def split_key(key: Column, seed: int = SEED) -> Column:
    """A reproducible 60-bit number per row key."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"))), 1, 15), 16, 10).cast(
        "bigint"
    )


def plain_split(df: DataFrame, key: str, test_share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Adds ``is_test`` by a hash threshold; no shuffle."""
    return df.withColumn("is_test", split_key(F.col(key), seed) < F.lit(int(test_share * 16**15)))


def stratified_split(
    df: DataFrame, key: str, label: str, test_share: float = TEST_SHARE, seed: int = SEED
) -> DataFrame:
    """Adds ``is_test``: in each class the round(share * n) smallest hashes.

    The threshold of each class is an exact order statistic, so the rows
    themselves are not shuffled or sorted. ``key`` identifies a row.
    """
    hashed = df.withColumn("_hash", split_key(F.col(key), seed))

    def last(n: Column) -> Column:
        return F.greatest(F.round(n * F.lit(test_share)).cast("bigint") - 1, F.lit(0))

    cut = order_statistics(hashed, "_hash", [(last, last)], by=[label], bounded=False)
    # A class of one or two rows may have no test row at all.
    cut = broadcast_checked(
        cut.where(F.round(F.col("n") * F.lit(test_share)) > 0).select(
            F.col(label).alias("_class"), F.col("low").alias("_cut")
        )
    )
    return (
        hashed.join(cut, F.col(label).eqNullSafe(F.col("_class")), "left")
        .withColumn("is_test", F.coalesce(F.col("_hash") <= F.col("_cut"), F.lit(False)))
        .drop("_hash", "_class", "_cut")
    )


# --- encodings -------------------------------------------------------------


def label_encode(df: DataFrame, column: str, output: str) -> DataFrame:
    """Adds the position of the value among the sorted distinct values."""
    codes = broadcast_checked(dense_codes(df, column).select(F.col("value").alias("_value"), F.col("code").alias(output)))
    return df.join(codes, F.col(f"`{column}`") == F.col("_value"), "left").drop("_value")


def text_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """``feature, value, code``: places of the sorted distinct values of all columns, found together."""
    values = melt(df, columns, "string").where("value is not null").distinct()
    run = running_totals(values.withColumn("one", F.lit(1).cast("bigint")), ["value"], ["one"], by=["feature"])
    return cut_lineage(run.select("feature", "value", F.col("before_one").alias("code")), "text-codes")


def label_encode_all(df: DataFrame) -> DataFrame:
    """Replaces every text column by its codes.

    All columns are coded in one pass over the rows, whatever their number.
    """
    columns = [name for name, kind in df.dtypes if kind == "string"]
    if not columns:
        return df
    codes = text_codes(df, columns)
    known = codes.limit(BROADCAST_ROWS + 1).collect()
    small = len(known) <= BROADCAST_ROWS
    if small:
        codes = df.sparkSession.createDataFrame(known, codes.schema)
    out = df
    for i, name in enumerate(columns):
        own = codes.where(F.col("feature") == name).select(F.col("value").alias(f"_value{i}"), F.col("code").alias(f"_code{i}"))
        out = out.join(F.broadcast(own) if small else own, F.col(f"`{name}`") == F.col(f"_value{i}"), "left")
    return out.select([F.col(f"_code{columns.index(c)}").alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns])


def add_class_weights(df: DataFrame, label: str, power: int = 1, output: str = "weight") -> DataFrame:
    """Adds the balanced class weight, raised to ``power``.

    A class weight given twice to a learner acts squared: ``power=2``.
    """
    weights = class_weights(df, label).select(
        F.col(label).alias("_class"), F.pow(F.col("weight"), F.lit(power)).alias(output)
    )
    return df.join(broadcast_checked(weights), F.col(label) == F.col("_class"), "left").drop("_class")


# --- hashing ---------------------------------------------------------------


def hash_slot(token: Column, slots: int = HASH_SLOTS) -> Column:
    return F.pmod(F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint"), F.lit(slots)).cast("int")


def hash_sign(token: Column) -> Column:
    odd = F.conv(F.substring(F.md5(token), 9, 1), 16, 10).cast("int") % 2
    return F.when(odd == 1, F.lit(-1.0)).otherwise(F.lit(1.0))


def hashed_slots(tokens: list[Column], slots: int = HASH_SLOTS) -> tuple[Column, Column]:
    """Sorted slot numbers and signed sums of bare tokens, as two arrays.

    Equal text in two columns hits the same slot; slots that cancel stay with 0.
    """
    pairs = F.array(
        *[F.struct(hash_slot(as_text(t), slots).alias("slot"), hash_sign(as_text(t)).alias("sign")) for t in tokens]
    )
    index = F.sort_array(F.array_distinct(F.transform(pairs, lambda p: p["slot"])))
    values = F.transform(
        index,
        lambda i: F.aggregate(
            F.filter(pairs, lambda p: p["slot"] == i), F.lit(0.0), lambda acc, p: acc + p["sign"]
        ),
    )
    return index, values


def _sparse(size: int):
    """Sums each row's signs per slot into a sparse vector, a batch at a time."""

    @F.arrow_udf(VectorUDT())
    def build(slots: pa.Array, signs: pa.Array) -> pa.Array:
        rows = len(slots)
        columns = len(slots.flatten()) // max(rows, 1)
        slot, sign = (x.flatten().to_numpy().reshape(rows, columns) for x in (slots, signs))
        order = slot.argsort(axis=1, kind="stable")
        slot, sign = np.take_along_axis(slot, order, 1), np.take_along_axis(sign, order, 1)
        first = np.ones(slot.shape, dtype=bool)
        first[:, 1:] = slot[:, 1:] != slot[:, :-1]
        sums = np.bincount(first.ravel().cumsum() - 1, weights=sign.ravel())
        ends = pa.array(np.concatenate([[0], first.sum(axis=1).cumsum()]), pa.int32())
        return pa.StructArray.from_arrays(
            [
                pa.array(np.zeros(rows), pa.int8()),
                pa.array(np.full(rows, size), pa.int32()),
                pa.ListArray.from_arrays(ends, pa.array(slot[first], pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(sums, pa.float64())),
            ],
            names=["type", "size", "indices", "values"],
        )

    return build


class TextHasher(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Signed feature hashing of text columns into one sparse vector."""

    numFeatures = Param(Params._dummy(), "numFeatures", "width of the vector", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None, numFeatures=HASH_SLOTS):
        super().__init__()
        self._setDefault(numFeatures=HASH_SLOTS)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        slots = self.getOrDefault(self.numFeatures)
        tokens = [as_text(F.col(f"`{c}`")) for c in self.getInputCols()]
        vector = _sparse(slots)(
            F.array(*[hash_slot(t, slots) for t in tokens]), F.array(*[hash_sign(t) for t in tokens])
        )
        # The declared width spares the assembler a look at the data.
        width = {"ml_attr": {"num_attrs": slots}}
        return df.select("*", vector.alias(self.getOutputCol(), metadata=width))


# --- fitted numeric and text preparation ------------------------------------


class _Columns(HasInputCols, HasOutputCols):
    """Shared column parameters."""


class NumericScaler(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Exact-median imputation, then standardisation by mean and population std."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "NumericScalerModel":
        columns = self.getInputCols()
        long = numeric_long(df, columns)
        m = moments(long, ["feature"])
        medians = exact_quantiles(long, "value", [0.5], by=["feature"], bounded=True).select("feature", "q0")
        rows = m.join(F.broadcast(medians), "feature").select("feature", "n", "n_rows", "mean", "std", "q0").collect()
        found = {r["feature"]: _filled_moments(r["n"], r["n_rows"], r["mean"], r["std"], r["q0"]) for r in rows}
        empty = (0.0, 0.0, 1.0)
        medians, means, scales = zip(*[found.get(c, empty) for c in columns])
        return NumericScalerModel(
            inputCols=columns,
            outputCols=self.getOutputCols(),
            medians=list(medians),
            means=list(means),
            scales=list(scales),
        )


def _filled_moments(n: int, rows: int, mean: float, std: float | None, median: float) -> tuple:
    """Median, then mean and population std of a column whose gaps hold the median.

    A constant column, up to rounding of its mean, is divided by 1.
    """
    gaps = rows - n
    centre = mean + gaps * (median - mean) / rows
    within = 0.0 if std is None or isnan(std) else std * std * (n - 1)
    spread = within + n * (mean - centre) ** 2 + gaps * (median - centre) ** 2
    scale = sqrt(spread / rows)
    return median, centre, scale if scale > 1e-14 * abs(centre) else 1.0


class NumericScalerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    medians = Param(Params._dummy(), "medians", "fill values", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "centres", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "divisors", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, medians=None, means=None, scales=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        fitted = zip(
            self.getInputCols(),
            self.getOutputCols(),
            self.getOrDefault(self.medians),
            self.getOrDefault(self.means),
            self.getOrDefault(self.scales),
        )
        return df.withColumns(
            {
                out: (F.coalesce(drop_nan(F.col(f"`{c}`").cast("double")), F.lit(median)) - F.lit(mean)) / F.lit(scale)
                for c, out, median, mean, scale in fitted
            }
        )


class ModeFiller(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Fills missing text by the most frequent value; a tie goes to the smallest."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ModeFillerModel":
        rows = categorical_profile(df, self.getInputCols()).select("feature", "most_frequent").collect()
        found = dict(tuple(r) for r in rows)
        return ModeFillerModel(
            inputCols=self.getInputCols(),
            outputCols=self.getOutputCols(),
            fills=[found.get(c, "") for c in self.getInputCols()],
        )


class ModeFillerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    fills = Param(Params._dummy(), "fills", "fill values", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, fills=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        fitted = zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.fills))
        return df.withColumns({out: F.coalesce(F.col(f"`{c}`"), F.lit(fill)) for c, out, fill in fitted})


def one_hot_stages(columns: list[str], suffix: str = "_onehot") -> list:
    """Sorted categories, one slot each; a value not seen in fitting is all zeros."""
    index = [f"{c}_index" for c in columns]
    return [
        StringIndexer(inputCols=columns, outputCols=index, stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=index, outputCols=[f"{c}{suffix}" for c in columns], dropLast=True),
    ]


def feature_pipeline(
    numeric: list[str] = NUMERIC_FEATURES,
    low_card: list[str] = LOW_CARD_FEATURES,
    high_card: list[str] = HIGH_CARD_FEATURES,
    slots: int = HASH_SLOTS,
    output: str = "features",
) -> Pipeline:
    """Numeric block, one-hot block and hashed block, assembled side by side."""
    scaled = [f"{c}_scaled" for c in numeric]
    filled = [f"{c}_filled" for c in low_card]
    stages: list = []
    blocks: list[str] = []
    if numeric:
        stages.append(NumericScaler(inputCols=numeric, outputCols=scaled))
        blocks += scaled
    if low_card:
        stages.append(ModeFiller(inputCols=low_card, outputCols=filled))
        stages += one_hot_stages(filled)
        blocks += [f"{c}_onehot" for c in filled]
    if high_card:
        stages.append(TextHasher(inputCols=high_card, outputCol="hashed", numFeatures=slots))
        blocks.append("hashed")
    stages.append(VectorAssembler(inputCols=blocks, outputCol=output))
    return Pipeline(stages=stages)
