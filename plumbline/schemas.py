"""Declared schemas of the tables the engine reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the listing tables.
NUMERIC_FEATURES = ["GrossSquareMeters", "NetSquareMeters", "BuildingAge", "NumberOfRooms"]
LOW_CARD_FEATURES = ["district", "HeatingType", "StructureType", "FloorLocation"]
HIGH_CARD_FEATURES = ["address", "AdCreationDate", "Subscription", "district_heating", "district_floor"]
ALL_FEATURES = NUMERIC_FEATURES + LOW_CARD_FEATURES + HIGH_CARD_FEATURES

INDEX_COLUMN = "Unnamed: 0"
TARGET = "price_category"
NOT_FEATURES = ("target", "price_category", "timestamp")

# Raw scraped fields stay text so that cleaning sees what was scraped.
RAW_LISTING = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in [
            INDEX_COLUMN,
            "GrossSquareMeters",
            "NetSquareMeters",
            "BuildingAge",
            "NumberOfRooms",
            "district",
            "HeatingType",
            "StructureType",
            "FloorLocation",
            "address",
            "AdCreationDate",
            "Subscription",
            "price",
        ]
    ]
)

REQUEST_NUMBERS = NUMERIC_FEATURES
REQUEST_TEXTS = LOW_CARD_FEATURES + ["address", "AdCreationDate", "Subscription"]
REQUEST = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in REQUEST_NUMBERS]
    + [T.StructField(c, T.StringType()) for c in REQUEST_TEXTS]
)

REFERENCE_SNAPSHOT = T.StructType(
    [
        T.StructField("district", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("HeatingType", T.StringType()),
        T.StructField("FloorLocation", T.StringType()),
        T.StructField(TARGET, T.IntegerType()),
    ]
)

INPUT_LOG = T.StructType(
    REQUEST.fields
    + [T.StructField("request_id", T.StringType()), T.StructField("timestamp", T.TimestampType())]
)
PREDICTION_LOG = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("prediction", T.IntegerType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

RUN_METRICS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("experiment", T.StringType()),
        T.StructField("run_name", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("kind", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("num_value", T.DoubleType()),
        T.StructField("str_value", T.StringType()),
    ]
)


def is_numeric(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.NumericType)


def numeric_columns(schema: T.StructType, skip: tuple[str, ...] = NOT_FEATURES) -> list[str]:
    return [f.name for f in schema if f.name not in skip and is_numeric(f.dataType)]


def category_columns(schema: T.StructType, skip: tuple[str, ...] = NOT_FEATURES) -> list[str]:
    return [f.name for f in schema if f.name not in skip and not is_numeric(f.dataType)]
