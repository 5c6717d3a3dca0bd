"""Cleaning of scraped listing text, as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Turkish month names as they appear in listing dates.
MONTHS = {
    "Ocak": "01",
    "Şubat": "02",
    "Mart": "03",
    "Nisan": "04",
    "Mayıs": "05",
    "Haziran": "06",
    "Temmuz": "07",
    "Ağustos": "08",
    "Eylül": "09",
    "Ekim": "10",
    "Kasım": "11",
    "Aralık": "12",
}
# Marker and code of an open-ended age, texts of absent values.
AND_OVER = "Üzeri"
AND_OVER_AGE = 21
UNKNOWN = "unknown"
MISSING_TEXT = "nan"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def price(text: Column) -> Column:
    """First number of a price text once thousands commas and ``TL`` are gone."""
    plain = F.replace(F.replace(text, F.lit(","), F.lit("")), F.lit("TL"), F.lit(""))
    return F.regexp_extract(plain, r"(\d+\.?\d*)", 1).try_cast("double")


def square_metres(text: Column) -> Column:
    """All digits of the text as one number; the decimal point is dropped too."""
    return _digits(text).try_cast("double")


def building_age(text: Column) -> Column:
    """21 for an open-ended age, else all digits as one number, else null."""
    return F.when(text.contains(AND_OVER), F.lit(AND_OVER_AGE).cast("bigint")).otherwise(
        _digits(text).try_cast("bigint")
    )


def rooms(text: Column) -> Column:
    """First number before the first ``+``."""
    head = F.substring_index(F.trim(F.lower(text)), "+", 1)
    return F.regexp_extract(head, r"(\d+(\.\d+)?)", 1).try_cast("double")


def listing_month(text: Column) -> Column:
    """``D MonthName YYYY`` to ``YYYY-MM``; an unknown month becomes ``00``."""
    parts = F.split(F.regexp_replace(text, r"^\s+|\s+$", ""), r"\s+")
    months = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])
    month = F.coalesce(F.try_element_at(months, F.get(parts, F.lit(1))), F.lit("00"))
    return F.when(F.size(parts) == 3, F.concat(F.get(parts, F.lit(2)), F.lit("-"), month)).otherwise(
        F.lit(UNKNOWN)
    )


def address(value: Column, data_type: T.DataType | None = None) -> Column:
    """Text as is, a list of parts joined by ``>``, null as ``unknown``."""
    if isinstance(data_type, T.ArrayType):
        value = F.array_join(value, " > ")
    return F.coalesce(value, F.lit(UNKNOWN))


def subscription(text: Column) -> Column:
    return F.coalesce(text, F.lit(UNKNOWN))


def as_text(value: Column) -> Column:
    """Text of any value; a missing value reads ``nan``."""
    return F.coalesce(value.cast("string"), F.lit(MISSING_TEXT))


def cross(left: Column, right: Column) -> Column:
    """``left_right``; a missing side contributes the text ``nan``."""
    return F.concat_ws("_", as_text(left), as_text(right))


def clean_listings(df: DataFrame) -> DataFrame:
    """All column cleaners in one projection; other columns pass through."""
    types = {f.name: f.dataType for f in df.schema}
    cleaned = {
        "GrossSquareMeters": square_metres(F.col("GrossSquareMeters")),
        "NetSquareMeters": square_metres(F.col("NetSquareMeters")),
        "BuildingAge": building_age(F.col("BuildingAge")),
        "NumberOfRooms": rooms(F.col("NumberOfRooms")),
        "AdCreationDate": listing_month(F.col("AdCreationDate")),
        "address": address(F.col("address"), types.get("address")),
        "Subscription": subscription(F.col("Subscription")),
    }
    return df.select([cleaned[c].alias(c) if c in cleaned else F.col(f"`{c}`") for c in df.columns])


def add_crosses(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "district_heating": cross(F.col("district"), F.col("HeatingType")),
            "district_floor": cross(F.col("district"), F.col("FloorLocation")),
        }
    )
