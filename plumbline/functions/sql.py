"""The cleaners as SQL functions, with SQL bodies so that they stay in the JVM."""

from __future__ import annotations

from pyspark.sql import SparkSession

from plumbline.functions.cleaning import AND_OVER, AND_OVER_AGE, MISSING_TEXT, MONTHS, UNKNOWN


def _bodies() -> dict[str, tuple[str, str, str]]:
    months = ", ".join(f"'{k}', '{v}'" for k, v in MONTHS.items())
    trimmed = r"split(regexp_replace(x, r'^\s+|\s+$', ''), r'\s+')"
    return {
        "clean_price": (
            "x STRING",
            "DOUBLE",
            r"try_cast(regexp_extract(replace(replace(x, ',', ''), 'TL', ''), r'(\d+\.?\d*)', 1) AS DOUBLE)",
        ),
        "clean_square_metres": (
            "x STRING",
            "DOUBLE",
            "try_cast(regexp_replace(x, '[^0-9]', '') AS DOUBLE)",
        ),
        "clean_building_age": (
            "x STRING",
            "BIGINT",
            f"CASE WHEN contains(x, '{AND_OVER}') THEN {AND_OVER_AGE}"
            " ELSE try_cast(regexp_replace(x, '[^0-9]', '') AS BIGINT) END",
        ),
        "clean_rooms": (
            "x STRING",
            "DOUBLE",
            r"try_cast(regexp_extract(substring_index(trim(lower(x)), '+', 1), r'(\d+(\.\d+)?)', 1) AS DOUBLE)",
        ),
        "clean_listing_month": (
            "x STRING",
            "STRING",
            f"CASE WHEN size({trimmed}) = 3 THEN concat(get({trimmed}, 2), '-',"
            f" coalesce(try_element_at(map({months}), get({trimmed}, 1)), '00'))"
            f" ELSE '{UNKNOWN}' END",
        ),
        "clean_address": ("x STRING", "STRING", f"coalesce(x, '{UNKNOWN}')"),
        "feature_cross": (
            "a STRING, b STRING",
            "STRING",
            f"concat_ws('_', coalesce(a, '{MISSING_TEXT}'), coalesce(b, '{MISSING_TEXT}'))",
        ),
    }


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the temporary functions in this session and return their names."""
    for name, (params, returns, body) in _bodies().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}")
    return list(_bodies())
