"""Class labels, status texts and display formats."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Class codes and their names.
CLASS_NAMES = {0: "low", 1: "medium", 2: "high"}


def _lookup(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def class_name(code: Column, names: dict[int, str] = CLASS_NAMES) -> Column:
    """Name of a class code; an unknown code reads as its own text."""
    code = code.cast("int")
    return F.coalesce(F.try_element_at(_lookup(names), code), code.cast("string"))


def class_code(name: Column, names: dict[int, str] = CLASS_NAMES, unknown: int | None = -1) -> Column:
    """Code of a class name; an unknown name gives ``unknown`` (null to keep it missing)."""
    found = F.try_element_at(_lookup({v: k for k, v in names.items()}), name)
    return found if unknown is None else F.coalesce(found, F.lit(unknown))


def status_text(flag: Column, yes: str = "⚠️ Yes", no: str = "✅ No") -> Column:
    return F.when(flag, F.lit(yes)).when(~flag, F.lit(no))


def fixed_format(value: Column, digits: int = 4) -> Column:
    """Fixed decimals, ``N/A`` when missing."""
    return F.when(value.isNotNull(), F.format_string(f"%.{digits}f", value)).otherwise("N/A")


def pretty_name(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def minute_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")
