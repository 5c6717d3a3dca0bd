"""Typed intake of scoring requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.schemas import REQUEST_NUMBERS, REQUEST_TEXTS


def check_requests(
    df: DataFrame,
    numbers: list[str] = REQUEST_NUMBERS,
    texts: list[str] = REQUEST_TEXTS,
    body: str | None = None,
) -> DataFrame:
    """Adds the typed fields and ``reasons``, one entry per bad field.

    With ``body`` the fields come from a JSON text column, else from the
    columns of the same name. A field is bad when missing or not of its type.
    """
    fields = [*numbers, *texts]
    if body is not None:
        parsed = F.from_json(F.col(body), ", ".join(f"`{f}` STRING" for f in fields), {"mode": "PERMISSIVE"})
        df = df.withColumn("_body", parsed)
        raw = {f: F.col("_body")[f] for f in fields}
    else:
        raw = {f: F.col(f"`{f}`") if f in df.columns else F.lit(None).cast("string") for f in fields}

    def reason(name: str, typed: Column) -> Column:
        return F.when(raw[name].isNull(), F.lit(f"{name}: missing")).when(
            typed.isNull() | (F.isnan(typed) if name in numbers else F.lit(False)), F.lit(f"{name}: not a number")
        )

    typed = {f: raw[f].try_cast("double") if f in numbers else raw[f].cast("string") for f in fields}
    reasons = F.filter(F.array(*[reason(f, typed[f]) for f in fields]), lambda r: r.isNotNull())
    kept = [F.col(f"`{c}`") for c in df.columns if c not in fields and c != "_body"]
    # One generated row per request: the fields are parsed once, and a filter on
    # them is not rewritten into copies of the parsing expressions.
    parsed = F.struct(*[typed[f].alias(f) for f in fields], reasons.alias("reasons"))
    return df.select(*kept, F.inline(F.array(parsed)))


def valid_requests(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reasons") == 0).drop("reasons")


def rejected_requests(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reasons") > 0)
