"""Registration, and the table bindings the queries share.

The supplied tables carry no missing values and no drift, so both are worked in
from the keys, the same way in the plan and in its SQL twin. Every query reads
whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plumbline.functions.cleaning import MONTHS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

CUT = "1998-04-25"
EVENT_CUT = "2024-01-16"


def query(name: str, sql: str | None = None):
    """Register a query and, if it can be stated, its SQL twin."""

    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the last bits of two engines do not matter."""
    return df.select(
        [
            (F.round(F.col(f"`{f.name}`").cast("double"), digits).alias(f.name))
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def day(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def price_class(price: Column) -> Column:
    return F.when(price <= 200000, 0).when(price <= 400000, 1).when(price > 400000, 2)


def price_class_sql(price: str) -> str:
    return f"CASE WHEN {price} <= 200000 THEN 0 WHEN {price} <= 400000 THEN 1 WHEN {price} > 400000 THEN 2 END"


# --- the two halves of orders ------------------------------------------------


def ref_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(F.col("o_orderdate") < day(CUT)).select(
        "o_orderkey",
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_custkey").cast("string").alias("address"),
        F.col("o_totalprice").alias("price"),
        price_class(F.col("o_totalprice")).alias("price_category"),
    )


def prod_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later half with new values, a shifted price and missing values."""
    key = F.col("o_orderkey")
    priority = (
        F.when(key % 29 == 0, F.lit(None).cast("string"))
        .when(key % 10 == 0, F.lit("9-NEW"))
        .when((key % 10).isin(1, 2, 3), F.lit("1-URGENT"))
        .otherwise(F.col("o_orderpriority"))
    )
    return table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= day(CUT)).select(
        "o_orderkey",
        priority.alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.concat_ws("-", F.col("o_custkey").cast("string"), (key % 7).cast("string")).alias("address"),
        F.when(key % 23 != 0, F.col("o_totalprice") * 1.15).alias("price"),
        price_class(F.col("o_totalprice") * 1.15).alias("prediction"),
    )


HALVES = f"""
ref AS (
  SELECT o_orderkey, o_orderpriority AS priority, o_orderstatus AS status,
         o_custkey::VARCHAR AS address, o_totalprice AS price,
         {price_class_sql('o_totalprice')} AS price_category
  FROM orders WHERE o_orderdate < TIMESTAMP '{CUT}'
),
prod AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 10 = 0 THEN '9-NEW'
              WHEN o_orderkey % 10 IN (1, 2, 3) THEN '1-URGENT' ELSE o_orderpriority END AS priority,
         o_orderstatus AS status, o_custkey::VARCHAR || '-' || (o_orderkey % 7)::VARCHAR AS address,
         CASE WHEN o_orderkey % 23 <> 0 THEN o_totalprice * 1.15 END AS price,
         {price_class_sql('(o_totalprice * 1.15)')} AS prediction
  FROM orders WHERE o_orderdate >= TIMESTAMP '{CUT}'
)"""

PSI_TERM = """CASE WHEN a = 0 AND e = 0 THEN 0
  WHEN e > 1e-6 THEN (a - e) * ln((a + 1e-6) / (e + 1e-6))
  WHEN a > 1e-6 THEN a * ln((a + 1e-6) / 1e-6) ELSE 0 END"""
KL_TERM = """CASE WHEN a < 1e-6 THEN 0 WHEN e < 1e-6 THEN a * ln(a / 1e-6)
  ELSE a * ln((a + 1e-6) / (e + 1e-6)) END"""


def aligned_sql(ref_col: str, prod_col: str, dropna: bool = False) -> str:
    """Aligned counts ``v, nr, np`` of a column of ``ref`` and ``prod``."""
    keep = "WHERE v IS NOT NULL" if dropna else ""
    return f"""(SELECT v, sum(r) AS nr, sum(p) AS np FROM (
      SELECT {ref_col}::VARCHAR AS v, 1 AS r, 0 AS p FROM ref
      UNION ALL SELECT {prod_col}::VARCHAR, 0, 1 FROM prod) {keep} GROUP BY v)"""


def shares_sql(ref_col: str, prod_col: str, dropna: bool = False) -> str:
    """Aligned shares ``v, e, a``."""
    return f"""(SELECT v, nr / sum(nr) OVER () AS e, np / sum(np) OVER () AS a
      FROM {aligned_sql(ref_col, prod_col, dropna)})"""


def psi_sql(column: str, scale: float, dropna: bool = False) -> str:
    return f"(SELECT greatest(0, sum({PSI_TERM})) / {scale} FROM {shares_sql(column, column, dropna)})"


def kl_sql(ref_col: str, prod_col: str, scale: float) -> str:
    return f"(SELECT greatest(0, sum({KL_TERM})) / {scale} FROM {shares_sql(ref_col, prod_col, True)})"


def numeric_psi_sql(column: str, scale: float = 15, bins: int = 10) -> str:
    above = " + ".join(f"(x > lo + {i} * ((hi - lo) / {bins}))::INT" for i in range(1, bins))
    return f"""(SELECT greatest(0, sum({PSI_TERM})) / {scale} FROM (
      SELECT nr / sum(nr) OVER () AS e, np / sum(np) OVER () AS a FROM (
        SELECT b, sum(r) AS nr, sum(p) AS np FROM (
          SELECT r, p, 1 + {above} AS b FROM (
            SELECT {column} AS x, 1 AS r, 0 AS p FROM ref UNION ALL SELECT {column}, 0, 1 FROM prod),
            (SELECT min({column}) AS lo, max({column}) AS hi FROM ref)
          WHERE x BETWEEN lo - 0.001 * (hi - lo) AND hi) GROUP BY b)))"""


# --- listings composed from orders and customers ------------------------------


def listings_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and their customers dressed up as raw scraped listings, all text."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    months = F.array(*[F.lit(m) for m in MONTH_NAMES])
    d = F.col("o_orderdate")
    date_text = F.concat_ws(
        " ", F.dayofmonth(d).cast("string"), F.get(months, F.month(d) - 1), F.year(d).cast("string")
    )
    metres = F.floor(F.col("o_totalprice") / 1000).cast("bigint")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        key.alias("listing_id"),
        F.concat(metres.cast("string"), F.lit("m²")).alias("GrossSquareMeters"),
        F.when(key % 17 != 0, F.concat(F.floor(metres * 8 / 10).cast("string"), F.lit(" m²"))).alias("NetSquareMeters"),
        F.when(cust % 10 == 0, F.lit("21 ve Üzeri")).otherwise(F.concat((cust % 20).cast("string"), F.lit(" yıl"))).alias("BuildingAge"),
        F.concat((key % 5 + 1).cast("string"), F.lit("+1")).alias("NumberOfRooms"),
        F.concat(F.lit("District "), F.col("c_nationkey").cast("string")).alias("district"),
        F.when(key % 19 != 0, F.col("o_orderpriority")).alias("HeatingType"),
        F.col("c_mktsegment").alias("StructureType"),
        F.col("o_orderstatus").alias("FloorLocation"),
        F.col("c_name").alias("address"),
        date_text.alias("AdCreationDate"),
        F.when(key % 13 != 0, F.concat(F.lit("Sub"), (cust % 4).cast("string"))).alias("Subscription"),
        F.concat(F.format_number(F.floor(F.col("o_totalprice")).cast("bigint"), 0), F.lit(" TL")).alias("price"),
    )


MONTH_NAMES = list(MONTHS)
MONTH_LIST_SQL = "[" + ", ".join(f"'{m}'" for m in MONTH_NAMES) + "]"

CLEAN_LISTINGS_SQL = f"""
listings AS (
  SELECT o_orderkey AS listing_id,
    floor(o_totalprice / 1000)::BIGINT::DOUBLE AS "GrossSquareMeters",
    CASE WHEN o_orderkey % 17 <> 0 THEN floor(floor(o_totalprice / 1000)::BIGINT * 8 / 10)::BIGINT::DOUBLE END AS "NetSquareMeters",
    CASE WHEN o_custkey % 10 = 0 THEN 21 ELSE o_custkey % 20 END::BIGINT AS "BuildingAge",
    (o_orderkey % 5 + 1)::DOUBLE AS "NumberOfRooms",
    'District ' || c_nationkey::VARCHAR AS district,
    CASE WHEN o_orderkey % 19 <> 0 THEN o_orderpriority END AS "HeatingType",
    c_mktsegment AS "StructureType", o_orderstatus AS "FloorLocation", c_name AS address,
    strftime(o_orderdate, '%Y-%m') AS "AdCreationDate",
    CASE WHEN o_orderkey % 13 <> 0 THEN 'Sub' || (o_custkey % 4)::VARCHAR ELSE 'unknown' END AS "Subscription",
    floor(o_totalprice)::DOUBLE AS price
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

# --- three-class predictions on orders ----------------------------------------

SCORES_SQL = f"""
z AS (
  SELECT o_orderkey, {price_class_sql('o_totalprice')} AS label,
         o_totalprice * (0.7 + 0.006 * ((o_orderkey * 37) % 101)) / 200000 AS z
  FROM orders
),
raw AS (
  SELECT o_orderkey, label, floor(50 / (1 + abs(z - 0.5))) AS s0, floor(50 / (1 + abs(z - 1.5))) AS s1,
         floor(50 / (1 + abs(z - 2.2))) AS s2 FROM z
),
scored AS (
  SELECT o_orderkey, label, s0 / (s0 + s1 + s2) AS p0, s1 / (s0 + s1 + s2) AS p1, s2 / (s0 + s1 + s2) AS p2,
         CASE WHEN s0 >= s1 AND s0 >= s2 THEN 0 WHEN s1 >= s2 THEN 1 ELSE 2 END AS prediction
  FROM raw
)"""


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a true price class, three tied-up scores and a prediction."""
    z = F.col("o_totalprice") * (0.7 + 0.006 * ((F.col("o_orderkey") * 37) % 101)) / 200000
    raw = (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_orderdate", price_class(F.col("o_totalprice")).alias("label"), z.alias("z"))
        .select(
            "o_orderkey",
            "o_orderdate",
            "label",
            *[
                F.floor(50 / (1 + F.abs(F.col("z") - centre))).cast("double").alias(f"s{i}")
                for i, centre in enumerate((0.5, 1.5, 2.2))
            ],
        )
    )
    s = [F.col(f"s{i}") for i in range(3)]
    total = s[0] + s[1] + s[2]
    best = F.when((s[0] >= s[1]) & (s[0] >= s[2]), 0).when(s[1] >= s[2], 1).otherwise(2)
    return raw.select(
        "o_orderkey", "o_orderdate", "label", F.array(*[x / total for x in s]).alias("scores"), best.alias("prediction")
    )
