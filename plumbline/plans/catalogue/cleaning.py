"""Cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from plumbline.functions import cleaning as C, labels as L
from plumbline.functions.sql import register_sql_functions
from plumbline.plans.catalogue.base import (
    CLEAN_LISTINGS_SQL,
    MONTH_LIST_SQL,
    MONTH_NAMES,
    listings_text,
    price_class,
    price_class_sql,
    query,
    table,
    tidy,
)
from plumbline.plans.prepare import label_listings
from plumbline.schemas import RAW_LISTING
from plumbline.session import scratch_path
from plumbline.sources.requests import check_requests
from plumbline.sources.tables import read_listings, read_table, table_size, with_timestamp, write_snapshot


@query(
    "clean_price",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 31 = 0 THEN NULL
         ELSE floor(o_totalprice)::BIGINT::DOUBLE END AS price FROM orders""",
)
def clean_price(spark, sf_dir):
    key = F.col("o_orderkey")
    shown = F.format_number(F.floor("o_totalprice").cast("bigint"), 0)
    text = (
        F.when(key % 31 == 0, F.lit("TL"))
        .when(key % 7 == 0, F.concat(F.replace(shown, F.lit(","), F.lit("")), F.lit("arrow_downward%3")))
        .otherwise(F.concat(shown, F.lit(" TL")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", C.price(text).alias("price"))


@query(
    "clean_sqm",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 11 = 0 THEN NULL
         WHEN l_orderkey % 3 = 0 THEN (l_quantity * 10 + 5)::BIGINT::DOUBLE
         ELSE l_quantity END AS sqm FROM lineitem""",
)
def clean_sqm(spark, sf_dir):
    key, n = F.col("l_orderkey"), F.col("l_quantity").cast("bigint").cast("string")
    text = (
        F.when(key % 11 == 0, F.lit("m²"))
        .when(key % 3 == 0, F.concat(n, F.lit(".5")))
        .otherwise(F.concat(n, F.lit(" m²")))
    )
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", C.square_metres(text).alias("sqm"))


@query(
    "clean_age",
    """SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_size > 20 THEN 21
         WHEN p_size % 5 = 0 THEN (p_size::VARCHAR || (p_size + 5)::VARCHAR)::BIGINT
         ELSE p_size END::BIGINT AS age FROM part""",
)
def clean_age(spark, sf_dir):
    key, size = F.col("p_partkey"), F.col("p_size")
    text = (
        F.when(key % 13 == 0, F.lit("yeni"))
        .when(size > 20, F.lit("21 ve Üzeri"))
        .when(size % 5 == 0, F.concat_ws("-", size.cast("string"), (size + 5).cast("string")))
        .otherwise(F.concat(size.cast("string"), F.lit(" years")))
    )
    return table(spark, sf_dir, "part").select("p_partkey", C.building_age(text).alias("age"))


@query(
    "clean_rooms",
    """SELECT p_partkey, CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN p_size + 0.5
         ELSE p_size END::DOUBLE AS rooms FROM part""",
)
def clean_rooms(spark, sf_dir):
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    text = (
        F.when(key % 17 == 0, F.lit("Stüdyo"))
        .when(key % 3 == 0, F.concat(F.lit(" "), size, F.lit(".5 ODA")))
        .otherwise(F.concat(size, F.lit("+1")))
    )
    return table(spark, sf_dir, "part").select("p_partkey", C.rooms(text).alias("rooms"))


@query(
    "clean_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 41 = 0 OR o_orderkey % 37 = 0 THEN 'unknown'
         WHEN o_orderkey % 29 = 0 THEN year(o_orderdate)::VARCHAR || '-00'
         ELSE strftime(o_orderdate, '%Y-%m') END AS month FROM orders""",
)
def clean_date(spark, sf_dir):
    key, d = F.col("o_orderkey"), F.col("o_orderdate")
    day, year = F.dayofmonth(d).cast("string"), F.year(d).cast("string")
    month = F.get(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month(d) - 1)
    text = (
        F.when(key % 41 == 0, F.lit(None).cast("string"))
        .when(key % 37 == 0, F.concat_ws(" ", month, year))
        .when(key % 29 == 0, F.concat_ws(" ", day, F.lit("Foo"), year))
        .otherwise(F.concat(F.lit(" "), F.concat_ws("  ", day, month, year)))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", C.listing_month(text).alias("month"))


@query(
    "clean_address",
    """SELECT c_custkey, r_name || ' > ' || n_name || ' > ' || c_name AS joined,
         CASE WHEN c_custkey % 9 = 0 THEN 'unknown' ELSE c_name END AS address
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def clean_address(spark, sf_dir):
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    parts = F.array("r_name", "n_name", "c_name")
    return (
        table(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            C.address(parts, T.ArrayType(T.StringType())).alias("joined"),
            C.address(F.when(F.col("c_custkey") % 9 != 0, F.col("c_name"))).alias("address"),
        )
    )


@query(
    "fill_subscription",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 23 = 0 THEN 'unknown' ELSE o_orderpriority END AS subscription FROM orders",
)
def fill_subscription(spark, sf_dir):
    text = F.when(F.col("o_orderkey") % 23 != 0, F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select("o_orderkey", C.subscription(text).alias("subscription"))


@query(
    "feature_cross",
    "SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'nan' ELSE p_brand END || '_' || p_type AS brand_type FROM part",
)
def feature_cross(spark, sf_dir):
    brand = F.when(F.col("p_partkey") % 7 != 0, F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", C.cross(brand, F.col("p_type")).alias("brand_type"))


@query(
    "code_labels",
    f"""WITH c AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 7 ELSE {price_class_sql('o_totalprice')} END AS code FROM orders)
       SELECT o_orderkey, CASE code WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' ELSE code::VARCHAR END AS name,
              CASE WHEN code = 7 THEN -1 ELSE code END AS code,
              CASE WHEN code = 7 THEN NULL ELSE code END AS code_or_null FROM c""",
)
def code_labels(spark, sf_dir):
    code = F.when(F.col("o_orderkey") % 50 == 0, 7).otherwise(price_class(F.col("o_totalprice")))
    named = table(spark, sf_dir, "orders").select("o_orderkey", L.class_name(code).alias("name"))
    return named.select(
        "o_orderkey",
        "name",
        L.class_code(F.col("name")).alias("code"),
        L.class_code(F.col("name"), unknown=None).alias("code_or_null"),
    )


@query(
    "request_validation",
    """WITH r AS (SELECT event_id, CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'not_a_number'
                     ELSE json_extract_string(props, '$.k') END AS k,
                     CASE WHEN event_id % 19 = 0 THEN NULL ELSE event_type END AS kind FROM events)
       SELECT event_id, TRY_CAST(k AS DOUBLE) AS k, kind,
         concat_ws('; ', CASE WHEN k IS NULL THEN 'k: missing' WHEN TRY_CAST(k AS DOUBLE) IS NULL THEN 'k: not a number' END,
                   CASE WHEN kind IS NULL THEN 'kind: missing' END) AS reasons FROM r""",
)
def request_validation(spark, sf_dir):
    key = F.col("event_id")
    number = F.get_json_object("props", "$.k")
    k = F.when(key % 17 == 0, F.lit(None).cast("string")).when(key % 13 == 0, F.lit("not_a_number")).otherwise(number)
    kind = F.when(key % 19 != 0, F.col("event_type"))
    body = F.to_json(F.struct(k.alias("k"), kind.alias("kind")))
    requests = table(spark, sf_dir, "events").select("event_id", body.alias("body"))
    checked = check_requests(requests, numbers=["k"], texts=["kind"], body="body")
    return checked.select("event_id", "k", "kind", F.array_join("reasons", "; ").alias("reasons"))


@query(
    "format_labels",
    """SELECT event_id, date_trunc('hour', ts) AS hour,
         CASE WHEN value > 50 THEN '⚠️ Yes' ELSE '✅ No' END AS status,
         CASE WHEN event_id % 11 = 0 THEN 'N/A' ELSE printf('%.4f', value) END AS shown,
         CASE event_type WHEN 'view' THEN 'Type View' WHEN 'click' THEN 'Type Click' WHEN 'purchase' THEN 'Type Purchase'
           WHEN 'signup' THEN 'Type Signup' ELSE 'Type Error' END AS pretty,
         strftime(ts, '%Y-%m-%d %H:%M') AS minute,
         CASE WHEN event_id % 11 = 0 THEN 'nan' ELSE event_type END AS text
       FROM events""",
)
def format_labels(spark, sf_dir):
    gap = F.col("event_id") % 11 != 0
    return table(spark, sf_dir, "events").select(
        "event_id",
        L.hour_of(F.col("ts")).cast("timestamp_ntz").alias("hour"),
        L.status_text(F.col("value") > 50).alias("status"),
        L.fixed_format(F.when(gap, F.col("value"))).alias("shown"),
        L.pretty_name(F.concat(F.lit("type_"), F.col("event_type"))).alias("pretty"),
        L.minute_text(F.col("ts")).alias("minute"),
        C.as_text(F.when(gap, F.col("event_type"))).alias("text"),
    )


@query(
    "sql_functions",
    f"""SELECT o_orderkey, floor(o_totalprice)::BIGINT::DOUBLE AS price, floor(o_totalprice / 1000)::BIGINT::DOUBLE AS sqm,
         strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus || '_' || o_orderpriority AS pair
       FROM orders WHERE {MONTH_LIST_SQL}[month(o_orderdate)] IS NOT NULL""",
)
def sql_functions(spark, sf_dir):
    register_sql_functions(spark)
    months = ", ".join(f"'{m}'" for m in MONTH_NAMES)
    table(spark, sf_dir, "orders").createOrReplaceTempView("plumbline_orders")
    return spark.sql(
        f"""SELECT o_orderkey,
              clean_price(concat(format_number(cast(floor(o_totalprice) AS BIGINT), 0), ' TL')) AS price,
              clean_square_metres(concat(cast(floor(o_totalprice / 1000) AS BIGINT), 'm²')) AS sqm,
              clean_listing_month(concat_ws(' ', dayofmonth(o_orderdate), get(array({months}), month(o_orderdate) - 1), year(o_orderdate))) AS month,
              feature_cross(o_orderstatus, o_orderpriority) AS pair
            FROM plumbline_orders"""
    )


CLEANED = [
    "listing_id", "GrossSquareMeters", "NetSquareMeters", "BuildingAge", "NumberOfRooms", "district",
    "HeatingType", "address", "AdCreationDate", "Subscription",
]


@query(
    "csv_roundtrip",
    f"WITH {CLEAN_LISTINGS_SQL} SELECT " + ", ".join(f'"{c}"' for c in CLEANED) + " FROM listings",
)
def csv_roundtrip(spark, sf_dir):
    """Raw listings written as CSV, read back as text and cleaned."""
    path = scratch_path(spark, "listings")
    listings_text(spark, sf_dir).write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("listing_id", T.LongType()), *RAW_LISTING.fields[1:]])
    return C.clean_listings(read_listings(spark, path, schema)).select(CLEANED)


@query(
    "csv_by_name",
    f"""WITH {CLEAN_LISTINGS_SQL} SELECT listing_id, district || ', "' || "HeatingType" || '"' AS district, address,
         CASE WHEN listing_id % 3 <> 0 THEN "HeatingType" END AS "HeatingType", NULL::VARCHAR AS "FloorLocation" FROM listings""",
)
def csv_by_name(spark, sf_dir):
    """Columns in another order, one absent, one unknown, doubled quotes, and missing-value texts."""
    path = scratch_path(spark, "shuffled")
    quoted = F.concat(F.col("district"), F.lit(', "'), F.col("HeatingType"), F.lit('"'))
    C.clean_listings(listings_text(spark, sf_dir)).select(
        F.when(F.col("listing_id") % 3 != 0, F.col("HeatingType")).otherwise("N/A").alias("HeatingType"),
        "address",
        F.lit("unknown").alias("not_a_field"),
        quoted.alias("district"),
        "listing_id",
    ).write.options(header=True, escape='"').csv(path)
    schema = T.StructType([T.StructField("listing_id", T.LongType()), *RAW_LISTING.fields[1:]])
    return read_listings(spark, path, schema).select("listing_id", "district", "address", "HeatingType", "FloorLocation")


@query(
    "snapshot",
    f"""WITH {CLEAN_LISTINGS_SQL},
         e AS (SELECT quantile_cont(price, 0.4) AS e1, quantile_cont(price, 0.8) AS e2 FROM listings)
       SELECT listing_id, district, address, "HeatingType", "FloorLocation",
         CASE WHEN price <= e1 THEN 0 WHEN price <= e2 THEN 1 ELSE 2 END AS price_category
       FROM listings, e""",
)
def snapshot(spark, sf_dir):
    """Cleaned and labelled listings written as the reference snapshot and read back."""
    path = scratch_path(spark, "snapshot")
    columns = ["listing_id", "district", "address", "HeatingType", "FloorLocation", "price_category"]
    write_snapshot(label_listings(listings_text(spark, sf_dir)), path, columns)
    return with_timestamp(read_table(spark, path))


@query(
    "crossed_listings",
    f"""WITH {CLEAN_LISTINGS_SQL} SELECT listing_id, district || '_' || coalesce("HeatingType", 'nan') AS district_heating,
         district || '_' || "FloorLocation" AS district_floor FROM listings""",
)
def crossed_listings(spark, sf_dir):
    return C.add_crosses(C.clean_listings(listings_text(spark, sf_dir))).select(
        "listing_id", "district_heating", "district_floor"
    )


@query("table_shape", "SELECT count(*) AS rows, 11 AS columns FROM lineitem")
def table_shape(spark, sf_dir):
    return table_size(table(spark, sf_dir, "lineitem"))


@query(
    "timestamp_coercion",
    """SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN date_trunc('second', ts) END AS ts FROM events""",
)
def timestamp_coercion(spark, sf_dir):
    text = F.when(F.col("event_id") % 7 == 0, F.lit("not a date")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    df = with_timestamp(table(spark, sf_dir, "events").select("event_id", text.alias("ts")), "ts")
    return tidy(df.withColumn("ts", F.col("ts").cast("timestamp_ntz")))
