"""Targets, imputation, encodings, hashing and splits."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T
from pyspark.ml.functions import vector_to_array

from plumbline.operators import features as E
from plumbline.plans.catalogue.base import listings_text, price_class, price_class_sql, query, table, tidy
from plumbline.plans.prepare import prepare
from plumbline.session import scratch_path
from plumbline.sources.tables import read_table


@query(
    "quantile_target",
    """WITH p AS (SELECT o_orderkey, CASE WHEN o_orderkey % 23 <> 0 THEN o_totalprice END AS price FROM orders),
       e AS (SELECT quantile_cont(price, 0.4) AS e1, quantile_cont(price, 0.8) AS e2 FROM p)
       SELECT o_orderkey, CASE WHEN price <= e1 THEN 0 WHEN price <= e2 THEN 1 WHEN price > e2 THEN 2 END AS price_category FROM p, e""",
)
def quantile_target(spark, sf_dir):
    price = F.when(F.col("o_orderkey") % 23 != 0, F.col("o_totalprice"))
    df = table(spark, sf_dir, "orders").select("o_orderkey", price.alias("price"))
    return E.quantile_target(df, "price", "price_category").drop("price")


@query(
    "tertiles",
    """WITH e AS (SELECT quantile_cont(l_extendedprice, 1/3) AS e1, quantile_cont(l_extendedprice, 2/3) AS e2 FROM lineitem)
       SELECT third, count(*) AS n, max(l_extendedprice) AS top FROM (
         SELECT l_extendedprice, CASE WHEN l_extendedprice <= e1 THEN 0 WHEN l_extendedprice <= e2 THEN 1 ELSE 2 END AS third FROM lineitem, e)
       GROUP BY third""",
)
def tertiles(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_extendedprice")
    coded = E.quantile_target(df, "l_extendedprice", "third", (0.0, 1 / 3, 2 / 3, 1.0))
    return coded.groupBy("third").agg(F.count("*").alias("n"), F.max("l_extendedprice").alias("top"))


@query(
    "collapsed_target",
    """WITH q AS (SELECT p_partkey, CASE WHEN p_size <= 30 THEN 10 ELSE p_size END AS x FROM part),
       e AS (SELECT quantile_cont(x::DOUBLE, 0.4) AS e1, quantile_cont(x::DOUBLE, 0.8) AS e2, min(x) AS e0 FROM q)
       SELECT p_partkey, (x > e1 AND e1 > e0)::INT + (x > e2 AND e2 > e1)::INT AS code FROM q, e""",
)
def collapsed_target(spark, sf_dir):
    x = F.when(F.col("p_size") <= 30, 10).otherwise(F.col("p_size"))
    df = table(spark, sf_dir, "part").select("p_partkey", x.alias("x"))
    return E.quantile_target(df, "x", "code", strict=False).drop("x")


@query(
    "impute_scale",
    """WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_orderkey % 23 <> 0 THEN l_extendedprice END AS price, l_quantity AS quantity FROM lineitem),
       m AS (SELECT median(price) AS mp, median(quantity) AS mq FROM x),
       f AS (SELECT l_orderkey, l_linenumber, l_partkey, coalesce(price, mp) AS p, coalesce(quantity, mq) AS q FROM x, m),
       s AS (SELECT avg(p) AS ap, stddev_pop(p) AS sp, avg(q) AS aq, stddev_pop(q) AS sq FROM f)
       SELECT l_orderkey, l_linenumber, l_partkey, round((p - ap) / sp, 6) + 0.0 AS price_scaled, round((q - aq) / sq, 6) + 0.0 AS quantity_scaled FROM f, s""",
)
def impute_scale(spark, sf_dir):
    price = F.when(F.col("l_orderkey") % 23 != 0, F.col("l_extendedprice"))
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", price.alias("price"), F.col("l_quantity").alias("quantity")
    )
    columns = ["price", "quantity"]
    model = E.NumericScaler(inputCols=columns, outputCols=[f"{c}_scaled" for c in columns]).fit(df)
    return tidy(model.transform(df).drop(*columns))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "mode_impute_onehot",
    f"""WITH x AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN 'SPACE' ELSE c_mktsegment END AS seg FROM customer),
       known AS (SELECT CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS seg FROM customer),
       mode AS (SELECT seg AS top FROM (SELECT seg, count(*) AS n FROM known WHERE seg IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 1)),
       f AS (SELECT c_custkey, coalesce(seg, top) AS seg FROM x, mode)
       SELECT c_custkey, {', '.join(f"(seg = '{s}')::INT::DOUBLE AS slot_{i}" for i, s in enumerate(SEGMENTS))} FROM f""",
)
def mode_impute_onehot(spark, sf_dir):
    """Fitted on known segments; ``SPACE`` is unseen when transforming."""
    key = F.col("c_custkey")
    gap = F.when(key % 7 != 0, F.col("c_mktsegment"))
    df = table(spark, sf_dir, "customer").select("c_custkey", gap.alias("seg"))
    filler = E.ModeFiller(inputCols=["seg"], outputCols=["filled"]).fit(df)
    train = filler.transform(df)
    indexer, encoder = E.one_hot_stages(["filled"])
    indexer = indexer.fit(train)
    encoder = encoder.fit(indexer.transform(train))
    unseen = df.withColumn("seg", F.when((key % 7 != 0) & (key % 11 == 0), F.lit("SPACE")).otherwise(F.col("seg")))
    out = encoder.transform(indexer.transform(filler.transform(unseen)))
    slots = vector_to_array("filled_onehot")
    return out.select("c_custkey", *[F.get(slots, F.lit(i)).alias(f"slot_{i}") for i in range(len(SEGMENTS))])


@query(
    "hash_features",
    """WITH t AS (SELECT p_partkey, unnest([p_name, p_brand, p_type, p_name, CASE WHEN p_partkey % 9 = 0 THEN 'nan' ELSE p_type || '!' END]) AS token FROM part),
       h AS (SELECT p_partkey, ('0x' || substr(md5(token), 1, 8))::BIGINT % 16384 AS slot,
               CASE WHEN ('0x' || substr(md5(token), 9, 1))::BIGINT % 2 = 1 THEN -1.0 ELSE 1.0 END AS sign FROM t)
       SELECT p_partkey, slot::INT AS slot, sum(sign)::DOUBLE AS value FROM h GROUP BY 1, 2""",
)
def hash_features(spark, sf_dir):
    extra = F.when(F.col("p_partkey") % 9 != 0, F.concat("p_type", F.lit("!")))
    tokens = [F.col("p_name"), F.col("p_brand"), F.col("p_type"), F.col("p_name"), extra]
    index, values = E.hashed_slots(tokens)
    return (
        table(spark, sf_dir, "part")
        .select("p_partkey", F.inline(F.arrays_zip(index.alias("slot"), values.alias("value"))))
        .select("p_partkey", "slot", "value")
    )


@query("label_encode", "SELECT p_partkey, dense_rank() OVER (ORDER BY p_type) - 1 AS code FROM part")
def label_encode(spark, sf_dir):
    return E.label_encode(table(spark, sf_dir, "part"), "p_type", "code").select("p_partkey", "code")


@query(
    "label_encode_all",
    """SELECT p_partkey, dense_rank() OVER (ORDER BY p_name) - 1 AS p_name, dense_rank() OVER (ORDER BY p_brand) - 1 AS p_brand,
         dense_rank() OVER (ORDER BY p_type) - 1 AS p_type, p_size, p_retailprice FROM part""",
)
def label_encode_all(spark, sf_dir):
    return E.label_encode_all(table(spark, sf_dir, "part"))


_KEY_SQL = "('0x' || substr(md5('42:' || o_orderkey::VARCHAR), 1, 15))::BIGINT"


@query(
    "stratified_split",
    f"""WITH c AS (SELECT o_orderkey, {price_class_sql('o_totalprice')} AS class FROM orders),
       r AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY {_KEY_SQL}) AS place, count(*) OVER (PARTITION BY class) AS n FROM c)
       SELECT o_orderkey, class, place <= round(n * 0.2) AS is_test FROM r""",
)
def stratified_split(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", price_class(F.col("o_totalprice")).alias("class"))
    return E.stratified_split(df, "o_orderkey", "class")


@query("plain_split", f"SELECT o_orderkey, {_KEY_SQL} < (0.2 * 1152921504606846976)::BIGINT AS is_test FROM orders")
def plain_split(spark, sf_dir):
    return E.plain_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "weighted_rows",
    """WITH c AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)
       SELECT o_orderkey, round(pow((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n), 2), 6) AS weight FROM orders JOIN c USING (o_orderstatus)""",
)
def weighted_rows(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return tidy(E.add_class_weights(df, "o_orderstatus", power=2).drop("o_orderstatus"))


@query(
    "prepare_features",
    """WITH l AS (SELECT floor(o_totalprice)::DOUBLE AS price FROM orders JOIN customer ON o_custkey = c_custkey),
       e AS (SELECT quantile_cont(price, 0.4) AS e1, quantile_cont(price, 0.8) AS e2 FROM l),
       c AS (SELECT CASE WHEN price <= e1 THEN 0 WHEN price <= e2 THEN 1 ELSE 2 END AS label, count(*) AS n FROM l, e GROUP BY 1)
       SELECT 'test' AS part, label, round(n * 0.2)::BIGINT AS n FROM c
       UNION ALL SELECT 'train', label, n - round(n * 0.2)::BIGINT FROM c""",
)
def prepare_features(spark, sf_dir):
    """The whole preparation on listings; rows per part and class of what it wrote."""
    done = prepare(listings_text(spark, sf_dir), "listing_id", scratch_path(spark, "prepared"))

    def rows(path: str, part: str):
        counts = read_table(spark, path).groupBy(F.col("label").cast("int").alias("label")).agg(F.count("features").alias("n"))
        return counts.select(F.lit(part).alias("part"), "label", "n")

    return rows(done.train, "train").unionByName(rows(done.test, "test"))
