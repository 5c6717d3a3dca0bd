"""Training, scoring and evaluation. Learned numbers have no SQL twin."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from plumbline.functions.cleaning import clean_listings
from plumbline.operators.features import feature_pipeline, plain_split, split_key
from plumbline.plans import training as L
from plumbline.plans.catalogue.base import listings_text, query, table, tidy
from plumbline.plans.evaluation import continuous_evaluation as evaluate_continuously, evaluate_model as evaluate
from plumbline.plans.prepare import Prepared, prepare
from plumbline.plans.scoring import score
from plumbline.schemas import REQUEST
from plumbline.session import scratch_path
from plumbline.sources.artifacts import load_first, load_saved, save_model
from plumbline.sources.requests import check_requests, valid_requests
from plumbline.sources.tables import read_table, try_read


def _vectors(spark, sf_dir):
    """Embeddings with their label, split by a hash of the id."""
    e = table(spark, sf_dir, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"), F.col("label").cast("double").alias("label")
    )
    e = plain_split(e, "vec_id")
    return e.where(~F.col("is_test")).drop("is_test"), e.where("is_test").drop("is_test")


def _report(model, test):
    return tidy(evaluate(model, test)["metrics"])


@query("train_baseline")
def train_baseline(spark, sf_dir):
    train, test = _vectors(spark, sf_dir)
    return _report(L.train_baseline(train), test)


@query("train_forest")
def train_forest(spark, sf_dir):
    train, test = _vectors(spark, sf_dir)
    return _report(L.train_forest(train), test)


@query("forest_blocks")
def forest_blocks(spark, sf_dir):
    """Two blocks of trees, then a resumed run that adds those that are wanting."""
    train, test = _vectors(spark, sf_dir)
    folder = scratch_path(spark, "forest")
    L.train_forest_blocks(train, folder, trees=2 * L.BLOCK)
    return _report(L.train_forest_blocks(train, folder), test)


@query("decision_tree")
def decision_tree(spark, sf_dir):
    train, test = _vectors(spark, sf_dir)
    return _report(L.train_tree(train), test)


def _price_rows(spark, sf_dir):
    """Price class of orders with line totals, three classes."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum("l_extendedprice").alias("amount"), F.sum("l_quantity").alias("quantity"), F.count("*").alias("lines")
    )
    o = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    noise = (split_key(F.col("o_orderkey")) % 1000) / 1000.0
    blurred = F.col("o_totalprice") * (0.8 + 0.4 * noise)
    return o.select(
        "o_orderkey",
        F.array(blurred, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in ("amount", "quantity", "lines")]).alias("x"),
        F.when(F.col("o_totalprice") <= 200000, 0.0).when(F.col("o_totalprice") <= 400000, 1.0).otherwise(2.0).alias("label"),
    ).select("o_orderkey", array_to_vector("x").alias("features"), "label")


@query("boosted_trees")
def boosted_trees(spark, sf_dir):
    rows = plain_split(_price_rows(spark, sf_dir), "o_orderkey")
    model = L.train_boosted(rows.where(~F.col("is_test")))
    return _report(model, rows.where("is_test"))


# Where a session has left the model of a folder of tables: (application, folder) to preparation.
_FITTED: dict[tuple[str, str], Prepared] = {}


def fitted_listings(spark, sf_dir):
    """Prepared listings with fitted transforms and a forest, both saved and loaded back.

    A session trains once per folder of tables; its later queries load what that left.
    """
    known = (spark.sparkContext.applicationId, sf_dir)
    left = _FITTED.get(known)
    if left is None or try_read(spark, left.train) is None or load_saved(f"{left.folder}/forest", RandomForestClassificationModel.load) is None:
        folder = scratch_path(spark, "model")
        done = prepare(listings_text(spark, sf_dir), "listing_id", folder)
        save_model(L.train_forest(read_table(spark, done.train)), f"{folder}/forest")
        _FITTED[known] = done
    done = _FITTED[known]
    transforms = load_first([f"{done.folder}/no-such-model", f"{done.folder}/transforms"])
    loaded = load_first([f"{done.folder}/forest"], RandomForestClassificationModel.load)
    return transforms, loaded, done


def request_texts(spark, sf_dir):
    """Cleaned listings as JSON requests; some lack a number."""
    cleaned = clean_listings(listings_text(spark, sf_dir))
    fields = []
    for f in REQUEST:
        value = F.coalesce(F.col(f.name).cast("string"), F.lit("0"))
        if f.name == "GrossSquareMeters":
            value = F.when(F.col("listing_id") % 13 == 0, F.lit("not_a_number")).otherwise(value)
        fields.append(value.alias(f.name))
    return cleaned.select(F.col("listing_id").cast("string").alias("request_id"), F.to_json(F.struct(*fields)).alias("body"))


@query("score_batch")
def score_batch(spark, sf_dir):
    transforms, model, _ = fitted_listings(spark, sf_dir)
    valid = valid_requests(check_requests(request_texts(spark, sf_dir), body="body"))
    return score(valid, transforms, model).select("request_id", "prediction", "price_category")


@query("evaluate_model")
def evaluate_model(spark, sf_dir):
    """Confusion matrix of the loaded forest on the held-out listings."""
    _, model, done = fitted_listings(spark, sf_dir)
    return evaluate(model, read_table(spark, done.test))["confusion"]


@query("evaluation_report")
def evaluation_report(spark, sf_dir):
    _, model, done = fitted_listings(spark, sf_dir)
    return tidy(evaluate(model, read_table(spark, done.test))["report"])


@query("continuous_evaluation")
def continuous_evaluation(spark, sf_dir):
    """Reference quality of the model, production statistics and share changes."""
    transforms, model, done = fitted_listings(spark, sf_dir)
    valid = valid_requests(check_requests(request_texts(spark, sf_dir), body="body"))
    predictions = score(valid, transforms, model).select("prediction")
    return tidy(evaluate_continuously(model, read_table(spark, done.test), predictions))
