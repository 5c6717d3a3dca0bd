"""Classifiers on Spark ML."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    OneVsRest,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from plumbline.operators.features import SEED, add_class_weights
from plumbline.plans.binning import MAX_BINS, binned_features
from plumbline.plans.forest import prefers_sparse, sparse_forest
from plumbline.sources.artifacts import load_saved, save_model

# Iterations, trees, trees per block.
ITERATIONS = 1000
TREES = 100
BLOCK = 20


def train_baseline(train: DataFrame, max_iter: int = ITERATIONS, c: float = 1.0):
    """Balanced multinomial logistic regression with an L2 penalty of strength 1/c."""
    weighted = add_class_weights(train, "label")
    total = weighted.agg(F.sum("weight")).first()[0]
    return LogisticRegression(
        family="multinomial",
        maxIter=max_iter,
        weightCol="weight",
        regParam=1.0 / (c * total),
        standardization=False,
    ).fit(weighted)


def _forest(trees: int, seed: int, max_depth: int) -> RandomForestClassifier:
    return RandomForestClassifier(
        numTrees=trees, seed=seed, maxDepth=max_depth, maxBins=MAX_BINS, featureSubsetStrategy="sqrt", weightCol="weight"
    )


def _grown(weighted: DataFrame, trees: int, seed: int, max_depth: int) -> RandomForestClassificationModel:
    """Spark's forest, or the same one from sparse rows where Spark's would be far larger than those."""
    forest = _forest(trees, seed, max_depth)
    width = _feature_count(weighted)
    return sparse_forest(forest, weighted, width) if prefers_sparse(weighted, width) else forest.fit(weighted)


def train_forest(train: DataFrame, trees: int = TREES, seed: int = SEED, max_depth: int = 10):
    """Random forest; class and sample weights both apply, so the weight is squared."""
    return _grown(add_class_weights(binned_features(train), "label", power=2), trees, seed, max_depth)


def class_probabilities(column: str = "probability"):
    return vector_to_array(F.col(column))


def _feature_count(df: DataFrame, column: str = "features") -> int:
    meta = df.schema[column].metadata.get("ml_attr", {}).get("num_attrs")
    return int(meta) if meta is not None else df.select(column).first()[0].size


class ForestBlocks(Transformer):
    """Forests used as one: probabilities are averaged, each block's by its number of trees."""

    def __init__(self, models: list[RandomForestClassificationModel]):
        super().__init__()
        self.models = models

    @property
    def trees(self) -> int:
        return sum(m.getNumTrees for m in self.models)

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df
        names = []
        for i, model in enumerate(self.models):
            names.append(f"_block{i}")
            block = model.copy().setProbabilityCol(names[-1]).setRawPredictionCol("").setPredictionCol("")
            out = block.transform(out)

        def weighted(name: str, trees: int):
            return F.transform(class_probabilities(name), lambda x: x * (trees / self.trees))

        parts = [weighted(n, m.getNumTrees) for n, m in zip(names, self.models)]
        total = parts[0]
        for part in parts[1:]:
            total = F.zip_with(total, part, lambda a, b: a + b)
        out = out.withColumn("probability", total).drop(*names)
        best = F.array_position("probability", F.array_max("probability")) - 1
        return out.withColumn("prediction", best.cast("double"))


def train_forest_blocks(
    train: DataFrame,
    folder: str,
    trees: int = TREES,
    block: int = BLOCK,
    seed: int = SEED,
    max_depth: int = 10,
    resume: bool = True,
) -> ForestBlocks:
    """Grow a forest block by block, saving each block as it is finished.

    A later call continues after the last saved block that fits: one of the wanted
    number of trees, depth and seed, for as many features and classes. From the
    first that does not, blocks are grown anew.
    """
    weighted = None
    width = _feature_count(train)
    classes = int(train.agg(F.max("label")).first()[0]) + 1
    models: list[RandomForestClassificationModel] = []
    for i in range(-(-trees // block)):
        path = f"{folder}/block-{i:04d}"
        saved = load_saved(path, RandomForestClassificationModel.load) if resume else None
        size = min(block, trees - i * block)
        wanted = (size, max_depth, seed + i, width, classes)
        if saved is not None and wanted == (
            saved.getNumTrees,
            saved.getOrDefault("maxDepth"),
            saved.getOrDefault("seed"),
            saved.numFeatures,
            saved.numClasses,
        ):
            models.append(saved)
            continue
        # Blocks after a missing or unusable one are grown anew.
        resume = False
        if weighted is None:
            weighted = add_class_weights(binned_features(train), "label", power=2)
        models.append(_grown(weighted, size, seed + i, max_depth))
        save_model(models[-1], path)
    return ForestBlocks(models)


def load_forest_blocks(folder: str) -> ForestBlocks:
    """The saved blocks of a folder, up to the first gap."""
    models: list[RandomForestClassificationModel] = []
    while (block := load_saved(f"{folder}/block-{len(models):04d}", RandomForestClassificationModel.load)) is not None:
        models.append(block)
    if not models:
        raise RuntimeError(f"no forest block in {folder}")
    return ForestBlocks(models)


def train_tree(train: DataFrame, seed: int = SEED, max_depth: int = 10):
    return DecisionTreeClassifier(seed=seed, maxDepth=max_depth, maxBins=MAX_BINS).fit(binned_features(train))


def train_boosted(train: DataFrame, rounds: int = 20, seed: int = SEED, max_depth: int = 5):
    """Boosted trees, one binary model per class."""
    return OneVsRest(classifier=GBTClassifier(maxIter=rounds, maxDepth=max_depth, maxBins=MAX_BINS, seed=seed)).fit(
        binned_features(train)
    )
