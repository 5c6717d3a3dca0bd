"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from plumbline.llm.common import col, slices, stored, texts_of

# Labelled documents that the lexicon, the trees and the calibration may learn from.
LABELLED = 20_000
# Lexicon entries, the leading stems of words.
STEMS = 2_000
SHORTEST, LONGEST = 3, 12
LEAST_ODDS = 2.5
NEAR = 5
ROUNDS, DEPTH = 25, 4
REJECT = 0.7

# Second-person words of the corpus languages.
SECOND_PERSON = frozenset(
    "you your yours yourself u du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros".split()
)
# Signs and digits written for letters.
DISGUISE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

FEATURES = [
    "log_words",
    "hits",
    "hit_share",
    "weight_share",
    "distinct_hits",
    "top_weight",
    "near_second_person",
    "second_person_share",
    "capitals",
    "capital_words",
    "punctuation",
    "exclamations",
    "disguised",
    "disguised_hits",
]


def plain(word: str) -> str:
    """Lower case without signs at either end."""
    return word.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¡¿«»„“”‘’…").lower()


def stems(word: Column) -> Column:
    """The leading stems of a word and, with an end mark, the word itself."""
    sizes = F.sequence(F.lit(SHORTEST), F.least(F.length(word), F.lit(LONGEST)))
    return F.when(
        F.length(word) >= SHORTEST,
        F.concat(F.transform(sizes, lambda n: F.substring(word, F.lit(1), n)), F.array(F.concat(word, F.lit("$")))),
    ).otherwise(F.array(F.concat(word, F.lit("$"))))


def learn_lexicon(sample: DataFrame, most: int = STEMS) -> dict[str, float]:
    """Stems with their log odds of toxic against clean documents, from ``text, toxic`` rows.

    A stem counts once per document and once per distinct text. It needs one in a
    hundred of the toxic documents, four at least, so that the words of a few copied
    documents do not enter. At most ``most`` rows reach the driver.
    """
    once = sample.dropDuplicates(["text"])
    sizes = once.agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c")).first()
    if not sizes["t"] or not sizes["c"]:
        return {}
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    exploded = once.select("toxic", F.array_distinct(F.flatten(F.transform(words, stems))).alias("s"))
    counts = (
        exploded.select("toxic", F.explode("s").alias("stem"))
        .groupBy("stem")
        .agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c"))
    )
    least = max(4, sizes["t"] // 100)
    odds = F.log((F.col("t") + 0.5) / (sizes["t"] + 1.0)) - F.log((F.col("c") + 0.5) / (sizes["c"] + 1.0))
    kept = counts.where(F.col("t") >= least).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    rows = kept.orderBy(F.desc(F.col("odds") * F.sqrt("t")), "stem").limit(most).collect()
    return {r["stem"]: r["odds"] for r in rows}


class WordFacts(dict):
    """For a raw word: its lexicon weight and what it looks like, found once per worker and task."""

    MOST = 60_000

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon

    def weight(self, word: str) -> float:
        lexicon = self.lexicon
        best = lexicon.get(word + "$", 0.0)
        for n in range(SHORTEST, min(len(word), LONGEST) + 1):
            best = max(best, lexicon.get(word[:n], 0.0))
        return best

    def __missing__(self, raw: str) -> tuple[float, int]:
        word = plain(raw)
        weight = self.weight(word)
        disguised = word != "" and not word.isalpha() and any(c.isalpha() for c in word)
        if disguised and not weight:
            bare = "".join(DISGUISE.get(c, c) for c in word if c in DISGUISE or c.isalpha())
            weight = self.weight(bare)
            disguised_hit = weight > 0
        else:
            disguised_hit = False
        capital = len(word) > 1 and raw.isupper()
        facts = (weight, (word in SECOND_PERSON) + 2 * capital + 4 * disguised + 8 * disguised_hit)
        if len(self) < self.MOST and len(raw) <= 64:
            self[raw] = facts
        return facts


def features_of(text: str, facts: WordFacts) -> list[float]:
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    table = np.array([facts[w] for w in words])
    weight, flags = table[:, 0], table[:, 1].astype("i8")
    hit, you = np.flatnonzero(weight), np.flatnonzero(flags & 1)
    near = 0
    if len(hit) and len(you):
        at = np.searchsorted(you, hit)
        after = np.abs(you[np.minimum(at, len(you) - 1)] - hit)
        before = np.abs(you[np.maximum(at - 1, 0)] - hit)
        near = int((np.minimum(after, before) <= NEAR).sum())
    size = max(1, len(text))
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    distinct = len({plain(words[i]) for i in hit})
    return [
        float(np.log1p(n)),
        float(np.log1p(len(hit))),
        100.0 * len(hit) / n,
        100.0 * float(weight.sum()) / n,
        float(distinct),
        float(weight.max()),
        100.0 * near / n,
        100.0 * len(you) / n,
        upper / size,
        float(np.count_nonzero(flags & 2)) / n,
        sum(text.count(c) for c in ".,;:!?\"'()-*#%&$") / size,
        100.0 * text.count("!") / n,
        100.0 * float(np.count_nonzero(flags & 4)) / n,
        float(np.log1p(np.count_nonzero(flags & 8))),
    ]


def with_features(rows: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """Adds ``features`` of each whole ``text``, as array<double>."""
    kept = rows.columns
    schema = StructType([*rows.schema.fields, StructField("features", ArrayType(DoubleType()))])
    sent = rows.sparkSession.sparkContext.broadcast(lexicon)

    def dense(batches):
        facts = WordFacts(sent.value)
        for batch in batches:
            for part in slices(batch, 500_000):
                made = [features_of(t, facts) for t in part.column("text").to_pylist()]
                columns = [part.column(c) for c in kept] + [pa.array(made, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, [*kept, "features"])
        # The worker lives on for other tasks; what this one held goes back.
        facts.clear()
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(dense, schema)


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document may not be learnt: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


class ToxicityModel:
    """Learnt from at most ``labelled`` labelled documents that are not held out.

    Documents whose hash remainder is 0 grow the trees, those with 2 calibrate them.
    Where the labels have one class only, every score is that class's.
    """

    def __init__(self, docs: DataFrame, labels: DataFrame, labelled: int = LABELLED):
        known = labels.select(col("doc_id").alias("known"), col("toxic").alias("toxic"))
        known = known.where("known is not null and toxic is not null")
        known = known.where(~held_out(F.col("known"))).groupBy("known").agg(F.max("toxic").cast("int").alias("toxic"))
        chosen = known.orderBy(F.xxhash64("known"), "known").limit(labelled)
        rows = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("known")).select("doc_id", "text", "toxic")
        rows = stored(rows, "toxic-sample")
        self.lexicon = learn_lexicon(rows)
        fold = (F.crc32(F.col("doc_id").cast("string")) % 3).cast("int")
        made = stored(with_features(rows, self.lexicon).drop("text").withColumn("fold", fold), "toxic-features")
        self.share = made.agg(F.avg("toxic").alias("x")).first()["x"] or 0.0
        grow = made.where("fold = 0")
        self.trees = self.steps = None
        if grow.select("toxic").distinct().count() == 2:
            vectors = grow.select(array_to_vector("features").alias("features"), F.col("toxic").cast("double").alias("label"))
            vectors = vectors.coalesce(4)
            learner = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.2, minInstancesPerNode=5, seed=7, maxBins=64)
            self.trees = learner.fit(vectors.persist())
            vectors.unpersist()
            check = made.where("fold = 2")
            if check.select("toxic").distinct().count() < 2:
                check = made
            margins = self.margin(check).select("margin", F.col("toxic").cast("double").alias("label")).coalesce(1)
            fitted = IsotonicRegression(featuresCol="margin").fit(margins)
            self.steps = (list(fitted.boundaries), list(fitted.predictions))

    def margin(self, featured: DataFrame) -> DataFrame:
        """Adds the trees' ``margin``."""
        vectors = featured.withColumn("features", array_to_vector("features"))
        return self.trees.transform(vectors).withColumn("margin", vector_to_array("rawPrediction")[1])

    def score(self, margin: Column) -> Column:
        """The calibrated probability; a hundredth of the margin's own keeps order among its ties."""
        bounds, values = self.steps
        x, y = F.lit(bounds), F.lit(values)
        # The boundaries come sorted, so the number below the margin is the place.
        place = F.size(F.filter(x, lambda b: b <= margin))
        low, high = F.get(x, place - 1), F.get(x, place)
        f, g = F.get(y, place - 1), F.get(y, place)
        between = f + (g - f) * (margin - low) / (high - low)
        level = F.when(place == 0, F.lit(values[0])).when(place == len(bounds), F.lit(values[-1])).otherwise(between)
        return F.lit(0.99) * level + F.lit(0.01) / (1 + F.exp(-2 * margin))

    def scored(self, rows: DataFrame) -> DataFrame:
        """The columns of ``rows``, of which ``text`` has no nulls, and ``score``."""
        if self.trees is None:
            return rows.withColumn("score", F.lit(float(self.share)))
        made = self.margin(with_features(rows, self.lexicon))
        return made.select(*rows.columns, self.score(F.col("margin")).alias("score"))


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", reject: float = REJECT
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Null and empty texts have all features 0 and get the score of that. A null id is
    not held out. Rows that share an id are scored apart. An empty label table gives
    score 0 throughout.
    """
    rows = texts_of(docs, id_col, text_col)
    scored = ToxicityModel(rows, labels).scored(rows)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= reject).cast("int").alias("predicted"),
    )


def acceptable_documents(docs: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """The rows of ``docs``, with their own columns, whose score is below ``reject``."""
    texts = texts_of(docs)
    whole = F.struct(*[col(c) for c in docs.columns])
    rows = docs.select(F.coalesce(col("text"), F.lit("")).alias("text"), whole.alias("row"))
    scored = ToxicityModel(texts, labels).scored(rows)
    return scored.where(F.col("score") < reject).select("row.*")
