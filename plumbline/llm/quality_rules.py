"""Quality by hashed n-gram log-likelihood ratio, beside a few base counts.

All of it is built-in functions: no Python runs in the executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.common import SPACE, col, stored, texts_of, words
from plumbline.operators.ranks import exact_quantiles

# Slots of the hashed n-grams, a power of two. The hash space is the method's own parameter:
# every n-gram of every document is counted in it, and its ratios are one row of 2 MB.
SLOTS = 1 << 18
# Of so many trusted documents one, by the hash of its id, sets the threshold and is not learnt from.
FOLDS = 3
SMOOTHING = 1.0
# Ratios are added up as integers in units of 2^-32, so that their order does not count.
UNIT = 2.0**32
# Share of the held-out trusted documents whose score may lie below the threshold.
TAIL = 0.005
WINDOW = 8
SYMBOLS = "#*$%&|<>"
# Runs of letters and digits, and runs of signs; all that is not ASCII counts as letters.
TOKEN = r"[0-9a-z\x{80}-\x{10FFFF}]+|[!-/:-@\[-`{-~]+"


def tokens_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def grams_of(text: Column) -> Column:
    """Hashes of all unigrams and bigrams of the lower-cased tokens, as one array."""
    return once(F.transform(tokens_of(text), lambda t: F.xxhash64(t)), lambda t: F.concat(t, paired(t, 1)))


def gram_rows(rows: DataFrame, *names: str) -> DataFrame:
    """The hashes of ``grams_of``, a row of ``names, one, two`` for each token of ``text``: its own, and that of it and the next.

    Tokens are hashed where they are rows, in generated code; the last has no next (null).
    """
    after = F.slice("tokens", 2, F.greatest(F.size("tokens"), F.lit(1)))
    both = F.arrays_zip(F.col("tokens").alias("token"), after.alias("next"))
    pairs = rows.select(*names, tokens_of(F.col("text")).alias("tokens")).select(*names, F.inline(both))
    two = F.when(F.col("next").isNotNull(), F.xxhash64(F.xxhash64("token"), F.xxhash64("next")))
    return pairs.select(*names, F.xxhash64("token").alias("one"), two.alias("two"))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def paired(x: Column, step: int) -> Column:
    """The hash of each element and the one ``step`` places on."""
    n = F.greatest(F.size(x) - step, F.lit(0))
    return F.zip_with(F.slice(x, 1, n), F.slice(x, step + 1, n), lambda a, b: F.xxhash64(a, b))


def slot_of(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit(SLOTS - 1).cast("bigint"))


def one_array(rows: DataFrame, label: str) -> Column:
    """``value`` by ``slot`` as an array of ``SLOTS`` entries, 0 where there is none.

    It is stored as one row and read as a scalar, so its size is the same for any corpus.
    """
    none = rows.sparkSession.range(SLOTS).select(F.col("id").alias("slot"), F.lit(0).cast("bigint").alias("value"))
    full = rows.select("slot", "value").union(none).groupBy("slot").agg(F.sum("value").alias("value"))
    listed = full.agg(F.sort_array(F.collect_list(F.struct("slot", "value"))).alias("found"))
    listed = stored(listed.select(F.transform("found", lambda x: x["value"]).alias("values")), label)
    return listed.select("values").scalar()


def trusted_texts(rows: DataFrame, good: DataFrame) -> DataFrame:
    """``text`` of the rows whose id is in ``good``.

    A table of ``64 * SLOTS`` bits, one set for each good id, first leaves out most
    other texts, so that these are not shuffled to be joined.
    """
    slot = lambda x: F.xxhash64(x).bitwiseAND(F.lit(64 * SLOTS - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), slot("good_id").bitwiseAND(F.lit(63)).cast("int"))
    words = good.groupBy(F.shiftright(slot("good_id"), 6).alias("slot")).agg(F.bit_or(bit).alias("value"))
    word = F.get(one_array(words, "trusted-bits"), F.shiftright(slot("doc_id"), 6).cast("int"))
    maybe = F.call_function("shiftright", word, slot("doc_id").bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
    # Sizes on either side follow the corpus, so Spark's guess must not decide how they are joined.
    same = F.col("doc_id") == F.col("good_id")
    return rows.where(F.col("doc_id").isNotNull() & maybe).join(good.hint("merge"), same, "left_semi").select("text")


def slot_counts(texts: DataFrame) -> DataFrame:
    """``slot, n``: n-grams in each slot, summed per task before the shuffle."""
    grams = gram_rows(texts).select(F.explode(F.array("one", "two")).alias("gram")).where("gram is not null")
    return grams.groupBy(slot_of(F.col("gram")).alias("slot")).agg(F.count("*").alias("n"))


def slot_ratios(raw: DataFrame, trusted: DataFrame) -> Column:
    """Log-likelihood ratio of each slot, trusted texts to all, in units of ``1 / UNIT``."""
    raw = slot_counts(raw).select("slot", F.col("n").alias("raw"), F.lit(0).cast("bigint").alias("good"))
    good = slot_counts(trusted).select("slot", F.lit(0).cast("bigint"), "n")
    counts = stored(raw.union(good).groupBy("slot").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")), "slot-counts")

    def log_share(name: str) -> Column:
        total = F.coalesce(counts.select(F.sum(name)).scalar(), F.lit(0))
        return F.log((F.col(name) + SMOOTHING) / (total + SMOOTHING * SLOTS))

    ratio = F.round((log_share("good") - log_share("raw")) * UNIT).cast("bigint")
    return one_array(counts.select("slot", ratio.alias("value")), "slot-ratios")


def mean_ratios(rows: DataFrame, ratios: Column) -> DataFrame:
    """``doc_id, tie, score``: the mean ratio of a text's n-grams, so that length does not count.

    Texts without n-grams have no row. Each n-gram's ratio is looked up where the text
    is read, and sums are all that is shuffled. Rows equal in id and text add to the
    same sum and count, which leaves the mean.
    """

    def ratio(name: str) -> Column:
        return F.coalesce(F.get(ratios, slot_of(F.col(name)).cast("int")), F.lit(0))

    grams = gram_rows(rows, "doc_id", "tie").withColumn("ratio", ratio("one") + ratio("two"))
    sums = grams.groupBy("doc_id", "tie").agg(F.sum("ratio").alias("total"), (F.count("one") + F.count("two")).alias("n"))
    return sums.select("doc_id", "tie", (F.col("total") / F.col("n") / UNIT).alias("score"))


def repeated_words(hashes: Column) -> Column:
    """Words in 8-word windows that are found twice or more, first included.

    ``hashes`` are of the text's words in order; hashing neighbours three times
    over gives those of the windows. Windows are sorted by hash with their place;
    those with an equal neighbour are repeated, and the gaps between their sorted
    places, a window's width at most, sum to the words they cover.
    """
    nothing, no = F.lit(0).cast("bigint"), F.lit(False)

    def places(s: Column) -> Column:
        """In order, the places of windows with an equal neighbour in ``s``."""
        n = F.size(s)
        none = F.array(F.lit(None).cast("struct<k:bigint,p:int>"))
        before, after = F.concat(none, F.slice(s, 1, n - 1)), F.concat(F.slice(s, 2, n - 1), none)
        left = F.zip_with(
            s, before, lambda a, b: F.struct(a["k"].alias("k"), a["p"].alias("p"), F.coalesce(a["k"] == b["k"], no).alias("x"))
        )
        either = F.zip_with(
            left, after, lambda a, b: F.struct(a["p"].alias("p"), (a["x"] | F.coalesce(a["k"] == b["k"], no)).alias("x"))
        )
        return F.sort_array(F.transform(F.filter(either, lambda e: e["x"]), lambda e: e["p"]))

    def covered(p: Column) -> Column:
        wide = F.lit(WINDOW)
        gaps = F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.least(wide, F.coalesce(b - a, wide)))
        return F.aggregate(gaps, nothing, lambda a, x: a + x)

    def of_windows(w: Column) -> Column:
        ordered = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("k"), i.alias("p"))))
        found = once(once(ordered, places), covered)
        return F.when(F.size(F.array_distinct(w)) < F.size(w), found).otherwise(nothing)

    def windows(h: Column) -> Column:
        return once(once(paired(h, 1), lambda x: paired(x, 2)), lambda x: paired(x, 4))

    return F.when(F.size(hashes) > WINDOW, once(windows(hashes), of_windows)).otherwise(nothing)


def base_counts(docs: DataFrame) -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` to ``text, …``."""
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(rf"[^{SPACE}]"))

    def of_words(h: Column) -> Column:
        return F.struct(F.size(h).cast("bigint").alias("n_words"), repeated_words(h).alias("n_repeat_words"))

    return docs.select(
        *docs.columns,
        F.inline(F.array(once(F.transform(words(text), lambda x: F.xxhash64(x)), of_words))),
        F.length(F.regexp_replace(text, rf"[{SPACE}]+", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace(text, rf"[^{SYMBOLS}]+", "")).cast("bigint").alias("n_symbols"),
        once(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
    )


def quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", tail: float = TAIL
) -> DataFrame:
    """Per document the base counts, ``base_failed, score, threshold, kept``.

    Trusted documents are all those labelled good, but for one in ``FOLDS`` held out;
    the raw corpus is every document. A score is the mean log ratio of a text's hashed
    unigrams and bigrams between the two multinomials over ``SLOTS`` slots, looked up
    where the text is read, so no n-gram is shuffled. The threshold is the
    ``tail`` quantile of the held-out trusted documents that pass the base rules (of
    all trusted ones if there are none), so it follows from the data alone, and the
    same rule judges every document. A document fails the base rules with under 20
    words or with over 30 % of its words in repeated windows of 8.

    Null texts have no words and fail; without labels no document is below the
    threshold. A null id is never trusted. Rows that share an id are judged apart.
    """
    rows = texts_of(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    good = labels.where((col("quality") == 1) & col("doc_id").isNotNull()).select(col("doc_id").alias("good_id")).distinct()
    good = stored(good.withColumn("held", F.pmod(F.xxhash64("good_id"), F.lit(FOLDS)) == 0), "quality-trusted")
    ratios = slot_ratios(rows.select("text"), trusted_texts(rows, good.where("not held")))
    scores = mean_ratios(rows, ratios).withColumnsRenamed({"doc_id": "scored_id", "tie": "scored_tie"})
    same = F.col("doc_id").eqNullSafe(F.col("scored_id")) & (F.col("tie") == F.col("scored_tie"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    scored = base_counts(rows).drop("text").withColumn("base_failed", failed).join(scores, same, "left")
    scored = stored(scored.drop("tie", "scored_id", "scored_tie"), "quality-scores")
    judged = scored.where("doc_id is not null and score is not null and not base_failed")
    marked = stored(judged.join(good, F.col("doc_id") == F.col("good_id")).select("held", "score"), "trusted-scores")
    low = [exact_quantiles(marked.where(F.col("held") == held), "score", [tail]).select("q0").scalar() for held in (True, False)]
    threshold = F.coalesce(*low, F.lit(float("-inf")))
    return scored.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("score") >= threshold, F.lit(False))).alias("kept"),
        "score",
        threshold.alias("threshold"),
    )
