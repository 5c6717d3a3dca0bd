"""Repeated runs of lines, by suffix ranks of line sequences from prefix doubling."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.common import col, slices, stored
from plumbline.operators.ranks import running_totals

# A run counts from so many words on; a shorter one if its words times the documents
# that have it come to what two documents with such a run come to.
LEAST_WORDS = 50

LINES = "doc_id bigint, tie bigint, pos int, line int, id1 bigint, id2 bigint, words int, ahead int, back int"
WINDOWS = "doc_id bigint, tie bigint, pos int, size int, words int, id1 bigint, id2 bigint"


def line_rows(texts: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """A row for each line with a word of ``doc_id, tie, text``.

    ``pos`` numbers a document's lines with words, ``line`` all its lines; ``id1,
    id2`` are the 128-bit line id, spaces at either end aside. ``ahead`` is the
    number of lines from this one on that together reach ``least_words``, ``back``
    that of lines up to this one, 0 if the document has too few words that way.
    """

    def split(batches):
        for batch in batches:
            for part in slices(batch):
                columns: list[list] = [[] for _ in range(9)]
                keys = zip(*(part.column(c).to_pylist() for c in ("doc_id", "tie", "text")))
                for k, tie, text in keys:
                    found = [(i, x.strip(b" \t\n\r\x0b\f")) for i, x in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n"))]
                    found = [(i, x) for i, x in found if x]
                    if not found:
                        continue
                    n = len(found)
                    words = np.array([len(x.split()) for _, x in found])
                    ends = np.cumsum(words)
                    starts = np.concatenate([[0], ends[:-1]])
                    at = np.arange(n)
                    last = np.searchsorted(ends, starts + least_words)
                    first = np.searchsorted(starts, ends - least_words, "right") - 1
                    digests = [xxhash.xxh3_128_intdigest(x) for _, x in found]
                    made = (
                        [k] * n,
                        [tie] * n,
                        range(n),
                        [i for i, _ in found],
                        np.array([d >> 64 for d in digests], "u8").view("i8"),
                        np.array([d & (2**64 - 1) for d in digests], "u8").view("i8"),
                        words,
                        np.where(last < n, last - at + 1, 0),
                        np.where(first >= 0, at - first + 1, 0),
                    )
                    for column, values in zip(columns, made):
                        column.extend(values)
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                names = ["doc_id", "tie", "pos", "line", "id1", "id2", "words", "ahead", "back"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return texts.mapInArrow(split, LINES)


def _rank(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``doc_id, tie, pos, rank`` of rows whose key occurs twice or more.

    The rank is the key's place among all such keys in sorted order: classes are
    counted before they are sorted, so a key that a third of all rows share is one
    row in the sort.
    """
    classes = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    ranks = running_totals(classes.select(*keys, F.lit(1).cast("bigint").alias("one")), keys, ["one"])
    ranks = ranks.select(*keys, F.col("before_one").alias("rank"))
    return stored(rows.join(ranks, keys).select("doc_id", "tie", "pos", "rank"), "suffix-ranks")


def _same(left: str, right: str, shift: int | Column = 0) -> Column:
    a, b = (lambda c: F.col(f"{left}.{c}")), (lambda c: F.col(f"{right}.{c}"))
    return a("doc_id").eqNullSafe(b("doc_id")) & (a("tie") == b("tie")) & (b("pos") == a("pos") + shift)


def suffix_ranks(lines: DataFrame, most: int) -> list[DataFrame]:
    """Level ``k`` ranks the runs of ``2^k`` lines that occur more than once, up to ``most`` lines.

    Prefix doubling: a run of twice the length is the pair of ranks at its two
    halves. Positions whose run is unique are ranked no further, for a longer run
    from there is unique as well.
    """
    levels = [_rank(lines.select("doc_id", "tie", "pos", "id1", "id2"), ["id1", "id2"])]
    step = 1
    while 2 * step <= most:
        now = levels[-1]
        pairs = now.alias("a").join(now.alias("b"), _same("a", "b", step))
        pairs = pairs.select("a.doc_id", "a.tie", "a.pos", F.col("a.rank").alias("r1"), F.col("b.rank").alias("r2"))
        following = _rank(pairs, ["r1", "r2"])
        if not following.take(1):
            break
        levels.append(following)
        step *= 2
    return levels


def repeated_runs(lines: DataFrame) -> DataFrame:
    """``doc_id, tie, pos, size``: lines that repeat a run from earlier in the corpus.

    A run's windows are the least stretches of lines that reach the wanted number of
    words from one of its lines on, or up to it. Every line of a long enough run
    lies in such a window within the run, and a copy's windows are the copy's, so
    the windows that occur earlier cover exactly the maximal repeated runs. Windows
    of one length whose first ``2^k`` and last ``2^k`` lines (``2^k`` at most the
    length, twice that more) rank alike share that prefix: they are one interval of
    the suffix array. Its least position, in the order of id and position, stays.
    Of a window that overlaps the one that stays, the part beyond it goes.
    """
    windows = lines.where("ahead > 0").select("doc_id", "tie", "pos", F.col("ahead").alias("size")).union(
        lines.where("back > 0").select("doc_id", "tie", F.col("pos") - F.col("back") + 1, "back")
    )
    windows = windows.distinct().withColumn("level", F.floor(F.log2("size") + 1e-9).cast("int"))
    most = windows.agg(F.max("size").alias("m")).first()["m"] or 0
    levels = suffix_ranks(lines, most)
    ranks = levels[0].withColumn("level", F.lit(0))
    for k, level in enumerate(levels[1:], 1):
        ranks = ranks.union(level.withColumn("level", F.lit(k)))
    half = F.col("w.size") - F.expr("shiftleft(1, w.level)")
    at = F.col("w.level") == F.col("r.level")
    begin = windows.alias("w").join(ranks.alias("r"), _same("w", "r") & at)
    begin = begin.select("w.doc_id", "w.tie", "w.pos", "w.size", "w.level", F.col("r.rank").alias("r1"))
    ended = begin.alias("w").join(
        ranks.alias("r"),
        F.col("w.doc_id").eqNullSafe(F.col("r.doc_id"))
        & (F.col("w.tie") == F.col("r.tie"))
        & (F.col("r.pos") == F.col("w.pos") + half)
        & at,
    )
    known = stored(
        ended.select("w.doc_id", "w.tie", "w.pos", "w.size", "w.r1", F.col("r.rank").alias("r2")), "line-windows"
    )
    keys = ["size", "r1", "r2"]
    firsts = (
        known.groupBy(*keys)
        .agg(F.min(F.struct("doc_id", "tie", "pos")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
    )
    return _later(known, firsts, keys)


def _later(known: DataFrame, firsts: DataFrame, keys: list[str]) -> DataFrame:
    """``doc_id, tie, pos, size`` of the windows but the first of each key, without what overlaps that one."""
    later = known.join(firsts, keys).where(~F.struct("doc_id", "tie", "pos").eqNullSafe(F.col("first")))
    own = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.tie") == F.col("tie"))
    begin = F.when(own, F.greatest(F.col("pos"), F.col("first.pos") + F.col("size"))).otherwise(F.col("pos"))
    return later.select("doc_id", "tie", begin.alias("pos"), (F.col("pos") + F.col("size") - begin).cast("int").alias("size"))


def short_windows(lines: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, tie, pos, size, words, id1, id2``: runs under ``least_words`` that may be common enough.

    A run is in no more documents than any of its lines, so it is left out if its
    words times the documents of its rarest line are too few, and if each of its
    lines is common enough alone. ``id1, id2`` are the 128-bit id of its line ids.
    """
    wanted = 2 * least_words
    per = lines.select("id1", "id2", "doc_id", "tie").distinct().groupBy("id1", "id2").agg(F.count("*").alias("n"))
    per = stored(per.where(F.col("n") * (least_words - 1) >= wanted), "common-lines")
    found = F.sort_array(F.collect_list(F.struct("pos", "words", "n", "id1", "id2"))).alias("found")
    common = lines.where(F.col("words") < least_words).join(per, ["id1", "id2"]).groupBy("doc_id", "tie").agg(found)

    def runs(found: list[dict]):
        ids = [(x["id1"] % 2**64).to_bytes(8, "big") + (x["id2"] % 2**64).to_bytes(8, "big") for x in found]
        for i, x in enumerate(found):
            words, docs, alone = 0, x["n"], True
            for j in range(i, len(found)):
                y = found[j]
                words += y["words"]
                if words >= least_words or y["pos"] != x["pos"] + j - i:
                    break
                docs = min(docs, y["n"])
                alone = alone and y["words"] * y["n"] >= wanted
                if words * docs >= wanted and (i == j or not alone):
                    digest = xxhash.xxh3_128_intdigest(b"".join(ids[i : j + 1]))
                    yield x["pos"], j - i + 1, words, digest >> 64, digest & (2**64 - 1)

    def batch_of(rows: list[tuple]):
        doc, tie, pos, size, words, id1, id2 = zip(*rows)
        columns = [pa.array(doc, pa.int64()), pa.array(tie, pa.int64())]
        columns += [pa.array(c, pa.int32()) for c in (pos, size, words)]
        columns += [pa.array(np.array(c, "u8").view("i8")) for c in (id1, id2)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "tie", "pos", "size", "words", "id1", "id2"])

    def listed(batches):
        for batch in batches:
            rows = []
            for k, tie, found in zip(*(batch.column(c) for c in ("doc_id", "tie", "found"))):
                for run in runs(found.as_py()):
                    rows.append((k.as_py(), tie.as_py(), *run))
                    if len(rows) == 100_000:
                        yield batch_of(rows)
                        rows = []
            if rows:
                yield batch_of(rows)

    return common.mapInArrow(listed, WINDOWS)


def common_runs(lines: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, tie, pos, size``: lines that repeat a short run which many documents have.

    Copies within a document count as one, so that a document's own refrain stays.
    Counts are taken per document first, so a run that all documents have is summed
    in parts.
    """
    known = stored(short_windows(lines, least_words), "short-windows")
    keys = ["size", "id1", "id2"]
    each = known.groupBy(*keys, "words", "doc_id", "tie").agg(F.min("pos").alias("pos"))
    firsts = each.groupBy(*keys, "words").agg(F.min(F.struct("doc_id", "tie", "pos")).alias("first"), F.count("*").alias("n"))
    firsts = stored(firsts.where(F.col("words") * F.col("n") >= 2 * least_words).select(*keys, "first"), "short-firsts")
    return _later(known, firsts, keys)


def deduplicated_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows of ``docs`` with their own columns, ``text`` without repeated runs, and
    ``__lines_removed``.

    A line goes if it lies in a run of lines that occurs earlier in the corpus,
    documents in the order of their ids, and that has ``least_words`` or more words,
    or fewer if these times the documents that have the run are ``2 * least_words``
    or more: a line of 10 words goes if 10 documents have it. What is rarer stays,
    and so do short repeats within a document alone. Lines are
    equal but for spaces at either end; lines without words do not part a run, and
    stay. A column ``n_chars``, if there, follows the text.

    Null texts stay null. A null id sorts first. Rows equal in id and text are one
    document and share its fate. An empty table gives an empty result.
    """
    tie = F.xxhash64(col("text"))
    texts = docs.where(col("text").isNotNull()).select(
        col("doc_id").alias("doc_id"), tie.alias("tie"), col("text").alias("text")
    )
    lines = stored(line_rows(texts, least_words).distinct(), "corpus-lines")
    runs = repeated_runs(lines).union(common_runs(lines, least_words)).where("size > 0")
    gone = runs.select("doc_id", "tie", F.explode(F.sequence("pos", F.col("pos") + F.col("size") - 1)).alias("pos")).distinct()
    numbered = gone.alias("g").join(lines.alias("l"), _same("g", "l")).select("l.doc_id", "l.tie", "l.line")
    per = numbered.groupBy("doc_id", "tie").agg(F.collect_list("line").alias("__gone"))
    per = stored(per.withColumnsRenamed({"doc_id": "__doc", "tie": "__tie"}), "lines-gone")
    joined = docs.join(per, col("doc_id").eqNullSafe(F.col("__doc")) & (tie == F.col("__tie")), "left")
    left = F.when(F.col("__gone").isNull(), col("text")).otherwise(_without(col("text"), F.col("__gone")))
    out = joined.select(*[col(c) for c in docs.columns], left.alias("__left"), "__gone")

    def value(name: str) -> Column:
        if name == "text":
            return F.col("__left").alias(name)
        if name == "n_chars":
            changed = F.length("__left").cast(docs.schema[name].dataType)
            return F.when(F.col("__gone").isNull(), col(name)).otherwise(changed).alias(name)
        return col(name)

    removed = F.coalesce(F.size("__gone"), F.lit(0)).alias("__lines_removed")
    return out.select(*[value(c) for c in docs.columns], removed)


def _without(text: Column, gone: Column) -> Column:
    """The text without the lines of these numbers.

    Runs are kept as (first, last) pairs, as many as there are gaps between removed
    lines, and every line is looked up in them.
    """
    ordered = F.sort_array(gone)

    def kept(marked: Column) -> Column:
        return F.array_join(F.transform(marked, lambda x: x["line"]), "\n")

    lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("no"), x.alias("line")))
    edges = F.transform(
        F.array(ordered),
        lambda g: F.filter(
            F.zip_with(
                F.concat(F.array(F.lit(None).cast("int")), g),
                F.concat(g, F.array(F.lit(None).cast("int"))),
                lambda a, b: F.struct(a.alias("end"), b.alias("next")),
            ),
            lambda e: e["end"].isNull() | e["next"].isNull() | (e["next"] > e["end"] + 1),
        ),
    )
    spans = F.transform(
        edges,
        lambda e: F.zip_with(
            F.slice(e, 1, F.size(e) - 1),
            F.slice(e, 2, F.size(e) - 1),
            lambda a, b: F.struct(a["next"].alias("first"), b["end"].alias("last")),
        ),
    )
    left = F.transform(
        spans,
        lambda s: kept(F.filter(lines, lambda x: ~F.exists(s, lambda v: (x["no"] >= v["first"]) & (x["no"] <= v["last"])))),
    )
    return F.get(left, F.lit(0))
