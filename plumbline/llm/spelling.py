"""Groups of spelling variants: words one edit apart, by dynamic programming over sorted lists."""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import slices, stored, texts_of

LEAST_LETTERS = 5
LEAST_COUNT = 3
# A form has at least so many times the occurrences of its variant.
TIMES = 2
# One run in so many, by its hash, loses a code point.
DAMAGED = 97
# Words of a sorted list that one task searches, as long as there are at most MOST_BLOCKS
# of them, whose bounds every task has.
BLOCK = 20_000
MOST_BLOCKS = 4_096
# Distinct words a task counts before it hands them on.
FLUSH = 400_000
# Query words that go through a block together.
TOGETHER = 8_192

# Latin-1 bytes of letters, A-Z as a-z; all others part runs.
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 0x20 for c in range(256)
)


def letter_runs(text: str) -> list[bytes]:
    """Maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased, a byte for each code point."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split(b" ")


def counted_words(docs: DataFrame, least: int = LEAST_LETTERS, damaged: int | None = DAMAGED) -> DataFrame:
    """``word, n`` of all words with ``least`` or more code points in ``doc_id, text``.

    If ``damaged`` divides the crc32 of ``<doc_id>:<word>``, the word loses the code
    point at crc32 modulo its length. Counts are summed per task before the shuffle.
    """

    def batch_of(counts: Counter) -> pa.RecordBatch:
        words = [w.decode("latin-1") for w in counts]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    def count(batches):
        counts: Counter = Counter()
        for batch in batches:
            for part in slices(batch):
                for key, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    own = Counter([w for w in letter_runs(text) if len(w) >= least])
                    if damaged is None:
                        counts.update(own)
                        continue
                    prefix = zlib.crc32(b"%d:" % key if key is not None else b":")
                    for word, n in own.items():
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), prefix)
                        if h % damaged == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least:
                                continue
                        counts[word] += n
                if len(counts) >= FLUSH:
                    yield batch_of(counts)
                    counts.clear()
        if counts:
            yield batch_of(counts)

    return docs.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class SortedWords:
    """A sorted list of distinct words that is searched for words one edit away.

    Row ``d`` of the edit matrix between a query and a listed word, in a band of one
    to either side of the diagonal, is the same for all words that share ``d``
    letters. Neighbours with a longest common prefix of ``d`` or more therefore form
    one range and share their rows, and the rows of a longer prefix follow from
    those of the shorter. A range whose rows all exceed one edit is left as a whole.
    """

    def __init__(self, words: list[str]):
        self.words = words
        self.sizes = np.array([len(w) for w in words], "i8")
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.codes = np.frombuffer("".join(words).encode("utf-32-le"), "u4")
        self.lcp = self._common()
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def _common(self) -> np.ndarray:
        """Of each word, the letters shared with the one before."""
        n = len(self.words)
        common = np.zeros(n, "i8")
        alive = np.arange(1, n)
        while len(alive):
            d = common[alive]
            alive = alive[(d < self.sizes[alive]) & (d < self.sizes[alive - 1])]
            d = common[alive]
            alive = alive[self.codes[self.starts[alive] + d] == self.codes[self.starts[alive - 1] + d]]
            common[alive] += 1
        return common

    def level(self, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, end and ``depth``-th letter of each range that shares ``depth`` letters."""
        while len(self.levels) < depth:
            d = len(self.levels) + 1
            alive = np.flatnonzero(self.sizes >= d) if d == 1 else self.alive[self.sizes[self.alive] >= d]
            self.alive = alive
            if not len(alive):
                self.levels.append((alive, alive, alive.astype("u4")))
                continue
            new = np.ones(len(alive), bool)
            new[1:] = (self.lcp[alive[1:]] < d) | (alive[1:] != alive[:-1] + 1)
            first = alive[new]
            last = alive[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(alive) - 1]])]
            self.levels.append((first, last + 1, self.codes[self.starts[first] + d - 1]))
        return self.levels[depth - 1]

    def near(self, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of places (in ``queries``, in the list) one edit apart that share the first half.

        The half is that of the shorter word, rounded down. While a prefix is shorter
        than it can be, only ranges that begin as the query does go on.
        """
        size = np.array([len(q) for q in queries], "i8")
        start = np.concatenate([[0], np.cumsum(size + 3)])[:-1]
        # A letter that no word has stands before and after each query.
        code = np.frombuffer("".join(f"\0{q}\0\0" for q in queries).encode("utf-32-le"), "u4")
        asked, listed = [], []
        # Of each query in a range: the rows' entries below, on and above the diagonal.
        q = np.arange(len(queries))
        begin, end = np.zeros(len(q), "i8"), np.full(len(q), len(self.words))
        low, mid, high = np.full(len(q), 2), np.zeros(len(q), "i8"), np.ones(len(q), "i8")
        depth = 0
        while len(q):
            first, last, letter = self.level(depth + 1)
            a, b = np.searchsorted(first, begin), np.searchsorted(first, end)
            pick = np.repeat(np.arange(len(q)), b - a)
            child = np.arange(len(pick)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + a[pick]
            q, low, mid, high, c = q[pick], low[pick], mid[pick], high[pick], letter[child]
            begin, end = first[child], last[child]
            # Places depth-1, depth and depth+1 of the query; the first letter has place 1 in ``code``.
            at = start[q] + depth
            below = np.minimum(mid + 1, low + (code[at] != c))
            here = np.minimum(np.minimum(high, below) + 1, mid + (code[at + 1] != c))
            above = np.minimum(here + 1, high + (code[np.minimum(at + 2, start[q] + size[q] + 1)] != c))
            depth += 1
            # Columns beyond the query's end do not exist.
            here = np.where(depth > size[q], 2, here)
            above = np.where(depth + 1 > size[q], 2, above)
            far = np.where(depth <= (size[q] - 1) // 2, here > 0, np.minimum(np.minimum(below, here), above) > 1)
            go = ~far & (depth <= size[q] + 1)
            q, begin, end, low, mid, high = (x[go] for x in (q, begin, end, below, here, above))
            over = size[q] - depth
            edits = np.select([over == -1, over == 0, over == 1], [low, mid, high], 2)
            found = (self.sizes[begin] == depth) & (edits == 1)
            asked.append(q[found])
            listed.append(begin[found])
        asked, listed = np.concatenate(asked or [q]), np.concatenate(listed or [q])
        same = [queries[i][: h] == self.words[j][: h] for i, j in zip(asked, listed) for h in [min(len(queries[i]), len(self.words[j])) // 2]]
        same = np.array(same, bool)
        return asked[same], listed[same]


def mirrored_near(block: SortedWords, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """As ``near`` of mirrored words, without the pairs that share the first half unmirrored."""
    asked, listed = block.near(queries)
    left = [
        queries[i][::-1][:h] != block.words[j][::-1][:h]
        for i, j in zip(asked, listed)
        for h in [min(len(queries[i]), len(block.words[j])) // 2]
    ]
    left = np.array(left, bool)
    return asked[left], listed[left]


NEAR = "word string, n bigint, n_near bigint, best_n bigint, best string"


def near_words(vocabulary: DataFrame) -> DataFrame:
    """``word, n, n_near, best_n, best``: number of words one edit away, and the most frequent of them.

    An edit lies in one half of a word; the other half is shared. So all words stand
    in two sorted lists, as they are and mirrored, and a pair is found in the first
    if it shares the first half, else in the second. Both lists are range-partitioned
    into blocks; a word is looked for in those blocks that hold words that begin as
    its first half does, mostly one. Nothing is put out for each pair.
    """
    total = vocabulary.count()
    blocks = max(1, min(MOST_BLOCKS, -(-2 * total // BLOCK)))
    both = vocabulary.select(F.explode(F.array(F.lit(False), F.lit(True))).alias("mirrored"), "word", "n")
    both = both.withColumn("key", F.when(F.col("mirrored"), F.reverse("word")).otherwise(F.col("word")))
    # The list's name leads the key, so each block has words of one order only where the lists meet.
    placed = both.repartitionByRange(blocks, "mirrored", "key").withColumn("part", F.spark_partition_id())
    placed = stored(placed.select("part", "mirrored", "key", "n"), "spelling-lists")
    edges = placed.groupBy("part", "mirrored").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    bounds = {side: sorted((r["low"], r["high"], r["part"]) for r in edges.where(F.col("mirrored") == side).collect()) for side in (False, True)}
    lows = {side: [low for low, _, _ in found] for side, found in bounds.items()}
    highs = {side: [high for _, high, _ in found] for side, found in bounds.items()}
    parts = {side: [part for _, _, part in found] for side, found in bounds.items()}

    def route(batches):
        for batch in batches:
            columns = [[], [], [], []]
            for side, key, n in zip(*(batch.column(c).to_pylist() for c in ("mirrored", "key", "n"))):
                head = key[: (len(key) - 1) // 2]
                # Blocks from the first that ends at or after the head to the last that begins with it or before.
                a = bisect_left(highs[side], head)
                b = bisect_right(lows[side], head + "\U0010ffff")
                for part in parts[side][a:b]:
                    for column, value in zip(columns, (part, side, key, n)):
                        column.append(value)
            kinds = (pa.int32(), pa.bool_(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["part", "mirrored", "key", "n"])

    asked = placed.mapInArrow(route, "part int, mirrored boolean, key string, n bigint")
    rows = placed.withColumn("asks", F.lit(False)).unionByName(asked.withColumn("asks", F.lit(True)))

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for side, own in frame.groupby("mirrored"):
            listed = own[~own["asks"]].sort_values("key")
            block = SortedWords(listed["key"].tolist())
            number = listed["n"].to_numpy()
            queries = own[own["asks"]].sort_values("key")
            keys, n = queries["key"].tolist(), queries["n"].to_numpy()
            names = [w[::-1] for w in block.words] if side else block.words
            find = (lambda qs, b=block: mirrored_near(b, qs)) if side else block.near
            for i in range(0, len(keys), TOGETHER):
                some = keys[i : i + TOGETHER]
                a, b = find(some)
                count = np.bincount(a, minlength=len(some))
                best_n, best = np.full(len(some), None, object), np.full(len(some), None, object)
                for x, y in zip(a.tolist(), b.tolist()):
                    m = int(number[y])
                    if best_n[x] is None or m > best_n[x] or (m == best_n[x] and names[y] < best[x]):
                        best_n[x], best[x] = m, names[y]
                out.append(
                    pd.DataFrame(
                        {
                            "word": [w[::-1] for w in some] if side else some,
                            "n": n[i : i + TOGETHER],
                            "n_near": count,
                            "best_n": pd.array(best_n, "Int64"),
                            "best": best,
                        }
                    )
                )
        return pd.concat(out) if out else pd.DataFrame(columns=["word", "n", "n_near", "best_n", "best"])

    found = rows.groupBy("part").applyInPandas(search, NEAR)
    first = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), "best"))).alias("b")
    per = found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), first)
    return per.select("word", "n", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


def rooted(forms: DataFrame) -> DataFrame:
    """Adds ``root`` to ``word, form, …``: where the forms of forms end.

    Each round replaces a root by its own root so far, so a chain of forms is halved;
    occurrences at least double along it, so there are few rounds.
    """
    at = stored(forms.withColumn("root", F.coalesce("form", "word")), "spelling-forms")
    while True:
        step = at.where("form is not null").select(F.col("word").alias("from"), F.col("root").alias("to"))
        if not at.join(step, F.col("root") == F.col("from"), "left_semi").take(1):
            return at
        ahead = at.join(step, F.col("root") == F.col("from"), "left")
        at = stored(ahead.select(*forms.columns, F.coalesce("to", "root").alias("root")), "spelling-roots")


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST_COUNT,
    times: int = TIMES,
    damaged: int | None = DAMAGED,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each word with ``least`` occurrences or more.

    Words are maximal runs of Latin letters of five code points or more, A-Z
    lower-cased; one in ``damaged`` loses a letter first (none if it is None). A
    word's form is its most frequent word one edit away, the first in code-point order
    of equals, if that has ``times`` its occurrences; its root is where forms lead.

    Null and empty texts have no words; a null id hashes as an empty one. Rows that
    share an id count apart. An empty table gives an empty result.
    """
    vocabulary = stored(counted_words(texts_of(docs, id_col, text_col), damaged=damaged).where(F.col("n") >= least), "vocabulary")
    near = near_words(vocabulary)
    has = F.col("best_n") >= times * F.col("n")
    forms = near.select(
        "word", F.when(has, F.col("best")).alias("form"), "n", "n_near", F.when(has, F.col("best_n")).alias("form_n")
    )
    return rooted(forms).select("word", "form", "root", "n", "n_near", "form_n")
