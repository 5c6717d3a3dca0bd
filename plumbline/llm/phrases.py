"""Phrases of two or three words that stand together, by Rabin-Karp fingerprints."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.llm.common import BitTable, col, slices, stored, worker_state

LONGEST = 3
LEAST = 10
TOP = 2_000
# Score of 1: all occurrences of the parts are in the phrase.
SCALE = 1_000_000
# A phrase goes if a longer one that holds it has so many hundredths of its occurrences.
SHARE = 50
# Parts of a language's phrases that are ranked apart before their best meet.
PARTS = 64
# Bits of a fingerprint; a second one of 64 bits tells when two phrases share the first.
BITS = 64
# Bytes of text whose fingerprints a task sorts together before it hands their counts on.
TOGETHER = 1_000_000
# Words of more bytes are hashed one by one: polynomials modulo 2^64 have twins at great length.
LONG_WORD = 64
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

# By byte: 0 in a word, 1 between words, 2 between pieces.
_KINDS = np.zeros(256, "u1")
_KINDS[[0x20, 0x09]] = 1
_KINDS[list(b".,;:!?\n\x0b\x0c\r")] = 2


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """``base^0 … base^(n-1)`` modulo 2^64, kept by the worker and grown by doubling."""
    kept = worker_state(f"powers {base}", lambda: [np.ones(1, "u8")])
    with np.errstate(over="ignore"):
        while len(kept[0]) < n:
            kept[0] = np.concatenate([kept[0], kept[0] * np.uint64(pow(base, len(kept[0]), 1 << 64))])
    return kept[0][:n]


class Polynomial:
    """Sums of values times the base to the power of their place, modulo 2^64.

    The polynomial of any run is the difference of two sums divided by the base to its
    place; an odd base has an inverse.
    """

    def __init__(self, values: np.ndarray, base: int):
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(values) + 1, "u8")
            np.cumsum(values * _powers(base, len(values)), dtype="u8", out=self.sums[1:])
        self.inverse = _powers(pow(base, -1, 1 << 64), len(values) + 1)

    def runs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[end] - self.sums[start]) * self.inverse[start]


class Fingerprints:
    """Two fingerprints of all word n-grams of some texts.

    Words are hashed by polynomials over the bytes, n-grams by polynomials over the
    words' hashes; language and length are mixed in. A-Z count as a-z.
    """

    def __init__(self, texts: list[str], langs: list[str], bits: int = BITS):
        self.bits = bits
        coded = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.data = b"\n".join(coded).lower()
        letters = np.frombuffer(self.data, "u1")
        kinds = _KINDS[letters]
        inside = np.concatenate([[False], kinds == 0, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edges[::2], edges[1::2]
        self.n = len(self.start)
        self.piece = np.cumsum(kinds == 2)[np.minimum(self.start, max(0, len(letters) - 1))] if self.n else self.start
        begins = np.cumsum([0] + [len(c) + 1 for c in coded[:-1]])
        self.text = np.searchsorted(begins, self.start, "right") - 1
        salts = np.array([xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"), 7) for x in langs], "u8")
        self.salt = salts[self.text]
        self.sums = [Polynomial(self._words(letters, base), base) for base in BASES]

    def _words(self, letters: np.ndarray, base: int) -> np.ndarray:
        h = Polynomial(letters.astype("u8") + np.uint64(1), base).runs(self.start, self.end)
        for i in np.flatnonzero(self.end - self.start > LONG_WORD):
            h[i] = xxhash.xxh64_intdigest(self.data[self.start[i] : self.end[i]], base)
        with np.errstate(over="ignore"):
            return _mixed(h + (self.end - self.start).astype("u8"))

    def places(self, length: int) -> np.ndarray:
        """Of the n-grams of this length that lie within a piece, the first words' places."""
        last = self.n - length + 1
        return np.flatnonzero(self.piece[:last] == self.piece[length - 1 :]) if last > 0 else np.empty(0, "i8")

    def at(self, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Both fingerprints of the n-grams that begin there."""
        with np.errstate(over="ignore"):
            salt = _mixed(self.salt[places] + np.uint64(length))
        first, second = (_mixed(s.runs(places, places + length) ^ salt) for s in self.sums)
        return first >> np.uint64(64 - self.bits), second

    def none(self) -> tuple[np.ndarray, np.ndarray]:
        """Both fingerprints of the phrase without words, once for each word of its language."""
        return _mixed(self.salt) >> np.uint64(64 - self.bits), _mixed(self.salt ^ np.uint64(BASES[1]))

    def phrase(self, place: int, length: int) -> str:
        words = zip(self.start[place : place + length], self.end[place : place + length])
        return b" ".join([self.data[a:b] for a, b in words]).decode("utf-8", "surrogatepass")


def fingerprints(batches, bits: int):
    """Fingerprints of some texts together, and the texts' hashes."""
    for batch in batches:
        for part in slices(batch, TOGETHER):
            texts, langs = part.column("text").to_pylist(), part.column("lang").to_pylist()
            yield Fingerprints(texts, langs, bits), part.column("text_hash").to_numpy()


def texts_with_lang(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    return docs.where(col(text_col).isNotNull()).select(
        col(id_col).alias("doc_id"),
        col(text_col).alias("text"),
        F.coalesce(col(lang_col), F.lit("und")).alias("lang"),
        F.xxhash64(col(text_col)).alias("text_hash"),
    )


COUNTS = "fp bigint, n bigint, low bigint, high bigint, text_hash bigint"


def counted(texts: DataFrame, length: int, bits: int, parts: BitTable | None = None) -> DataFrame:
    """``fp, n, low, high, text_hash`` of the n-grams of ``length`` words, summed.

    ``low`` and ``high`` are the least and the largest second fingerprint met with the
    first, ``text_hash`` points to a text that has it. With ``parts`` only n-grams count
    whose beginning and end, one word shorter, may be in that table. Beside single
    words the phrase without words is counted: its occurrences are its language's words.
    """

    def count(batches):
        for grams, hashes in fingerprints(batches, bits):
            at = grams.places(length)
            if parts is not None:
                at = at[parts.may_have(grams.at(at, length - 1)[0])]
                at = at[parts.may_have(grams.at(at + 1, length - 1)[0])]
            fp, check = grams.at(at, length)
            if length == 1:
                fp, check = (np.concatenate(x) for x in zip((fp, check), grams.none()))
                at = np.concatenate([at, np.arange(grams.n)])
            order = np.argsort(fp, kind="stable")
            fp, check, text = fp[order], check[order].view("i8"), hashes[grams.text[at[order]]]
            begin = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]])) if len(fp) else np.empty(0, "i8")
            columns = [
                pa.array(fp[begin].view("i8")),
                pa.array(np.diff(np.append(begin, len(fp)))),
                *(pa.array(f.reduceat(x, begin) if len(begin) else x) for f, x in ((np.minimum, check), (np.maximum, check), (np.minimum, text))),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["fp", "n", "low", "high", "text_hash"])

    sums = (F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("text_hash").alias("text_hash"))
    return texts.mapInArrow(count, COUNTS).groupBy("fp").agg(*sums)


EXACT = "fp bigint, check bigint, phrase string, n bigint, text_hash bigint"


def told_apart(texts: DataFrame, mixed: DataFrame, length: int, bits: int) -> DataFrame:
    """``fp, check, n, text_hash`` of the fingerprints ``mixed``, counted anew by their words."""
    table = BitTable(mixed, "fp")

    def count(batches):
        for grams, hashes in fingerprints(batches, bits):
            at = grams.places(length)
            at = at[table.may_have(grams.at(at, length)[0])]
            fp, check = grams.at(at, length)
            phrases = [grams.phrase(p, length) for p in at.tolist()]
            if length == 1:
                (fp, check), phrases = (np.concatenate(x) for x in zip((fp, check), grams.none())), phrases + [""] * grams.n
                at = np.concatenate([at, np.arange(grams.n)])
            found: dict[tuple, list] = {}
            for *key, p in zip(fp.view("i8").tolist(), check.view("i8").tolist(), phrases, at.tolist()):
                entry = found.setdefault(tuple(key), [0, 0])
                entry[0] += 1
                entry[1] = int(hashes[grams.text[p]])
            rows = [(*k, *v) for k, v in found.items()]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["fp", "check", "phrase", "n", "text_hash"])

    rows = texts.mapInArrow(count, EXACT).join(mixed.select("fp"), "fp", "left_semi")
    per = rows.groupBy("fp", "check", "phrase").agg(F.sum("n").alias("n"), F.min("text_hash").alias("text_hash"))
    once = per.groupBy("fp", "check").agg(F.sum("n").alias("n"), F.min("text_hash").alias("text_hash"), F.count("*").alias("texts"))
    both = F.raise_error(F.lit("two phrases share both fingerprints")).cast("bigint")
    return once.select("fp", "check", F.when(F.col("texts") == 1, F.col("n")).otherwise(both).alias("n"), "text_hash")


def frequent(texts: DataFrame, least: int, bits: int) -> list[DataFrame]:
    """By length ``fp, check, n, text_hash`` of n-grams with ``least`` occurrences or more.

    Parts of a frequent phrase are as frequent, so longer n-grams are counted only
    where both parts may be.
    """
    out, table = [], None
    for length in range(1, LONGEST + 1):
        found = stored(counted(texts, length, bits, table).where(F.col("n") >= least), "phrase-counts")
        plain = found.where("low = high").select("fp", F.col("low").alias("check"), "n", "text_hash")
        mixed = found.where("low < high")
        if mixed.take(1):
            plain = stored(plain.union(told_apart(texts, mixed, length, bits).where(F.col("n") >= least)), "phrase-apart")
        out.append(plain)
        if length < LONGEST:
            table = BitTable(plain, "fp")
    return out


PHRASES = "fp bigint, check bigint, a bigint, lang string, phrase string, parts array<struct<fp:bigint,check:bigint>>, whole bigint"


def materialised(texts: DataFrame, wanted: DataFrame, bits: int) -> DataFrame:
    """``fp, check, a, lang, phrase, parts, whole`` of ``fp, check, n, text_hash``: the words, read where they stand.

    A text is read once for all phrases that point to it, and of equal texts one. The
    fingerprints found there are those wanted, so a pointer cannot lead to other
    words. ``parts`` are the first and the last words of each cut, in order, ``whole`` is
    the second fingerprint of its language's phrase without words.
    """
    per = wanted.groupBy("text_hash").agg(F.collect_list(F.struct("fp", "check", "n")).alias("wanted"))
    one = texts.groupBy("text_hash", "lang").agg(F.min("doc_id").alias("id")).join(per, "text_hash")
    one = one.withColumnsRenamed({"text_hash": "hash", "lang": "own"})
    same = (F.col("text_hash") == F.col("hash")) & (F.col("lang") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("id"))
    met = texts.join(one, same).select("text", "lang", "wanted")

    def read(batches):
        for batch in batches:
            out: list[tuple] = []
            for text, lang, asked in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "wanted"))):
                left = {(w["fp"], w["check"]): w["n"] for w in asked}
                firsts = np.array([k for k, _ in left], "i8").view("u8")
                grams = Fingerprints([text], [lang], bits)
                whole = int(grams.none()[1].view("i8")[0])
                for length in range(2, LONGEST + 1):
                    at = grams.places(length)
                    fp, check = grams.at(at, length)
                    hit = np.isin(fp, firsts)
                    at, keys = at[hit], list(zip(fp[hit].view("i8").tolist(), check[hit].view("i8").tolist()))
                    cuts = [side for k in range(1, length) for side in (grams.at(at, k), grams.at(at + k, length - k))]
                    cuts = [(f.view("i8").tolist(), c.view("i8").tolist()) for f, c in cuts]
                    for i, (place, key) in enumerate(zip(at.tolist(), keys)):
                        n = left.pop(key, None)
                        if n is not None:
                            parts = [{"fp": f[i], "check": c[i]} for f, c in cuts]
                            out.append((*key, n, lang, grams.phrase(place, length), parts, whole))
            part = pa.list_(pa.struct([("fp", pa.int64()), ("check", pa.int64())]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), part, pa.int64())
            columns, names = list(zip(*out)) or [()] * 7, ["fp", "check", "a", "lang", "phrase", "parts", "whole"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    # Rows of one id, language and text are read each; they give the same.
    return met.mapInArrow(read, PHRASES).dropDuplicates(["fp", "check"])


def score(a: Column, left: Column, right: Column) -> Column:
    """``floor(SCALE * a * a / (left * right))`` in integers of 38 digits."""
    big = [x.cast("decimal(15,0)") for x in (a, left, right)]
    top, low = (big[0] * big[0] * F.lit(SCALE).cast("decimal(7,0)")).alias("top"), (big[1] * big[2]).alias("low")
    return F.get(F.transform(F.array(F.struct(top, low)), lambda x: F.call_function("div", x["top"], x["low"])), F.lit(0))


def collocations(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    top: int = TOP,
    share: int = SHARE,
    bits: int = BITS,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of two or three words.

    Words lie between blanks and tabs, A-Z lower-cased; marks of punctuation and line
    breaks part pieces, and a phrase lies in one. A phrase occurs ``a`` times, ``least``
    or more; cut in two its parts occur ``l`` and ``r`` times, and the cut with the
    lowest score counts, the first of equals. A phrase inside a longer one that has
    ``share`` hundredths of its occurrences is left out. ``n`` is the language's words.

    Null texts have no words, a null language is ``und``, ids may be null or shared.
    An empty table gives an empty result.
    """
    texts = texts_with_lang(docs, id_col, text_col, lang_col)
    counts = frequent(texts, least, bits)
    every = stored(counts[0].unionByName(counts[1]).unionByName(counts[2]), "phrase-every")
    wanted = counts[1].unionByName(counts[2])
    found = stored(materialised(texts, wanted, bits), "phrase-words")
    if found.count() != wanted.count():
        raise RuntimeError("a frequent phrase is not where its pointer leads")
    parts = found.select("fp", "check", F.posexplode("parts").alias("place", "part"))
    parts = parts.select("fp", "check", "place", F.col("part.fp").alias("part_fp"), F.col("part.check").alias("part_check"))
    known = every.select(F.col("fp").alias("part_fp"), F.col("check").alias("part_check"), "n")
    sums = parts.join(known, ["part_fp", "part_check"]).groupBy("fp", "check")
    sums = sums.agg(*[F.max(F.when(F.col("place") == i, F.col("n"))).alias(f"n{i}") for i in range(4)])
    long = found.where(F.size("parts") == 4).select("a", F.explode(F.slice("parts", 2, 2)).alias("part"))
    long = long.groupBy(F.col("part.fp").alias("fp"), F.col("part.check").alias("check")).agg(F.max("a").alias("longer"))
    rows = found.select("fp", "check", "a", "lang", "phrase", "whole").join(sums, ["fp", "check"]).join(long, ["fp", "check"], "left")
    rows = rows.where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))

    def cut(k: int) -> Column:
        left, right = F.col(f"n{2 * k}"), F.col(f"n{2 * k + 1}")
        made = F.struct(score(F.col("a"), left, right).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))
        return F.when(left.isNotNull(), made)

    scored = rows.withColumn("cut", F.least(cut(0), cut(1)))
    scored = scored.select("lang", "phrase", "whole", "a", "cut.l", "cut.r", "cut.score", F.pmod("fp", F.lit(PARTS)).alias("part"))

    def ranked(rows: DataFrame, *by: str) -> DataFrame:
        order = Window.partitionBy("lang", *by).orderBy(F.desc("score"), F.desc("a"), "phrase")
        return rows.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)

    # The best of each part first, so that no task sorts all phrases of one language.
    best = ranked(ranked(scored, "part"))
    # One row for each language, whose second fingerprint no n-gram is mixed with.
    words = counts[0].select(F.col("check").alias("whole"), "n")
    return best.join(words, "whole").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
