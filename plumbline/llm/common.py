"""Column helpers, worker caches and tokenizers shared by the operators."""

from __future__ import annotations

import os
import re
import sys
import types
from collections.abc import Callable
from itertools import chain, compress
from operator import not_

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline.session import scratch_path

# A word is a run of anything but the six ASCII spaces.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def col(name: str) -> Column:
    """A column by its plain name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` with null texts as empty; extra columns cannot clash any more."""
    return docs.select(col(id_col).alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text"))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Written once below ``spark.checkpoint.dir`` and read back."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worker_state(name: str, make: Callable[[], object]) -> object:
    """An object kept by a Python worker for all its tasks, made at first use."""
    kept = sys.modules.setdefault("_llm_worker_state", types.ModuleType("_llm_worker_state")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of whole texts, equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    Both vocabularies here split a text at white space before they merge, so a
    text's ids are those of its pieces, a piece being a word with the white space
    before it (``keep_space``) or a word alone. A worker keeps the ids of the first
    ``CACHE`` pieces it encodes twice, which are the frequent ones; the library encodes
    all others anew, thousands in one text. Most are Latin letters with or without
    signs behind them and a line break before, which the library tells apart, so signs
    are looked up and letters are given to its model as the vocabulary spells their
    bytes, without expressions and normalisers; where a word ends is seen by its ids.
    Other pieces have a mark between them. Texts with a special token's string or a
    control character that may be mistaken, where this would not hold, are given to
    the library whole.

    Pieces go by short names: a word that one space precedes, or a line break and
    the word after it, is its own name; any other has ``MARK`` before it.
    """

    # Entries of about 200 bytes each.
    CACHE = 500_000
    LONGEST = 64
    # Hashes of pieces that were encoded once: bytes, of which two pieces may share one.
    SEEN = 1 << 22
    # Latin-1 letters, which are the same composed, and in lower case in Python as in the library.
    WORD = re.compile("(\n?)([A-Za-zÀ-ÖØ-öø-ÿ]{1,64})([].,;:!?)}\"*%#$&|<>]{0,3})").fullmatch
    # What both vocabularies write for the bytes of these letters that are no printable Latin-1 character.
    SPELT = np.array([0x122 + b - 0x80 if 0x80 <= b <= 0xA0 else 0x143 if b == 0xAD else b for b in range(256)], "<u2")
    TRIAL = "the Of dÉjà Straße x ÀÿÞ QUITE internationalisation zzqxj"
    MARK = "\x01"
    ODD = "\x01\x1c\x1d\x1e\x1f"
    # White space other than blanks and line breaks.
    RARE = "\t\x0b\x0c\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
    RUNS = ("  ", " \n", "\n ", "\n\n")

    def __init__(self, path: str, dtype: str, keep_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.dtype, self.keep_space = dtype, keep_space
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.find = re.compile(r"\s*\S+|\s+").findall
        self.between = f" {self.MARK}" if keep_space else f" {self.MARK} "
        *self.before, self.mark = self._whole([self.between])[0]
        self.cache: dict[str, bytes] = {}
        self.seen = bytearray(self.SEEN)
        self.signs: dict[str, bytes] = {"": b""}
        self.plain, self.edge = self._plain(path)
        words = self.TRIAL.split(" ")
        trial = self._letters(words if keep_space else [w.lower() for w in words])
        # Vocabularies that do not split in this way have all pieces marked.
        self.simple = trial is not None and trial == [self._bytes(self._whole([" " + w if keep_space else w])[0]) for w in words]
        if keep_space:
            self.simple &= self._begun(words) == [self._bytes(self._whole(["\n" + w])[0]) for w in words]

    def _plain(self, path: str):
        """The same model for spelt words with blanks between, and which ids are a word's first (``keep_space``) or last."""
        from tokenizers import Tokenizer, pre_tokenizers as P

        plain = Tokenizer.from_file(path)
        plain.normalizer = None
        plain.pre_tokenizer = P.CharDelimiterSplit(" ")
        edge = np.zeros(1 + max(plain.get_vocab().values()), bool)
        for token, i in plain.get_vocab().items():
            edge[i] = token[0] == "Ġ" if self.keep_space else token.endswith("</w>")
        return plain, edge

    def _spelt(self, words: str) -> str:
        """Letters as the vocabulary spells their bytes."""
        return words if words.isascii() else self.SPELT[np.frombuffer(words.encode(), "u1")].tobytes().decode("utf-16-le")

    def _letters(self, words: list[str]) -> list[bytes] | None:
        """Ids of words of letters, or none if the ids do not tell the words apart."""
        joined = self._spelt(" ".join(words))
        if self.keep_space:
            joined = "Ġ" + joined.replace(" ", " Ġ")
        found = self.plain.encode_batch_fast([joined], add_special_tokens=False)
        ids = np.asarray(found[0].ids, self.dtype)
        at = np.flatnonzero(self.edge[ids])
        if len(at) != len(words):
            return None
        cuts = [*at.tolist(), len(ids)] if self.keep_space else [0, *(at + 1).tolist()]
        raw, width = ids.tobytes(), ids.itemsize
        return [raw[a * width : b * width] for a, b in zip(cuts, cuts[1:])]

    def _begun(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters with a line break before each."""
        found = self.plain.encode_batch_fast(self._spelt(" ".join(words)).split(), add_special_tokens=False)
        return [self._signs("\n") + self._bytes(e.ids) for e in found]

    def _signs(self, signs: str) -> bytes:
        if signs not in self.signs:
            self.signs[signs] = self._bytes(self._whole([signs])[0])
        return self.signs[signs]

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _bytes(self, ids) -> bytes:
        return np.asarray(ids, self.dtype).tobytes()

    def _named(self, piece: str) -> str:
        if piece[0] in " \n" and len(piece) > 1 and not piece[1].isspace():
            return piece[1:] if piece[0] == " " else piece
        return self.MARK + piece

    def pieces(self, text: str) -> list[str]:
        """Names of the pieces of a text without control characters."""
        if not self.keep_space:
            return text.split()
        plain = text and text[0] not in " \n" and text[-1] not in " \n" and not any(c in text for c in self.RARE)
        if not plain or any(r in text for r in self.RUNS):
            return [self._named(p) for p in self.find(text)]
        names = text.replace("\n", " \n").split(" ")
        names[0] = self.MARK + names[0]
        return names

    def _encode(self, names: list[str]) -> dict[str, bytes]:
        """Ids of pieces, each by itself, and of the words of letters in them."""
        if not self.simple:
            return self._marked(names)
        out, odd, split, begun, fresh = {}, [], [], [], {}
        match, known, folded = self.WORD, self.cache.get, not self.keep_space
        for n in names:
            m = match(n)
            if m is None:
                odd.append(n)
                continue
            line, word, signs = m.groups()
            if folded:
                word = word.lower()
            if line:
                begun.append((n, word, signs))
                continue
            if word == n:
                fresh[n] = None
                continue
            split.append((n, word, signs))
            ids = known(word)
            if ids is None:
                fresh[word] = None
            else:
                out[word] = ids
        if fresh:
            out.update(zip(fresh, self._letters(list(fresh)), strict=True))
        for n, word, signs in split:
            out[n] = out[word] + self._signs(signs) if signs else out[word]
        for (n, _, signs), ids in zip(begun, self._begun([word for _, word, _ in begun])):
            out[n] = ids + self._signs(signs)
        if odd:
            out.update(self._marked(odd))
        return out

    def _keep(self, found: dict[str, bytes]) -> None:
        """Pieces that were met before are kept while there is room."""
        seen, mask = self.seen, self.SEEN - 1
        for n, ids in found.items():
            at = hash(n) & mask
            if not seen[at]:
                seen[at] = 1
            elif len(n) <= self.LONGEST and len(self.cache) < self.CACHE:
                self.cache[n] = ids

    def _marked(self, names: list[str]) -> dict[str, bytes]:
        """Ids of any pieces."""
        out = {}
        together = [n for n in names if n[0] != self.MARK]
        if together:
            if self.keep_space:
                joined = "".join([(n if n[0] == "\n" else " " + n) + self.between for n in together])
            else:
                joined = "".join([n + self.between for n in together])
            ids = np.asarray(self._whole([joined])[0], self.dtype)
            ends = np.flatnonzero(ids == self.mark)
            begins = np.concatenate([[0], ends[:-1] + 1])
            raw, width = ids.tobytes(), ids.itemsize
            ends = (ends - len(self.before)) * width
            for n, a, b in zip(together, (begins * width).tolist(), ends.tolist(), strict=True):
                out[n] = raw[a:b]
        alone = [n for n in names if n[0] == self.MARK]
        out.update(zip(alone, map(self._bytes, self._whole([n[1:] for n in alone]))))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian bytes of the given type."""
        apart = [*self.ODD, *self.special]
        whole = [any(s in t for s in apart) for t in texts]
        named = [[] if w else self.pieces(t) for t, w in zip(texts, whole)]
        names = list(chain.from_iterable(named))
        ids = list(map(self.cache.get, names))
        # Pieces without ids are looked up anew.
        missing = list(compress(range(len(ids)), map(not_, ids)))
        fresh = list(dict.fromkeys(map(names.__getitem__, missing)))
        found: dict[str, bytes] = {}
        for i in range(0, len(fresh), 4096):
            found.update(self._encode(fresh[i : i + 4096]))
        for i in missing:
            ids[i] = found[names[i]]
        out, at = [], 0
        for t, w, ps in zip(texts, whole, named):
            out.append(self._bytes(self._whole([t])[0]) if w else b"".join(ids[at : at + len(ps)]))
            at += len(ps)
        if len(self.cache) < self.CACHE:
            self._keep(found)
        return out


def encoder(path: str, dtype: str, keep_space: bool) -> WordEncoder:
    """The worker's encoder for this vocabulary file."""
    return worker_state(f"{path} {dtype} {keep_space}", lambda: WordEncoder(path, dtype, keep_space))


def slices(batch, most: int = 1_000_000):
    """An Arrow batch in runs of rows whose texts are about ``most`` bytes together."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        size += n
        if size >= most or i + 1 == len(sizes):
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0


class BitTable:
    """A table of bits with one set for each of some hash values, for the tasks.

    Others may share a bit, so it only tells which are certainly not among them. It
    has ``ROOM`` bits for each value, up to 64 MB; beyond that it tells less.
    """

    ROOM = 16
    MOST = 1 << 29

    def __init__(self, rows: DataFrame, column: str):
        want = rows.count() * self.ROOM
        size = min(self.MOST, max(1 << 16, 1 << max(0, want - 1).bit_length()))
        self.mask = np.uint64(size - 1)
        slot = F.col(column).bitwiseAND(F.lit(size - 1))
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), slot.bitwiseAND(F.lit(63)).cast("int"))
        # At most one row for each word of the table.
        found = rows.groupBy(F.shiftright(slot, 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
        words = np.zeros(size // 64, "i8")
        words[found.column("at").to_numpy()] = found.column("bits").to_numpy()
        self.words = rows.sparkSession.sparkContext.broadcast(words)

    def may_have(self, values: np.ndarray) -> np.ndarray:
        slot = values & self.mask
        word = self.words.value.view("u8")[slot >> np.uint64(6)]
        return (word >> (slot & np.uint64(63))) & np.uint64(1) == 1


__all__ = [
    "BitTable",
    "SPACE",
    "WORD",
    "WordEncoder",
    "col",
    "documents",
    "encoder",
    "scratch_path",
    "slices",
    "stored",
    "texts_of",
    "tokenizer_path",
    "words",
    "worker_state",
]
