"""Token ids in raw shard files with a minimal perfect hash index.

A shard file is the ids of its documents, back to back and each ended by the end
id, as little-endian unsigned integers of 2 bytes (4 for larger vocabularies),
then a footer record: keys (8 bytes each), null flags (1), lengths (4), the number
of documents (4), the shard number (4) and the magic bytes. Spark's text writer
writes the files, the end id being its line separator, so any file system that
Spark reaches will do; ``binaryFile`` reads them back.

The index maps a key to (shard, offset, length). Keys are hashed to buckets of
bounded size, one row each. A bucket has one slot per key and no more: a key's
group names a pilot, the pilot shifts the key's hash to its slot, and the slot has
a fingerprint of the key next to the address. A look-up reads one pilot and one
slot, and a key that is not in the index fails the fingerprint but for one in 2^32.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from plumbline.llm.common import encoder, scratch_path, slices, stored, texts_of, tokenizer_path

MAGIC = b"IDSHARD1"
KEYS_PER_BUCKET = 8_192
KEYS_PER_GROUP = 4
RECORD = "key bigint, shard int, place int, offset bigint, n_tokens bigint, ids_crc32 bigint"


def id_type(width: int) -> str:
    return {2: "<u2", 4: "<u4"}[width]


def write_shards(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    end_id: int = 0,
    width: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every whole text and write the shards in ascending key order.

    Keys are integers; null keys come first, equal keys in the order of their texts.
    Texts are range-partitioned by key and text hash, so that one key with many rows
    spreads, and a shard is one such partition.
    """
    dtype = id_type(width)

    def encode(batches):
        enc = encoder(vocabulary, dtype, True)
        keys, nulls, lengths = [], [], []
        for batch in batches:
            for part in slices(batch):
                ids = enc.encode(part.column("text").to_pylist())
                for k, x in zip(part.column("doc_id").to_pylist(), ids):
                    keys.append(0 if k is None else k)
                    nulls.append(k is None)
                    lengths.append(len(x) // width + 1)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["payload"])
        footer = (
            np.array(keys, "<i8").tobytes()
            + np.array(nulls, "u1").tobytes()
            + np.array(lengths, "<u4").tobytes()
            + np.array([len(keys), TaskContext.get().partitionId()], "<u4").tobytes()
            + MAGIC
        )
        yield pa.RecordBatch.from_arrays([pa.array([footer], pa.binary())], ["payload"])

    rows = texts_of(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    payload = ordered.select("doc_id", "text").mapInArrow(encode, "payload binary")
    end = np.array([end_id], dtype).tobytes().decode("ascii")
    payload.select(F.col("payload").cast("string").alias("value")).write.option("lineSep", end).text(folder)


def parse_shard(content: bytes, width: int):
    """``shard, keys, nulls, offsets, lengths, ids`` of a shard file."""
    body = memoryview(content)[:-width]
    assert bytes(body[-8:]) == MAGIC, "not a shard file"
    n, shard = np.frombuffer(body[-16:-8], "<u4")
    n, end = int(n), len(body) - 16
    lengths = np.frombuffer(body[end - 4 * n : end], "<u4").astype("i8")
    nulls = np.frombuffer(body[end - 5 * n : end - 4 * n], "u1").astype(bool)
    keys = np.frombuffer(body[end - 13 * n : end - 5 * n], "<i8")
    ids = np.frombuffer(body[: end - 13 * n], id_type(width))
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("i8")
    assert offsets[-1] == len(ids), "the footer does not match the ids"
    return int(shard), keys, nulls, offsets, lengths, ids


def read_records(spark: SparkSession, folder: str, width: int = 2, payload: bool = False) -> DataFrame:
    """Every document of the files: key, shard, place and offset there, length, digest.

    ``ids_crc32`` is of the ids as little-endian unsigned 32-bit integers, which
    ``payload`` adds as ``ids``.
    """

    def records(batches):
        for batch in batches:
            for content in batch.column("content"):
                shard, keys, nulls, offsets, lengths, ids = parse_shard(content.as_py(), width)
                for lo in range(0, len(keys), 2_000):
                    hi = min(lo + 2_000, len(keys))
                    wide = [ids[offsets[i] : offsets[i + 1]].astype("<u4").tobytes() for i in range(lo, hi)]
                    columns = {
                        "key": pa.array(keys[lo:hi], pa.int64(), mask=nulls[lo:hi]),
                        "shard": pa.array([shard] * (hi - lo), pa.int32()),
                        "place": pa.array(range(lo, hi), pa.int32()),
                        "offset": pa.array(offsets[lo:hi], pa.int64()),
                        "n_tokens": pa.array(lengths[lo:hi], pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(x) for x in wide], pa.int64()),
                    }
                    if payload:
                        columns["ids"] = pa.array(wide, pa.binary())
                    yield pa.RecordBatch.from_pydict(columns)

    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(records, RECORD + (", ids binary" if payload else ""))


def mixed_bits(x: np.ndarray, seed) -> np.ndarray:
    """A 64-bit mix of integers, another one for each seed (one, or one for each integer)."""
    with np.errstate(over="ignore"):
        z = x.astype("u8") + np.asarray(seed, "u8") * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _group(keys: np.ndarray, groups: int) -> np.ndarray:
    return (mixed_bits(keys, 1) % np.uint64(groups)).astype("i8")


def _base(keys: np.ndarray, a, n: int) -> np.ndarray:
    """Another hash of the keys into 0..n-1 for each ``a``."""
    return (mixed_bits(keys, np.asarray(a, "u8") + np.uint64(16)) % np.uint64(n)).astype("i8")


def place_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pilots of the groups and the slot of each key: a bijection onto 0..n-1.

    Groups are placed from large to small. A pilot ``a * n + b`` sends a key to its
    ``a``-th hash plus ``b``, modulo n; a single key always fits the next free slot.
    """
    n = len(keys)
    groups = max(1, -(-n // KEYS_PER_GROUP))
    group = _group(keys, groups)
    pilots, slots, free = np.zeros(groups, "u8"), np.zeros(n, "i8"), np.ones(n, bool)
    order = np.argsort(group, kind="stable")
    bounds = np.searchsorted(group[order], np.arange(groups + 1))
    sizes = np.diff(bounds)
    next_free = 0
    for g in np.argsort(-sizes, kind="stable"):
        members = order[bounds[g] : bounds[g + 1]]
        if len(members) == 0:
            break
        if len(members) == 1:
            while not free[next_free]:
                next_free += 1
            a, b = 0, (next_free - int(_base(keys[members], 0, n)[0])) % n
        else:
            a = 0
            while True:
                base = _base(keys[members], a, n)
                b = -1
                if len(np.unique(base)) == len(base):
                    step = 256
                    for lo in range(0, n, step):
                        fits = free[(base[:, None] + np.arange(lo, min(lo + step, n))) % n].all(axis=0)
                        if fits.any():
                            b = lo + int(fits.argmax())
                            break
                if b >= 0:
                    break
                a += 1
        at = (_base(keys[members], a, n) + b) % n
        slots[members], free[at], pilots[g] = at, False, a * n + b
    return pilots, slots


def find_slots(keys: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    pilot = pilots[_group(keys, len(pilots))].astype("i8")
    return (_base(keys, pilot // n, n) + pilot % n) % n


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed_bits(keys, 4) >> np.uint64(32)).astype("<u4")


INDEX = "bucket bigint, n int, pilots binary, prints binary, shards binary, offsets binary, lengths binary"


def build_index(records: DataFrame, keys_per_bucket: int = KEYS_PER_BUCKET) -> tuple[DataFrame, int]:
    """The index of every non-null key, a row per bucket, and the number of buckets.

    Of records with one key the first in the files is addressed; equal keys are
    reduced to it before the shuffle, so a bucket never gathers copies. The number
    of buckets grows with the number of records.
    """
    total = records.count()
    buckets = max(1, -(-total // keys_per_bucket))
    firsts = (
        records.where("key is not null")
        .groupBy("key")
        .agg(F.min(F.struct("shard", "offset", "n_tokens")).alias("at"))
        .select("key", "at.*", F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"))
    )

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = pdf["key"].to_numpy()
        pilots, slots = place_keys(keys)

        def in_slots(values, dtype):
            out = np.zeros(len(keys), dtype)
            out[slots] = values
            return out.tobytes()

        return pd.DataFrame(
            {
                "bucket": [pdf["bucket"].iloc[0]],
                "n": [len(keys)],
                "pilots": [pilots.astype("<u8").tobytes()],
                "prints": [in_slots(fingerprints(keys), "<u4")],
                "shards": [in_slots(pdf["shard"], "<u4")],
                "offsets": [in_slots(pdf["offset"], "<u8")],
                "lengths": [in_slots(pdf["n_tokens"], "<u8")],
            }
        )

    return firsts.groupBy("bucket").applyInPandas(build, INDEX), buckets


def look_up(keys: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """``key, shard, offset, n_tokens`` of the keys that the index has; others have no row."""
    wanted = keys.select(F.col("key").cast("bigint").alias("key")).where("key is not null").distinct()
    wanted = wanted.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))

    def find(want: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if len(want) == 0 or len(rows) == 0:
            return pd.DataFrame({"key": [], "shard": [], "offset": [], "n_tokens": []}).astype("int64")
        row, asked = rows.iloc[0], want["key"].to_numpy()
        slots = find_slots(asked, np.frombuffer(row["pilots"], "<u8"), int(row["n"]))
        hit = np.frombuffer(row["prints"], "<u4")[slots] == fingerprints(asked)
        slots = slots[hit]
        return pd.DataFrame(
            {
                "key": asked[hit],
                "shard": np.frombuffer(row["shards"], "<u4")[slots].astype("i4"),
                "offset": np.frombuffer(row["offsets"], "<u8")[slots].astype("i8"),
                "n_tokens": np.frombuffer(row["lengths"], "<u8")[slots].astype("i8"),
            }
        )

    return (
        wanted.groupBy("bucket")
        .cogroup(index.groupBy("bucket"))
        .applyInPandas(find, "key bigint, shard int, offset bigint, n_tokens bigint")
    )


def indexed_shards(docs: DataFrame, vocabulary: str | None = None, end_id: int = 0, width: int = 2, **columns):
    """Write shards and index of ``docs``; returns ``folder, records, index, buckets``.

    ``records`` and ``index`` are stored tables. Null texts are empty, an empty text
    has the end id alone, and an empty table gives no records and an empty index.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "id-shards")
    write_shards(docs, folder, vocabulary or tokenizer_path("byte_bpe_50k.json"), end_id, width, **columns)
    records = stored(read_records(spark, folder, width), "id-records")
    index, buckets = build_index(records)
    return folder, records, stored(index, "id-index"), buckets


def addressed_documents(docs: DataFrame, **options) -> DataFrame:
    """Per document, from its files: ``doc_id, start, n_tokens, ids_crc32, shard, offset, indexed``.

    Every key is looked up in the index and its record read at that address.
    ``start`` counts the ids of all documents before it. A null key or a further
    record of a key is not addressed by the index (``indexed`` false) and comes
    from reading the file in order.
    """
    _, records, index, buckets = indexed_shards(docs, **options)
    hits = look_up(records.select("key"), index, buckets).withColumnRenamed("key", "hit_key")
    totals = records.groupBy("shard").agg(F.sum("n_tokens").alias("ids"))
    earlier = Window.partitionBy(F.lit(1)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("base"))
    hits = hits.withColumnRenamed("n_tokens", "hit_tokens")
    found = records.join(hits, ["shard", "offset"], "left").join(bases, "shard")
    return found.select(
        F.col("key").alias("doc_id"),
        (F.col("base") + F.col("offset")).alias("start"),
        F.coalesce("hit_tokens", "n_tokens").alias("n_tokens"),
        "ids_crc32",
        "shard",
        "offset",
        F.coalesce(F.col("hit_key") == F.col("key"), F.lit(False)).alias("indexed"),
    )
