"""Packing token pieces into sequences by bin completion."""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from plumbline.llm.common import encoder, slices, stored, texts_of, tokenizer_path

CAPACITY = 4096
# Nodes of one branch-and-bound search; a table of sums ends longer ones with the same filling.
NODES = 3_000
PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids binary, part int, place bigint"


def token_pieces(
    docs: DataFrame,
    vocabulary: str | None = None,
    end_id: int = 1,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Ids of every whole text and the end id, cut only where longer than ``capacity``.

    ``doc_id, piece, start, length, ids`` (little-endian unsigned 32-bit integers),
    and for packing ``part, place``: the task and the piece's rank among the pieces
    of its length there. Stored, so that ranks hold still.
    """
    vocabulary = vocabulary or tokenizer_path("word_bpe_49k.json")
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        enc = encoder(vocabulary, "<u4", False)
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            for rows in slices(batch):
                out = []
                for k, ids in zip(rows.column("doc_id").to_pylist(), enc.encode(rows.column("text").to_pylist())):
                    ids += end
                    for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[at : at + 4 * capacity]
                        n = len(piece) // 4
                        place = seen.get(n, 0)
                        seen[n] = place + 1
                        out.append((k, i, at // 4, n, piece, part, place))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
                columns = zip(*out) if out else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)],
                    ["doc_id", "piece", "start", "length", "ids", "part", "place"],
                )

    return stored(texts_of(docs, id_col, text_col).mapInArrow(cut, PIECE), "token-pieces", "zstd")


def filling_from_sums(room: int, lengths: list[int], counts: dict[int, int]) -> list[tuple[int, int]]:
    """What ``best_filling`` returns, from the sums that the shorter lengths can reach.

    The sums are bits of one integer for each length, so the table has ``room`` bits
    times the number of lengths. Walked from the longest length down, most copies first.
    """
    lengths = lengths[: bisect_right(lengths, room)]
    reached, whole = [1], (1 << room + 1) - 1
    for size in lengths:
        sums, more, step = reached[-1], min(counts[size], room // size), 1
        while more:
            step = min(step, more)
            sums |= sums << step * size & whole
            more -= step
            step *= 2
        reached.append(sums)
    total, out = reached[-1].bit_length() - 1, []
    for below, size in zip(reached[-2::-1], reversed(lengths)):
        most = min(counts[size], total // size)
        k = next(k for k in range(most, -1, -1) if below >> total - k * size & 1)
        if k:
            out.append((size, k))
            total -= k * size
    return out


def best_filling(room: int, lengths: list[int], counts: dict[int, int], nodes: int = NODES) -> list[tuple[int, int]]:
    """The lengths, with how many of each, that leave the least of ``room``.

    Depth first from long to short, most copies of a length first, so the first
    leaf is the best-fit incumbent. A branch ends when nothing more fits, and is
    left when even the rest of its lengths could not bring its waste below the
    incumbent's. No waste ends the search. Of fillings with the least waste the one
    with the longest lengths is met first and stands, so that no other dominates it:
    joining pieces of a filling to longer ones gives one that is met before it. A
    search of more than ``nodes`` nodes is ended by the table, whose filling is the same.
    """
    best, best_waste, left = [], room, nodes
    chosen: list[tuple[int, int]] = []
    smallest = lengths[0] if lengths else room + 1
    total_below = {}

    def search(room: int, top: int) -> None:
        nonlocal best, best_waste, left
        left -= 1
        if room < best_waste:
            best, best_waste = list(chosen), room
        at = bisect_right(lengths, room, 0, top) - 1
        while at >= 0 and best_waste and left > 0 and room >= smallest:
            size = lengths[at]
            # All that is left from here on, if it fits as a whole, must beat the incumbent.
            reach = below(at)
            if room - reach >= best_waste:
                return
            for k in range(min(counts[size], room // size), 0, -1):
                chosen.append((size, k))
                search(room - k * size, at)
                chosen.pop()
                if not best_waste or left <= 0:
                    return
            at -= 1

    def below(at: int) -> int:
        if at not in total_below:
            total, i = 0, at
            while i >= 0 and total < room:
                total += lengths[i] * counts[lengths[i]]
                i -= 1
            total_below[at] = total
        return total_below[at]

    search(room, len(lengths))
    return filling_from_sums(room, lengths, counts) if best_waste and left <= 0 else best


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> dict[str, np.ndarray]:
    """Fillings for all pieces, from the number of pieces of each length.

    Each round takes the longest length left and its best filling, as many times as
    the counts allow, so a round uses up at least one length's stock at that
    multiple and the work depends on ``capacity``, not on the number of pieces.
    Returns sorted intervals: pieces of ``length`` with ranks from ``rank`` on go,
    ``per`` to a sequence, to sequences from ``first`` on, at ``offset``.
    """
    counts = {n: c for n, c in histogram.items() if c > 0}
    lengths = sorted(counts)
    used = dict.fromkeys(counts, 0)
    rows, sequence = [], 0
    while lengths:
        longest = lengths[-1]
        counts[longest] -= 1
        others = lengths if counts[longest] else lengths[:-1]
        take = dict(best_filling(capacity - longest, others, counts, nodes))
        counts[longest] += 1
        take[longest] = take.get(longest, 0) + 1
        times = min(counts[n] // k for n, k in take.items())
        offset = 0
        for n, k in sorted(take.items(), reverse=True):
            rows.append((n, used[n], sequence, k, offset))
            used[n] += k * times
            offset += n * k
            counts[n] -= k * times
            if not counts[n]:
                del counts[n]
                lengths.remove(n)
        sequence += times
    rows.sort()
    names = ["length", "rank", "first", "per", "offset"]
    return {name: np.array([r[i] for r in rows], "i8") for i, name in enumerate(names)}


def pack(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to stored pieces with ``length, part, place``.

    The driver gets the histogram of lengths, at most ``capacity`` rows whatever the
    number of pieces, and sends back the plan's intervals, whose number depends on
    ``capacity`` too. A piece's rank among all pieces of its length is its place in
    its task plus the number in earlier tasks; then a binary search finds its
    interval. No length, however common, is one task's work. An empty table gives
    an empty result.
    """
    spark = pieces.sparkSession
    per_task = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    per_task = stored(per_task, "piece-counts")
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_sequences(histogram, capacity, nodes)
    sent = spark.sparkContext.broadcast(plan)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    kept = [c for c in pieces.columns if c not in ("part", "place")]
    ranked = pieces.join(bases, ["length", "part"]).select(*kept, (F.col("base") + F.col("place")).alias("rank"))
    fields = [f for f in ranked.schema.fields if f.name != "rank"]
    shift = 44

    def place(batches):
        p = sent.value
        starts = (p["length"] << shift) + p["rank"]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            i = np.searchsorted(starts, (length << shift) + rank, "right") - 1
            nth = rank - p["rank"][i]
            columns = [batch.column(f) for f in kept]
            columns.append(pa.array(p["first"][i] + nth // p["per"][i], pa.int64()))
            columns.append(pa.array(p["offset"][i] + nth % p["per"][i] * length, pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, [*kept, "sequence_id", "offset"])

    added = [StructField(name, LongType()) for name in ("sequence_id", "offset")]
    return ranked.mapInArrow(place, StructType([*fields, *added]))


def packed_documents(docs: DataFrame, capacity: int = CAPACITY, ids: bool = True, **options) -> DataFrame:
    """Per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, and ``ids``.

    Null texts are empty; an empty text is its end id. Rows may share ids: each is a
    document of its own.
    """
    pieces = token_pieces(docs, capacity=capacity, **options)
    wanted = ["doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), *(["ids"] if ids else [])]
    return pack(pieces.select(*wanted, "part", "place"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, n_tokens, ids``: the pieces of each sequence, in order, as one binary.

    A sequence has at most ``capacity`` tokens, which bounds the groups.
    """
    return (
        packed.groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "length", "ids"))).alias("p"))
        .select(
            "sequence_id",
            F.aggregate("p", F.lit(0).cast("bigint"), lambda a, x: a + x["length"]).alias("n_tokens"),
            F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
        )
    )
