"""Random forests over wide sparse vectors, grown level by level.

Spark's trees keep a row as one integer for each feature, 64 KB at a width of 2^14.
Here a row is the features it holds: what a node counts are those, and a feature's
zeros are what is left of the node's total. The rules are Spark's: Poisson bags, a
random subset of features for each node, weighted Gini gain, leaves that predict the
same joined. Only the draws differ.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, functions as F

from plumbline.session import cut_lineage, scratch_path

# Workers need not be able to import what they run.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of Spark's rows from which sparse ones are used, and how much narrower they must be.
DENSE_BYTES = 2**30
NARROWER = 16
# Bounds of a worker's tables: bytes of a batch of rows and of the nodes' features, and counts held before they are added up.
BATCH_BYTES = 2**24
NODE_BYTES = 2**25
HELD = 2_000_000
# Gains below are rounding.
NO_GAIN = 1e-12

COUNTS = "slot int, feature int, bin int, label int, weight double, rows long"
SPLITS = "slot int, feature int, bin int, gain double, total array<double>, total_rows array<long>, first array<double>, first_rows array<long>"


def _held(df: DataFrame):
    """Features and values that a row's vector holds, as two arrays."""
    v = F.unwrap_udt("features")
    return F.coalesce(v["indices"], F.transform(v["values"], lambda _, i: i)), v["values"]


def prefers_sparse(train: DataFrame, width: int) -> bool:
    """If Spark's rows are large, and what rows hold is far less."""
    rows, held = train.agg(F.count("*"), F.sum(F.size(_held(train)[1]))).first()
    return rows * width * 4 > DENSE_BYTES and rows * width > NARROWER * held


@dataclass
class Bins:
    """The values of each feature in order, 0 included if a row has it; ``zero`` is its place."""

    values: np.ndarray
    start: np.ndarray
    zero: np.ndarray

    def place(self, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        low, high = self.start[feature], self.start[feature + 1] - 1
        while (low < high).any():
            middle = (low + high) // 2
            above = self.values[middle] < value
            low, high = np.where(above, middle + 1, low), np.where(above, high, middle)
        return low - self.start[feature]

    def threshold(self, feature: int, place: int) -> float:
        at = self.start[feature] + place
        return float(self.values[at] / 2 + self.values[at + 1] / 2)


def _bins(train: DataFrame, width: int) -> Bins:
    rows = train.count()
    at, values = _held(train)
    cells = train.select(F.inline(F.arrays_zip(at.alias("feature"), values.alias("value")))).where("value != 0")
    found = cells.groupBy("feature", "value").agg(F.count("*").alias("n")).toArrow()
    feature, value, n = (found.column(c).to_numpy() for c in ("feature", "value", "n"))
    seen = np.bincount(feature, weights=n, minlength=width)
    some = np.flatnonzero((seen > 0) & (seen < rows))
    feature, value = np.concatenate([feature, some]), np.concatenate([value, np.zeros(len(some))])
    order = np.lexsort((value, feature))
    feature, value = feature[order], value[order]
    start = np.searchsorted(feature, np.arange(width + 1))
    zero = np.zeros(width + 1, dtype=np.uint8)
    at_zero = np.flatnonzero(value == 0)
    zero[feature[at_zero]] = at_zero - start[feature[at_zero]]
    return Bins(value, start, zero)


def _encoded(weighted: DataFrame, bins: Bins) -> DataFrame:
    """``row, label, weight, feature, bin``, stored once in as many parts as there are cores."""
    at, values = _held(weighted)
    rows = weighted.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("label").cast("int").alias("label"),
        F.col("weight").cast("double").alias("weight"),
        at.alias("feature"),
        values.alias("value"),
    )

    def encode(batches):
        for b in batches:
            size = pa.compute.list_value_length(b["feature"]).to_numpy()
            feature, value = b["feature"].flatten().to_numpy(), b["value"].flatten().to_numpy()
            held = value != 0
            feature = feature[held]
            ends = np.concatenate([[0], np.cumsum(held)])[np.concatenate([[0], np.cumsum(size)])]
            place = bins.place(feature, value[held]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x)) for x in (feature, place)]
            yield pa.RecordBatch.from_arrays([b["row"], b["label"], b["weight"], *lists], ["row", "label", "weight", "feature", "bin"])

    schema = "row long, label int, weight double, feature array<int>, bin array<int>"
    parts = weighted.sparkSession.sparkContext.defaultParallelism
    return cut_lineage(rows.mapInArrow(encode, schema).repartition(parts, "row"), "forest-rows")


def bag_counts(row: np.ndarray, tree: np.ndarray, seed: int) -> np.ndarray:
    """How often each row is in each tree's bag: Poisson with mean 1, from a hash of both."""
    with np.errstate(over="ignore"):
        x = row.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + (tree.astype(np.uint64) + np.uint64(seed % 2**32) * np.uint64(2**32))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 0xBF58476D1CE4E5B9)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(32)
    u = (x >> np.uint64(11)).astype(np.float64) / 2.0**53
    below, term = 0.0, math.exp(-1)
    count = np.zeros(u.shape, dtype=np.uint8)
    for k in range(1, 16):
        below += term
        count += u >= below
        term /= k
    return count


def node_features(rng: np.random.Generator, nodes: int, width: int) -> np.ndarray:
    """For each node as many different features as the root of their number, at random."""
    size = math.ceil(math.sqrt(width))
    out = np.sort(rng.integers(0, width, (nodes, size), dtype=np.int32), axis=1)
    while len(again := np.flatnonzero((out[:, 1:] == out[:, :-1]).any(axis=1))):
        part = out[again]
        twice = np.zeros(part.shape, dtype=bool)
        twice[:, 1:] = part[:, 1:] == part[:, :-1]
        part[twice] = rng.integers(0, width, int(twice.sum()), dtype=np.int32)
        out[again] = np.sort(part, axis=1)
    return out


def _added(key: np.ndarray, weight: np.ndarray, rows: np.ndarray) -> tuple:
    key, at = np.unique(key, return_inverse=True)
    return key, np.bincount(at, weights=weight, minlength=len(key)), np.bincount(at, weights=rows, minlength=len(key))


def _counter(bins: Bins, width: int, classes: int, seed: int, level: int, trees: np.ndarray, split: np.ndarray, cut: np.ndarray, slot_of: np.ndarray, chosen: np.ndarray):
    """Counts of a level's nodes over a part of the rows: of each by class, and by the bins of its features that rows hold."""
    nodes = split.shape[1]
    split, cut, slot_of = split.ravel(), cut.ravel(), slot_of.ravel()
    bytes_ = width // 8 + 1

    def count(batches):
        wanted = np.zeros((len(chosen), bytes_), dtype=np.uint8)
        np.bitwise_or.at(wanted, (np.arange(len(chosen))[:, None], chosen >> 3), np.left_shift(1, chosen & 7).astype(np.uint8))
        wanted = wanted.ravel()
        size = max(1, BATCH_BYTES // (width + 1))
        dense = np.tile(bins.zero, (size, 1))
        held: list[tuple] = []
        amount = 0
        total = np.zeros((2, len(chosen) * classes))

        def rows_of(key, weight, n):
            key, label = np.divmod(key, classes)
            key, place = np.divmod(key, 256)
            slot, feature = np.divmod(key, width + 1)
            columns = [slot, feature - 1, place, label]
            for at in range(0, len(key), 2**16):
                few = slice(at, at + 2**16)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c[few].astype(np.int32)) for c in columns], pa.array(weight[few]), pa.array(n[few].astype(np.int64))],
                    ["slot", "feature", "bin", "label", "weight", "rows"],
                )

        for b in batches:
            for begin in range(0, b.num_rows, size):
                few = b.slice(begin, size)
                row, label, weight = (few[c].to_numpy() for c in ("row", "label", "weight"))
                lengths = pa.compute.list_value_length(few["feature"]).to_numpy()
                feature, place = few["feature"].flatten().to_numpy(), few["bin"].flatten().to_numpy()
                of = np.repeat(np.arange(len(row)), lengths)
                dense[of, feature] = place
                bag = bag_counts(row, trees, seed)
                r, t = np.nonzero(bag)
                times = bag[r, t]
                node = np.zeros(len(r), dtype=np.int64)
                for _ in range(level):
                    at = t * nodes + node
                    by = split[at]
                    inner = by >= 0
                    if not inner.all():
                        r, t, times, node, at, by = r[inner], t[inner], times[inner], node[inner], at[inner], by[inner]
                    node = 2 * node + 1 + (dense[r, by] > cut[at])
                slot = slot_of[t * nodes + node]
                live = slot >= 0
                r, times, slot = r[live], times[live], slot[live].astype(np.int64)
                dense[of, feature] = bins.zero[feature]
                share, of_class = times * weight[r], label[r]
                total[0] += np.bincount(slot * classes + of_class, weights=share, minlength=total.shape[1])
                total[1] += np.bincount(slot * classes + of_class, weights=times, minlength=total.shape[1])
                # Each row's features side by side, filled up by one that no node wants.
                most = int(lengths.max(initial=0))
                table = np.full((len(row), most), width, dtype=np.int32)
                places = np.zeros((len(row), most), dtype=np.int32)
                inside = np.arange(most) < lengths[:, None]
                table[inside], places[inside] = feature, place
                pairs = max(1, BATCH_BYTES // (16 * max(1, most)))
                for at in range(0, len(r), pairs):
                    some = slice(at, at + pairs)
                    own, s, by = table[r[some]], slot[some], r[some]
                    hit, k = np.nonzero((wanted[s[:, None] * bytes_ + (own >> 3)] >> (own & 7).astype(np.uint8)) & 1)
                    key = ((s[hit] * (width + 1) + own[hit, k] + 1) * 256 + places[by[hit], k]) * classes + of_class[some][hit]
                    held.append((key, share[some][hit], times[some][hit]))
                    amount += len(key)
                if amount > HELD:
                    held = [_added(*map(np.concatenate, zip(*held)))]
                    # What stays apart after adding up is handed on.
                    if len(held[0][0]) > HELD // 2:
                        yield from rows_of(*held.pop())
                    amount = len(held[0][0]) if held else 0
        if held:
            yield from rows_of(*_added(*map(np.concatenate, zip(*held))))
        some = np.flatnonzero(total[1])
        slot, of_class = np.divmod(some, classes)
        yield from rows_of(slot * (width + 1) * 256 * classes + of_class, total[0][some], total[1][some])

    return count


def _gini(w: np.ndarray) -> np.ndarray:
    whole = w.sum(axis=1)
    return 1 - ((w / np.where(whole > 0, whole, 1)[:, None]) ** 2).sum(axis=1)


def _chooser(bins: Bins, width: int, classes: int):
    """The best split of each node from all its counts, which stand in one part."""

    def choose(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got)
        slot, feature, place, label = (t.column(c).to_numpy().astype(np.int64) for c in ("slot", "feature", "bin", "label"))
        key, at = np.unique((slot * (width + 1) + feature + 1) * 256 + place, return_inverse=True)
        shape = len(key), classes

        def table(column: str) -> np.ndarray:
            return np.bincount(at * classes + label, weights=t.column(column).to_numpy(), minlength=len(key) * classes).reshape(shape)

        weight, rows = table("weight"), table("rows")
        of, place = np.divmod(key, 256)
        node, feature = np.divmod(of, width + 1)
        feature -= 1
        whole = feature < 0
        nodes, total, total_rows = node[whole], weight[whole], rows[whole]
        node, feature, place, weight, rows, of = (x[~whole] for x in (node, feature, place, weight, rows, of))
        best = np.full(len(nodes), -1)
        if len(node):
            first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            mine = np.searchsorted(nodes, node[first])
            left_rows = total_rows[mine] - np.add.reduceat(rows, first)
            left = np.where(left_rows > 0, total[mine] - np.add.reduceat(weight, first), 0.0)
            zeros = left_rows.sum(axis=1) > 0
            f = feature[first][zeros]
            node, feature = np.concatenate([node, node[first][zeros]]), np.concatenate([feature, f])
            place, of = np.concatenate([place, bins.zero[f].astype(np.int64)]), np.concatenate([of, of[first][zeros]])
            weight, rows = np.concatenate([weight, left[zeros]]), np.concatenate([rows, left_rows[zeros]])
            order = np.lexsort((place, of))
            node, feature, place, of, weight, rows = (x[order] for x in (node, feature, place, of, weight, rows))
            first = np.concatenate([[True], of[1:] != of[:-1]])
            last = np.concatenate([first[1:], [True]])
            group = np.cumsum(first) - 1
            sums = np.cumsum(weight, axis=0), np.cumsum(rows, axis=0)
            low, low_rows = (s - (s - x)[first][group] for s, x in zip(sums, (weight, rows)))
            mine = np.searchsorted(nodes, node)
            low = np.where(low_rows > 0, low, 0.0)
            high = np.where(total_rows[mine] - low_rows > 0, np.maximum(total[mine] - low, 0.0), 0.0)
            w, wl, wr = total[mine].sum(axis=1), low.sum(axis=1), high.sum(axis=1)
            gain = _gini(total[mine]) - (wl * _gini(low) + wr * _gini(high)) / w
            gain = np.where(last, -1.0, gain)
            # Equal gains go to any of the features, the same one in each run.
            draw = (of * 0x9E3779B1) % 2**31
            order = np.lexsort((place, draw, -gain, node))
            best_of = order[np.concatenate([[True], node[order][1:] != node[order][:-1]])]
            best_of = best_of[gain[best_of] > NO_GAIN]
            best[np.searchsorted(nodes, node[best_of])] = best_of
        found = best >= 0
        b = best[found]

        def column(values, none, kind):
            out = np.full(len(nodes), none, dtype=kind)
            if len(b):
                out[found] = values[b]
            return pa.array(out)

        def lists(values, kind):
            return pa.array(list(values.astype(kind)))

        lefts, left_counts = np.zeros(total.shape), np.zeros(total.shape)
        if len(b):
            lefts[found], left_counts[found] = low[b], low_rows[b]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(nodes.astype(np.int32)),
                column(feature if len(b) else None, -1, np.int32),
                column(place if len(b) else None, -1, np.int32),
                column(gain if len(b) else None, -1.0, np.float64),
                lists(total, np.float64),
                lists(total_rows, np.int64),
                lists(lefts, np.float64),
                lists(left_counts, np.int64),
            ],
            ["slot", "feature", "bin", "gain", "total", "total_rows", "first", "first_rows"],
        )

    return choose


def sparse_forest(forest, weighted: DataFrame, width: int) -> RandomForestClassificationModel:
    """The model of ``forest``, an estimator with unset defaults but for trees, depth, seed and weight."""
    trees, depth, seed = forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()
    bins = _bins(weighted, width)
    rows = _encoded(weighted, bins)
    classes = int(rows.agg(F.max("label")).first()[0]) + 1
    size = 2 ** (depth + 1) - 1
    split = np.full((trees, size), -1, dtype=np.int32)
    cut = np.zeros((trees, size), dtype=np.uint8)
    gains = np.zeros((trees, size))
    stats, counts = np.zeros((trees, size, classes)), np.zeros((trees, size, classes), dtype=np.int64)
    rng = np.random.default_rng(seed)
    active = np.stack([np.arange(trees), np.zeros(trees, dtype=np.int64)])
    at_once = max(1, NODE_BYTES // (width // 8 + 1))
    for level in range(depth):
        following = []
        for begin in range(0, active.shape[1], at_once):
            t, node = active[:, begin : begin + at_once]
            own = np.unique(t)
            slot_of = np.full((len(own), size), -1, dtype=np.int32)
            slot_of[np.searchsorted(own, t), node] = np.arange(len(t))
            count = _counter(bins, width, classes, seed, level, own, split[own], cut[own], slot_of, node_features(rng, len(t), width))
            parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-len(t) // 256))
            found = rows.mapInArrow(count, COUNTS).repartition(parts, "slot").mapInArrow(_chooser(bins, width, classes), SPLITS).toArrow()
            slot, by, place, gain = (found.column(c).to_numpy() for c in ("slot", "feature", "bin", "gain"))
            total, total_n, first, first_n = (
                np.array(found.column(c).to_pylist()).reshape(-1, classes) for c in ("total", "total_rows", "first", "first_rows")
            )
            t, node = t[slot], node[slot]
            stats[t, node], counts[t, node] = total, total_n
            inner = by >= 0
            t, node = t[inner], node[inner]
            split[t, node], cut[t, node], gains[t, node] = by[inner], place[inner], gain[inner]
            left, left_n = first[inner], first_n[inner]
            right, right_n = np.where(total_n[inner] > left_n, total[inner] - left, 0.0), total_n[inner] - left_n
            for child, w, n in ((2 * node + 1, left, left_n), (2 * node + 2, right, right_n)):
                stats[t, child], counts[t, child] = w, n
                mixed = (n > 0).sum(axis=1) > 1
                following.append(np.stack([t[mixed], child[mixed]]))
        active = np.concatenate(following, axis=1) if following else active[:, :0]
        active = active[:, np.lexsort((active[1], active[0]))]
        if not active.shape[1]:
            break
    return _model(forest, weighted, bins, split, cut, gains, stats, counts)


def _tree_rows(tree: int, bins: Bins, split, cut, gains, stats, counts) -> list[tuple]:
    """A tree's nodes as Spark stores them, numbered from the root down; leaves of one prediction are joined."""
    impurity = _gini(stats)

    def grown(node: int):
        says = float(stats[node].argmax())
        own = (says, float(impurity[node]), stats[node].tolist(), int(counts[node].sum()))
        if split[node] < 0:
            return own, None
        low, high = grown(2 * node + 1), grown(2 * node + 2)
        if low[1] is None and high[1] is None and low[0][0] == high[0][0]:
            return own, None
        by = (int(split[node]), [bins.threshold(split[node], int(cut[node]))], -1)
        return own, (low, high, float(gains[node]), by)

    out: list = []

    def laid(found) -> int:
        at = len(out)
        out.append(None)
        own, rest = found
        if rest is None:
            out[at] = (tree, (at, *own, -1.0, -1, -1, (-1, [], -1)))
        else:
            low, high, gain, by = rest
            out[at] = (tree, (at, *own, gain, laid(low), laid(high), by))
        return at

    laid(grown(0))
    return out


def _model(forest, weighted: DataFrame, bins: Bins, split, cut, gains, stats, counts) -> RandomForestClassificationModel:
    """A forest that Spark has grown from one row of each class, saved, its nodes replaced, and loaded."""
    spark = weighted.sparkSession
    path = scratch_path(spark, "sparse-forest")
    forest.fit(weighted.dropDuplicates(["label"])).write().save(path)
    nodes = [x for i in range(len(split)) for x in _tree_rows(i, bins, split[i], cut[i], gains[i], stats[i], counts[i])]
    kept = spark.read.parquet(f"{path}/data").schema
    spark.createDataFrame(nodes, kept, verifySchema=False).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)
