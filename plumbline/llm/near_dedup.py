"""Near duplicates: MinHash bands, verified links, connected components."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.common import BitTable, slices, stored, texts_of
from plumbline.llm.shingles import folded_words, minima, shingle_hashes, universal_hashes

WIDTH = 5
PERCENT = 80
# 40 bands of 6 minima: a pair of similarity 0.8 shares no band once in 190,000 times.
BANDS = 40
ROWS = 6
SEED = 20_241
# A bucket with more components than this is split by its members' rarest shingles.
FULL = 512
# Counters of shingles that say how rare each is in such buckets (8 MB).
COUNTERS = 1 << 20
# One bit of each of 240 minima. At similarity 0.8 nine tenths agree; a pair below
# this many agreeing bits, 6.7 deviations less, is not worth comparing (once in 600 million times).
BIT_WORDS = 4
LEAST_BITS = 0.77
# Bitmaps of the shingles in which a member and its bucket's leader differ, in 64-bit words.
MAP_WORDS = 8

SIGNATURE = "doc_id bigint, n bigint, print1 bigint, print2 bigint, bits array<bigint>, bands array<bigint>"


def signatures(docs: DataFrame, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row of ``doc_id, text``: size and 128-bit digest of its shingle set, bits and band keys.

    Texts without words have ``n`` 0 and no bands.
    """
    a, b = universal_hashes(bands * rows, SEED)
    fold, _ = universal_hashes(rows, SEED + 1)

    def sign(batches):
        for batch in batches:
            # Runs of about 1 MB keep the values of one pass in a core's cache.
            for part in slices(batch):
                sets = [np.unique(shingle_hashes(folded_words(t), width)) for t in part.column("text").to_pylist()]
                sizes = np.array([len(s) for s in sets], "i8")
                some = np.flatnonzero(sizes)
                prints = np.zeros((len(sets), 2), "u8")
                keys = np.zeros((len(sets), bands), "u8")
                bits = np.zeros((len(sets), BIT_WORDS), "u8")
                if len(some):
                    values = np.concatenate([sets[i] for i in some])
                    bounds = np.concatenate([[0], np.cumsum(sizes[some])])
                    low = minima(values, bounds, a, b)
                    with np.errstate(over="ignore"):
                        for j, salt in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
                            x = (values ^ np.uint64(salt)) * np.uint64(0xFF51AFD7ED558CCD)
                            x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
                            prints[some, j] = np.add.reduceat(x ^ (x >> np.uint64(29)), bounds[:-1])
                        folded = (low.reshape(len(some), bands, rows) * fold).sum(axis=2, dtype="u8")
                        folded ^= folded >> np.uint64(31)
                        keys[some] = folded * np.uint64(0x9E3779B97F4A7C15)
                        one = (low >> np.uint64(7)) & np.uint64(1)
                        for w in range(BIT_WORDS):
                            cut = one[:, 64 * w : 64 * (w + 1)]
                            bits[some, w] = (cut << np.arange(cut.shape[1], dtype="u8")).sum(axis=1, dtype="u8")
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "n": pa.array(sizes),
                        "print1": pa.array(prints[:, 0].view("i8")),
                        "print2": pa.array(prints[:, 1].view("i8")),
                        "bits": pa.array(list(bits.view("i8")), pa.list_(pa.int64())),
                        "bands": pa.array(
                            [k.view("i8") if n else [] for k, n in zip(keys, sizes)], pa.list_(pa.int64())
                        ),
                    }
                )

    return docs.mapInArrow(sign, SIGNATURE)


def shingle_sets(docs: DataFrame, width: int, wanted: BitTable) -> DataFrame:
    """``id, shingles`` of the rows of ``doc_id, text`` whose id may be in the table.

    Whole texts are read where they lie; neither they nor their ids are shuffled.
    """

    def sets(batches):
        for batch in batches:
            hashes = batch.column("id_hash").to_numpy().view("u8")
            for part in slices(batch.filter(pa.array(wanted.may_have(hashes))), 500_000):
                found = [np.unique(shingle_hashes(folded_words(t), width)) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": part.column("doc_id"),
                        "shingles": pa.array([s.view("i8") for s in found], pa.list_(pa.int64())),
                    }
                )

    rows = docs.withColumn("id_hash", F.xxhash64("doc_id"))
    return rows.mapInArrow(sets, "id bigint, shingles array<bigint>")


def rare_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """``key, id, component``: so many of a set's rarest shingles that sets which link share one.

    ``sets`` has ``id, component, shingles``. Two sets that link have ``percent``
    hundredths of either in common, so whatever order shingles stand in, each set's
    first ones, up to one more than may be missing, hold a common one. Here the
    rarest stand first, by counters that shingles may share: a passage that all members
    have comes last, and shingles of one set alone are left out.
    """
    slot = np.uint64(COUNTERS - 1)

    def count(batches):
        total = np.zeros(COUNTERS, "i8")
        for batch in batches:
            values = batch.column("shingles").flatten().to_numpy().view("u8")
            total += np.bincount((values & slot).view("i8"), minlength=COUNTERS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["slot", "n"])

    summed = sets.select("shingles").mapInArrow(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counters = np.zeros(COUNTERS, "i8")
    counters[summed.column("slot").to_numpy()] = summed.column("n").to_numpy()
    counts = sets.sparkSession.sparkContext.broadcast(counters)

    def first(batches):
        for batch in batches:
            keys, ids, components_ = [], [], []
            columns = (batch.column(c) for c in ("id", "component", "shingles"))
            for k, component, values in zip(*columns):
                own = values.values.to_numpy().view("u8")
                n = counts.value[own & slot]
                most = len(own) - -(-percent * len(own) // 100) + 1
                rare = np.lexsort((own, n))[:most]
                rare = own[rare[n[rare] > 1]]
                keys.append(rare.view("i8"))
                ids.append(np.full(len(rare), k.as_py()))
                components_.append(np.full(len(rare), component.as_py()))
            if keys:
                made = [pa.array(np.concatenate(x).astype("i8")) for x in (keys, ids, components_)]
                yield pa.RecordBatch.from_arrays(made, ["key", "id", "component"])

    return sets.mapInArrow(first, "key bigint, id bigint, component bigint")


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``id, component`` of all ids in ``links`` (``a, b``): the smallest id reachable.

    Alternating large-star and small-star: every id hooks its larger, then its
    smaller, neighbours to its least one until only stars are left. Minima are
    aggregated before they are joined back; no neighbourhood is collected.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(edges, "links")
    for _ in range(most_rounds):
        if _stars(edges):
            break
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct(), "large-star")
        # All edges now point from the larger id u to the smaller v.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.toDF("u", "v"))
        edges = stored(small.where("u <> v").distinct(), "small-star")
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)


def _stars(edges: DataFrame) -> bool:
    """Whether no id has two smaller neighbours, and no smaller neighbour has one."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("root"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    per = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
    return not per.where("up > 1 or (up = 1 and root = 1)").take(1)


class _Search:
    """Verified links between class representatives, found in rounds."""

    def __init__(self, reps: DataFrame, texts: DataFrame, width: int, percent: int, hashes: int):
        self.reps, self.texts, self.width, self.percent, self.hashes = reps, texts, width, percent, hashes
        self.seen: DataFrame | None = None
        self.sets: DataFrame | None = None

    def may_link(self) -> Column:
        """Whether sizes and signature bits of ``n_a, bits_a`` and ``n_b, bits_b`` leave room for a link."""
        bits = [F.get(F.col(f"bits_{s}"), F.lit(i)) for i in range(BIT_WORDS) for s in "ab"]
        differ = sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(bits[::2], bits[1::2])), F.lit(0))
        used = min(self.hashes, 64 * BIT_WORDS)
        sizes = 100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b")
        return sizes & (differ <= int((1 - LEAST_BITS) * used))

    def side(self, rows: DataFrame, side: str, *more: str) -> DataFrame:
        return rows.select(*more, *[F.col(c).alias(f"{c}_{side}") for c in rows.columns if c not in more])

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of the ``a, b`` pairs, none compared before, whose full shingle sets link."""
        pairs = pairs.distinct()
        if self.seen is not None:
            pairs = pairs.join(self.seen, ["a", "b"], "left_anti")
        about = self.reps.select("id", "n", "bits")
        near = pairs.join(self.side(about, "a"), F.col("a") == F.col("id_a"))
        near = near.join(self.side(about, "b"), F.col("b") == F.col("id_b"))
        near = stored(near.where(self.may_link()).select("a", "b", "n_a", "n_b"), "near-pairs")
        both = F.size(F.array_intersect("set_a", "set_b"))
        close = 100 * both >= self.percent * (F.col("n_a") + F.col("n_b") - both)
        self.seen = near.select("a", "b")
        met = near.join(self.sets.toDF("b", "set_b"), "b").join(self.sets.toDF("a", "set_a"), "a")
        return stored(met.where(close).select("a", "b"), "near-links")

    def leaders(self, buckets: DataFrame) -> DataFrame:
        """``key, id, lead`` of the buckets with two or more members.

        A bucket is led by the member whose buckets are the fullest together: copies
        that were changed least keep most of their band keys, so they meet the others
        most often. Of equals the least id leads.
        """
        full = buckets.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
        crowded = stored(buckets.join(full, "key"), "near-buckets")
        members = stored(crowded.select("id").distinct().select(F.xxhash64("id").alias("id_hash")), "near-members")
        self.sets = stored(shingle_sets(self.texts, self.width, BitTable(members, "id_hash")), "near-sets")
        met = crowded.groupBy("id").agg(F.sum("members").alias("met"))
        first = crowded.join(met, "id").groupBy("key").agg(F.max(F.struct("met", -F.col("id")))["col2"].alias("least"))
        first = first.select("key", (-F.col("least")).alias("lead"))
        return stored(crowded.select("key", "id").join(first, "key"), "near-leads")

    def across(self, buckets: DataFrame) -> DataFrame:
        """Pairs of members in different components that may still link.

        ``buckets`` has ``key, id, lead, component``. In each bucket the members
        outside its largest component meet all others, so members that links have
        joined already are never paired, however many they are. Members of a bucket with
        over ``FULL`` components meet by their rarest shingles instead of by its key.
        """
        crowd = stored(self._crowd(buckets), "near-crowd")
        buckets = stored(buckets.join(crowd, "key"), "near-parted")
        some = buckets.where(F.col("components") <= FULL)
        self.lines = self.outlines(some.select("lead", "id").distinct())
        pairs = self._meet(some)
        over = buckets.where(F.col("components") > FULL).select("id", "component").distinct()
        if not over.take(1):
            return pairs
        split = stored(rare_shingles(over.join(self.sets, "id"), self.percent), "near-split")
        split = split.join(self._crowd(split), "key").join(self.reps.select("id", "n", "bits"), "id")
        return pairs.union(self._pairs(stored(split, "near-rare"), self.may_link()))

    def _crowd(self, buckets: DataFrame) -> DataFrame:
        """``key, components, base`` of the buckets that two or more components meet in."""
        per = buckets.groupBy("key", "component").agg(F.count("*").alias("c"))
        most = F.max(F.struct("c", "component"))["component"].alias("base")
        return per.groupBy("key").agg(F.count("*").alias("components"), most).where("components > 1")

    def outlines(self, pairs: DataFrame) -> DataFrame:
        """``lead, id, lead_n, more, less, added`` of the ``lead, id`` pairs.

        ``less`` and ``more`` are bitmaps of the shingles that the member lacks of its
        leader's and has beside them, ``added`` the number of the latter.
        """
        met = pairs.join(self.sets.toDF("id", "own"), "id").join(self.sets.toDF("lead", "led"), "lead")
        return stored(
            met.select(
                "lead",
                "id",
                F.size("led").alias("lead_n"),
                F.array_except("led", "own").alias("__less"),
                F.array_except("own", "led").alias("__more"),
            ).select(
                "lead",
                "id",
                "lead_n",
                F.size("__more").alias("added"),
                bitmap(F.col("__less")).alias("less"),
                bitmap(F.col("__more")).alias("more"),
            ),
            "near-outlines",
        )

    def may_overlap(self) -> Column:
        """Whether outlines against one leader leave room for a link.

        Two sets share, of the leader's shingles, those that neither lacks, and of
        the others at most those whose bits both have. Bitmaps can only hide a
        difference, so no link is lost.
        """

        def over(name: str, what: Callable[[Column, Column], Column]) -> Column:
            at = [(F.get(F.col(f"{name}_a"), F.lit(i)), F.get(F.col(f"{name}_b"), F.lit(i))) for i in range(MAP_WORDS)]
            return sum((F.bit_count(what(x, y)) for x, y in at), F.lit(0))

        lacking = over("less", lambda x, y: x.bitwiseOR(y))
        alone_a = over("more", lambda x, y: x.bitwiseAND(F.bitwise_not(y)))
        alone_b = over("more", lambda x, y: y.bitwiseAND(F.bitwise_not(x)))
        beside = F.least(F.col("added_a") - alone_a, F.col("added_b") - alone_b)
        both = F.col("lead_n_a") - lacking + beside
        return (100 + self.percent) * both >= self.percent * (F.col("n_a") + F.col("n_b"))

    def _meet(self, buckets: DataFrame) -> DataFrame:
        about = self.lines.join(self.reps.select("id", "n", "bits"), "id")
        rows = stored(buckets.drop("components").join(about, ["lead", "id"]), "near-met")
        return self._pairs(rows, self.may_link() & self.may_overlap())

    def _pairs(self, rows: DataFrame, room: Column) -> DataFrame:
        """``a, b`` of members of one key that are in different components, one outside its largest."""
        a = self.side(rows.where("component <> base").drop("base"), "a")
        b = self.side(rows.drop("base"), "b")
        on = (F.col("key_a") == F.col("key_b")) & (F.col("component_a") != F.col("component_b"))
        return a.join(b, on & room).select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"))


def bitmap(values: Column) -> Column:
    """``MAP_WORDS`` integers with a bit set for each of the hashed values."""

    def word(w: int) -> Column:
        # A shingle is a hash already: its lowest bits name the word, the next six the bit.
        own = F.filter(values, lambda v: v.bitwiseAND(F.lit(MAP_WORDS - 1)) == w)
        bit = lambda v: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(v, 16).bitwiseAND(F.lit(63)).cast("int"))
        return F.aggregate(own, F.lit(0).cast("bigint"), lambda x, v: x.bitwiseOR(bit(v)))

    return F.array(*[word(w) for w in range(MAP_WORDS)])


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Documents link whose sets of ``width``-word shingles have at least ``percent``
    hundredths of their union in common; a component is what links reach, named by
    its smallest id, which is the one kept.

    Equal sets (128-bit digests of whole sets) form a class first, and only its
    smallest id goes on. A bucket is the representatives with one band key. Each
    member is compared with its bucket's leader, by size and signature bits, then by
    full sets. Where links then leave several components in a bucket, the members
    outside the largest are compared with all those of other components: what each
    lacks of the leader's set and has beside it bounds what two can share, and full
    sets decide where the bound leaves room. In a bucket with over 512 components, as
    of a passage that very many otherwise different documents share, those members are
    compared that have one of their rarest shingles in common, of which any two that
    link share one. So the only links left out are those that share no band (once in
    190,000 times at similarity 0.8) or whose signatures mislead (once in 600 million).

    Texts without words or null have 0 shingles and link with nothing; fewer words
    than ``width`` are one shingle. A null id links with nothing and is kept; rows
    that share an id are one document with the links of all of them.
    """
    texts = texts_of(docs, id_col, text_col)
    signed = stored(signatures(texts, width, bands, rows), "near-signatures")
    filled = signed.where("n > 0 and doc_id is not null")
    classes = filled.groupBy("n", "print1", "print2").agg(F.min_by(F.struct("doc_id", "bits", "bands"), "doc_id").alias("m"))
    reps = stored(
        classes.select("n", "print1", "print2", F.col("m.doc_id").alias("id"), "m.bits", "m.bands"), "near-classes"
    )
    members = filled.select("doc_id", "n", "print1", "print2").join(
        reps.select("n", "print1", "print2", F.col("id").alias("rep")), ["n", "print1", "print2"]
    )
    # Two rows may share an id and differ in text: the id then joins their classes.
    shared = members.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b")
    own = members.join(shared.select("doc_id"), "doc_id").where("doc_id <> rep")
    own = own.select(F.least("rep", "doc_id").alias("a"), F.greatest("rep", "doc_id").alias("b"))
    nodes = reps.dropDuplicates(["id"])
    search = _Search(nodes, texts.where("doc_id is not null"), width, percent, bands * rows)
    keyed = reps.select("id", F.posexplode("bands").alias("band", "low")).select(F.xxhash64("band", "low").alias("key"), "id")
    buckets = search.leaders(keyed)
    led = buckets.where("id <> lead")
    led = led.select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b"))
    links = search.links(led).union(own)
    of = stored(components(links), "near-components")
    labelled = buckets.join(of, "id", "left")
    buckets = labelled.select("key", "id", "lead", F.coalesce("component", "id").alias("component"))
    more = search.links(search.across(buckets))
    if more.take(1):
        stars = of.where("id <> component").select(F.col("component").alias("a"), F.col("id").alias("b"))
        of = stored(components(stars.union(more)), "near-components")
    # A document that is no representative has the component of its class.
    labels = members.select("doc_id", "rep").join(of, F.col("rep") == F.col("id"), "left")
    labels = labels.groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("component"))
    joined = signed.select("doc_id", F.col("n").alias("n_shingles")).join(labels, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
