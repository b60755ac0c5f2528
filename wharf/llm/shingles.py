"""Near-duplicates: SimHash links first, then representatives of MinHash buckets, all verified.

Two documents are linked if their sets of five-word shingles have a similarity of 4/5 or more; a
group is what links connect. Every link is verified on the exact sets; candidates come from two
sketches of them.

*SimHash.* ``simhash.near_duplicates`` joins 64-bit fingerprints of the sets by Golay keys, up to
four differing bits. Each document is verified against the one that stands for its component. That
settles most copies, but two sets of similarity 4/5 differ in about ten bits.

*Buckets.* 120 minima of a set in 20 bands of six name 20 buckets; sets of similarity 4/5 share one
in 998 of 1000 cases. In a bucket every document is compared with four representatives, the least,
and not with all others: so pairs grow with the rows, however large a bucket is. Pairs already
connected are left out, and so are those whose sizes, or a one-bit sketch of their minima, rule a
similarity of 4/5 out (a true pair is lost to that sketch in 1 of 20,000 cases). Where one document
has several representatives, the least is tried first.

*Rounds.* Buckets with a document that is not connected to a representative go on to a second round
with new ones. What is left is then compared in full, however large a bucket is: in pairs of blocks,
by many tasks. Here the parities of a set are compared too, four to eight cells to a shingle: as
many cells differ as shingles do, at most, so no similar pair is lost, and hardly any other passes.
So all sets of similarity 4/5 that share a bucket are connected, but for what the one-bit sketch
loses. Only looking at two rows' numbers is quadratic in the rows of such a bucket; what is made and
verified are pairs of a similarity near 4/5 or above. The tests and the README hold the recall
against all pairs.

Defined cases: words and blank texts are those of ``simhash``; a text of fewer than five words
is one shingle; texts without words are one group; documents with equal sets are folded first;
a null id never stays while the group has another; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from wharf.llm import simhash
from wharf.llm.common import scratch, stored
from wharf.llm.components import components
from wharf.llm.simhash import SEED, word_blocks
from wharf.plans.joins import lookup

SIZE = 5
BANDS, ROWS = 20, 6
#: Of the one-bit sketches of 120 minima, those that are equal at least in a pair that is compared.
LEAST_EQUAL = 94
#: Representatives of a bucket in a round, and rounds.
CHOSEN, ROUNDS = 4, 2
#: Rows of a bucket, and shingles of their sets, that make a block of it after the last round.
TOGETHER, SET_ROWS = 512, 1 << 19
#: Shingles that are hashed together.
BLOCK = 4096
#: Sets of frequent documents that a task keeps while it verifies pairs.
KEPT_SETS = 64

_RANDOM = np.random.default_rng(120)
_FACTORS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingles(text: str | None, size: int = SIZE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of one text."""
    digest = xxhash.xxh64_intdigest
    out = np.zeros(0, np.uint64)
    for words in word_blocks((text or "").encode("utf-8", "surrogatepass").lower(), size):
        if not words:
            return out
        last = max(len(words) - size + 1, 1)
        made = (digest(b" ".join(words[i : i + size]), SEED) for i in range(last))
        out = np.union1d(out, np.fromiter(made, np.uint64, last))
    return out


def _with_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = [xxhash.xxh3_128_digest(shingles(t).tobytes()) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary())], ["at", "d"])


def fingerprint(h: np.ndarray) -> int:
    """SimHash of a set: the bits that over half of the hashes have."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(h), BLOCK):
        raw = h[at : at + BLOCK].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(raw, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << int(b) for b in np.flatnonzero(2 * total > len(h)))


def minima(h: np.ndarray) -> np.ndarray:
    """The least hash of a set under each of 120 multiplications."""
    out = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    mixed = h ^ (h >> np.uint64(32))
    for at in range(0, len(h), BLOCK):
        out = np.minimum(out, (mixed[at : at + BLOCK, None] * _FACTORS + _SHIFTS).min(0))
    return out


def sketch(least: np.ndarray) -> tuple[np.ndarray, int, int]:
    """The keys of the buckets, and one bit of each of the minima in two numbers."""
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        keys = (keys ^ column) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    bits = ((least >> np.uint64(20)) & np.uint64(1)).astype(np.int64)
    half = BANDS * ROWS // 2
    places = np.int64(1) << np.arange(half)
    return keys.view(np.int64), int(bits[:half] @ places), int(bits[half:] @ places)


def parities(h: np.ndarray) -> np.ndarray:
    """The parity of the number of hashes in each cell, 64 cells to a number, lowest bits first.

    A set has four to eight times as many cells as hashes, a power of two; the two halves of it
    make the parities for half as many cells, combined by XOR.
    """
    cells = 64 << ((max(len(h), 1) - 1) // 16).bit_length()
    counts = np.bincount((h & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.int64)


_MARKS = "v bigint, n bigint, fp bigint, s0 bigint, s1 bigint, keys array<bigint>, cells array<bigint>"


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for v, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            h = shingles(text.as_py())
            keys, s0, s1 = sketch(minima(h))
            fp = np.array([fingerprint(h)], np.uint64).view(np.int64)[0]
            # A text without words is in no bucket.
            rows.append((v, len(h), int(fp), s0, s1, keys if len(h) else keys[:0], parities(h)))
        if rows:
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 2
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["v", "n", "fp", "s0", "s1", "keys", "cells"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of similarity 4/5 or more; the sets of documents that come often are kept."""
    sets: dict[int, np.ndarray] = {}
    for batch in batches:
        keep = []
        for a, left, right in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
            if a not in sets:
                if len(sets) >= KEPT_SETS:
                    sets.clear()
                sets[a] = shingles(left.as_py())
            s, t = sets[a], shingles(right.as_py())
            both = len(np.intersect1d(s, t, assume_unique=True))
            keep.append(9 * both >= 4 * (len(s) + len(t)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _similar(pairs: pa.Table, texts: pa.Table) -> pa.Table:
    """The pairs (a, b) of one group of texts that have a similarity of 4/5 or more."""
    sets = {v: shingles(t.as_py()) for v, t in zip(texts.column("v").to_pylist(), texts.column("text"))}
    distinct = np.unique(np.concatenate(list(sets.values()) or [np.zeros(0, np.uint64)]))
    places = {v: np.searchsorted(distinct, h) for v, h in sets.items()}
    pairs = pairs.select(["a", "b"]).sort_by("a")
    a, b = pairs.column("a").to_numpy(), pairs.column("b").to_numpy()
    starts = np.flatnonzero(np.diff(a, prepend=a[:1] - 1))
    keep = np.zeros(len(a), bool)
    mark = np.zeros(len(distinct), np.int8)
    for low, high in zip(starts, [*starts[1:], len(a)]):
        mine = places[a[low]]
        mark[mine] = 1
        others = [places[v] for v in b[low:high]]
        n = np.array([len(o) for o in others])
        both = np.add.reduceat(mark[np.concatenate(others)], np.cumsum(n) - n, dtype=np.int64)
        keep[low:high] = 9 * both >= 4 * (len(mine) + n)
        mark[mine] = 0
    return pairs.filter(pa.array(keep))


class _Groups:
    """What is connected so far: ``roots`` (v, c), the root of every document that is not one itself.

    ``cells`` (v, cells) are the parities of the sets.
    """

    def __init__(self, texts: DataFrame, cells: DataFrame):
        self.texts, self.cells = texts, cells
        self.roots = texts.sparkSession.createDataFrame([], "v bigint, c bigint")

    def labelled(self, rows: DataFrame, v: str, c: str) -> DataFrame:
        """``rows`` with the group ``c`` of the document ``v``."""
        roots = self.roots.select(F.col("v").alias(v), F.col("c").alias("__root"))
        return lookup(rows, roots, [v], "left").withColumn(c, F.coalesce("__root", v)).drop("__root")

    def apart(self, met: DataFrame) -> DataFrame:
        """The rows of ``met`` (v, and the representative ``r``) that are in different groups."""
        named = self.labelled(self.labelled(met.withColumn("rv", F.col("r.v")), "v", "c"), "rv", "rc")
        return named.where("c != rc")

    @staticmethod
    def likely() -> Column:
        """Whether the sizes and sketches of a row and of ``r`` allow a similarity of 4/5."""
        differ = F.bit_count(F.col("s0").bitwiseXOR(F.col("r.s0"))) + F.bit_count(
            F.col("s1").bitwiseXOR(F.col("r.s1"))
        )
        sizes = (4 * F.col("n") <= 5 * F.col("r.n")) & (4 * F.col("r.n") <= 5 * F.col("n"))
        return sizes & (differ <= BANDS * ROWS - LEAST_EQUAL)

    @staticmethod
    def close() -> Column:
        """Whether the parities of a row and of ``r``, whose sizes are alike, allow a similarity of 4/5.

        Sets of that similarity differ in a ninth of the sum of their sizes at most, and each shingle
        that only one of them has changes one cell.
        """

        def folded(mine: Column, other: Column) -> Column:
            half = F.call_function("div", F.size(mine), F.lit(2)).cast("int")
            low, high = F.slice(mine, F.lit(1), half), F.slice(mine, half + 1, half)
            pressed = F.zip_with(low, high, lambda x, y: x.bitwiseXOR(y))
            return F.when(F.size(mine) > F.size(other), pressed).otherwise(mine)

        cells, others = F.col("cells"), F.col("r.cells")
        differ = F.aggregate(
            F.zip_with(folded(cells, others), folded(others, cells), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
            F.lit(0),
            lambda total, each: total + each,
        )
        return 9 * differ <= F.col("n") + F.col("r.n")

    def open_pairs(self, met: DataFrame) -> DataFrame:
        """Pairs (a, b) of ``met`` that are apart and may be similar, by their sizes and sketches."""
        # Filtered first: only pairs that may count are looked up.
        return self.apart(met.where(self.likely())).select(F.col("r.v").alias("a"), F.col("v").alias("b"))

    def rest_pairs(self, rows: DataFrame) -> DataFrame:
        """All pairs (a, b) of ``rows`` of a bucket that are apart and may be similar, each in one group ``at``.

        A large bucket is cut into blocks, and each two of its blocks meet in a group of their own:
        so no task holds more than two blocks, however large a bucket is.
        """
        named = stored(self.labelled(rows, "v", "c"), "shingle-named")
        sizes = named.groupBy("key").agg(
            F.greatest(F.count("*") / F.lit(TOGETHER), F.sum("n") / F.lit(SET_ROWS)).alias("g"),
            F.min("c").alias("least"),
            F.max("c").alias("most"),
        )
        blocks = F.ceil("g").cast("bigint").alias("blocks")
        mixed = stored(sizes.where("least != most").select("key", blocks), "shingle-mixed")
        dealt = lookup(named, mixed, ["key"]).withColumn("own", F.pmod(F.xxhash64("v"), F.col("blocks")))
        # Few rows are left by now: only theirs are looked up.
        left_over = stored(dealt.select("v").distinct(), "shingle-left")
        cells = stored(lookup(self.cells, left_over, ["v"], "left_semi"), "shingle-cells")
        dealt = lookup(dealt, cells, ["v"])
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
        names = ["v", "n", "s0", "s1", "c", "cells"]
        left = dealt.select("key", F.col("own").alias("i"), every.alias("j"), *names)
        right = dealt.select("key", every.alias("i"), F.col("own").alias("j"), F.struct(*names).alias("r"))
        met = left.join(right, ["key", "i", "j"]).where("v > r.v AND c != r.c").where(self.likely() & self.close())
        at = F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j"))
        return met.groupBy(F.col("r.v").alias("a"), F.col("v").alias("b")).agg(F.min(at).alias("at"))

    def verify_rest(self, rows: DataFrame) -> None:
        """Connect all similar sets among ``rows`` of a bucket; a text goes once to each of its groups."""
        spark = self.texts.sparkSession
        with scratch(spark) as keep:
            pairs = stored(self.rest_pairs(rows), "shingle-rest")
            if pairs.isEmpty():
                return
            ends = pairs.select("at", F.col("a").alias("v")).unionAll(pairs.select("at", "b")).distinct()
            read = lookup(self.texts, stored(ends, "shingle-rest-ends"), ["v"]).select("at", "v", "text")
            tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
            left, right = pairs.repartition(tasks, "at"), read.repartition(tasks, "at")
            good = left.groupBy("at").cogroup(right.groupBy("at")).applyInArrow(_similar, "a bigint, b bigint")
            self.roots = keep(self._joined(stored(good, "shingle-links", free=True)), "shingle-roots")

    def verify(self, pairs: DataFrame) -> None:
        """Connect the pairs (a, b) whose sets are similar; ``a`` may come very often."""
        with scratch(self.texts.sparkSession) as keep:
            roots = self._verified(pairs)
            if roots is not None:
                self.roots = keep(roots, "shingle-roots")

    def _verified(self, pairs: DataFrame) -> DataFrame | None:
        """The roots with these pairs, where there is one."""
        pairs = stored(pairs.distinct(), "shingle-pairs")
        if pairs.isEmpty():
            return None
        ends = pairs.select(F.col("a").alias("v")).unionAll(pairs.select("b")).distinct()
        ends = stored(ends, "shingle-ends")
        # Texts, not sets: a set takes eight bytes a word, which do not compress.
        read = lookup(self.texts, ends, ["v"], "left_semi").select("v", "text")
        one = lookup(pairs, read.withColumnsRenamed({"v": "b", "text": "tb"}), ["b"])
        two = lookup(one, read.withColumnsRenamed({"v": "a", "text": "ta"}), ["a"])
        good = two.select("a", "b", "ta", "tb").mapInArrow(_verified, "a bigint, b bigint")
        return self._joined(stored(good, "shingle-links", free=True))

    def _joined(self, good: DataFrame) -> DataFrame:
        """The roots with these links."""
        # Groups are contracted, so that only what is new is joined.
        new = self.labelled(self.labelled(good, "a", "ca"), "b", "cb").where("ca != cb")
        joined = components(new.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
        joined = stored(joined, "shingle-joined")
        moved = lookup(self.roots, joined.select(F.col("node").alias("c"), "root"), ["c"], "left")
        moved = moved.select("v", F.coalesce("root", "c").alias("c"))
        return moved.unionAll(joined.select("node", "root"))


def links(texts: DataFrame) -> DataFrame:
    """(v, c), the root c of all of ``texts`` (v, text), with distinct sets, that are linked to a smaller one."""
    marks = stored(texts.mapInArrow(_marked, _MARKS), "shingle-marks")
    groups = _Groups(texts, marks.select("v", "cells"))
    near = simhash.near_duplicates(marks.where("n > 0").select("v", "fp"), "v")
    groups.verify(near.select(F.col("component_id").alias("a"), F.col("v").alias("b")).where("a != b"))

    names = ["key", "v", "n", "s0", "s1"]
    rows = marks.select(F.explode("keys").alias("key"), *names[1:])
    shared = rows.groupBy("key").agg(F.count("*").alias("g")).where("g > 1").select("key")
    rows = stored(rows.join(shared, "key", "left_semi"), "shingle-buckets", free=True)
    for number in range(ROUNDS):
        # The limit on the rank lets every map task cut its own rows before the shuffle.
        rank = F.row_number().over(Window.partitionBy("key").orderBy("v"))
        least = rows.withColumn("rank", rank).where(F.col("rank") <= CHOSEN)
        least = stored(least.select("key", F.struct(*names[1:]).alias("r")), "shingle-least")
        met = stored(lookup(rows, least, ["key"]).where("v > r.v"), "shingle-met")
        if number == 0:
            # What the first choice connects needs no second one.
            first = groups.open_pairs(met).groupBy("b").agg(F.min("a").alias("a"))
            groups.verify(first.select("a", "b"))
        groups.verify(groups.open_pairs(met))
        # Who is apart from the representatives may be linked to another one of their group.
        mixed = groups.apart(met).select("key").distinct()
        done = least.select("key", F.col("r.v").alias("v"))
        left = rows.join(mixed, "key", "left_semi").join(done, ["key", "v"], "left_anti")
        rows = stored(left.select(*names), "shingle-buckets")
    groups.verify_rest(rows)
    return groups.roots


def keep_one(df: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with one row of each group: the smallest id, then the first such row."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    whole = stored(
        df.select(
            F.struct(*columns).alias("__row"),
            F.col(f"`{row_id}`").cast("bigint").alias("id"),
            F.monotonically_increasing_id().alias("at"),
        ),
        "deduplicate",
    )
    read = whole.select("at", F.col("__row").getField(text).alias("text"))
    digests = stored(read.mapInArrow(_with_digests, "at bigint, d binary"), "shingle-digests")
    equal = digests.groupBy("d").agg(F.min("at").alias("v"), F.count("*").alias("n")).where("n > 1")
    equal = stored(equal.select("d", "v"), "shingle-equal")
    copies = stored(lookup(digests, equal, ["d"]).where(F.col("at") != F.col("v")).select("at", "v"), "shingle-copies")
    texts = lookup(read, copies.select("at"), ["at"], "left_anti")
    with scratch(whole.sparkSession) as keep:
        roots = keep(links(texts.select(F.col("at").alias("v"), "text")), "shingle-groups")
    found = lookup(whole.select("at", "id"), copies, ["at"], "left").select(
        "at", "id", F.coalesce("v", "at").alias("v")
    )
    found = lookup(found, roots, ["v"], "left").select("at", "id", F.coalesce("c", "v").alias("g"))
    # Nulls come last: an id that is missing stays only in a group without any.
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("at"))
    first = stored(found.groupBy("g").agg(F.min(order).alias("f")).select(F.col("f.at").alias("at")), "shingle-first")
    kept = lookup(whole, first, ["at"], "left_semi")
    return kept.select(*[F.col("__row").getField(c).alias(c) for c in df.columns])
