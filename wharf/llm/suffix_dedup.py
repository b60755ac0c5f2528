"""Exact removal of repeated substrings, by threshold-bounded interval expansion.

Every 100-byte string that also starts earlier is found, and all bytes it covers are removed.

*Anchors.* Each 100-byte window names one of its 24-byte strings, the one with the least hash.
Equal windows name the same string at the same offset, so only windows with an equal anchor can
be equal. A run of windows with one anchor is one row, about one for every 39 bytes. One
exchange by anchor finds the anchors that occur more than once; an anchor repeated within a
batch is folded before it, so a frequent one reaches its task as few rows.

*Expansion.* The bytes around repeated anchors are dealt out by anchor. A task sorts the
suffixes that start at its anchors, takes the common prefixes of neighbours, and then extends
all of them backward, one byte per level, as on a Burrows-Wheeler transform: a stable sort on
the preceding byte keeps the suffix order inside each interval. Level by level the intervals of
suffixes with ``a`` equal bytes before and ``100 - a`` from the anchor on are exactly the classes
of equal windows; intervals of one suffix are dropped, and the expansion stops when the windows
that the rows asked for are used up. Comparison is on bytes, hashes only choose anchors.

Anchors with more than ``HOT_ROWS`` rows never meet in one task: equal surroundings are folded by
a partial aggregate, and the windows of the distinct ones are compared by a 128-bit digest in
an aggregate and a join, both of which combine or split hot keys. The result is the same.

Defined cases: a null text is empty; matches never cross documents; of rows with one id the
order is that of a digest of their texts, and rows equal in id and text are one document listed
several times, with one result; a null id comes first; texts under 100 bytes stay whole; an
empty table stays empty; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wharf.llm.common import stored
from wharf.plans.joins import lookup

LENGTH = 100
GRAM = 24
#: Rows of one anchor that may meet in one task.
HOT_ROWS = 50_000
#: Anchor rows that one expansion task holds (about 200 bytes each).
ROWS_PER_TASK = 40_000
#: Bytes of text for each task that looks for anchors met twice (one row of 25 bytes for 39 of them).
BYTES_PER_TASK = 64 << 20
_PIECE = 1 << 20
_REACH = LENGTH - GRAM  # most bytes of a window before its anchor


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 24 bytes from each position on."""
    table = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64)
    part = {1: table[data]}
    factors = np.random.default_rng(21).integers(0, 1 << 62, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for level, size in enumerate((1, 2, 4, 8)):
        half = part[size]
        part[2 * size] = half[:-size] * factors[level] + half[size:]
    out = part[16][: len(data) - GRAM + 1] * factors[5] + part[8][16:]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(29)
    return out


def piece_anchors(data: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of the windows that start in one piece of bytes.

    ``data`` has LENGTH - 1 more bytes than ``valid``. Returns, per run of windows with one
    anchor, (hash, anchor position, first window, last window).
    """
    hashes = gram_hashes(data)
    place_bits = np.uint64(21)
    places = np.arange(len(hashes), dtype=np.uint64)
    least = (hashes >> place_bits << place_bits) | places
    width = 1
    while 2 * width <= _REACH + 1:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = _REACH + 1 - width
    least = np.minimum(least[: len(least) - rest], least[rest:])
    anchor = (least & np.uint64((1 << 21) - 1)).astype(np.int64)[: len(valid)]
    starts = np.flatnonzero(valid)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 4
    named = anchor[starts]
    cut = np.flatnonzero((np.diff(named) != 0) | (np.diff(starts) != 1)) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut, [len(starts)]]) - 1
    at = named[first]
    return hashes[at].view(np.int64), at, starts[first], starts[last]


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor runs of documents that lie end to end: (document, hash, place, low, high).

    ``place`` is the anchor's byte in its document; ``low`` and ``high`` bound the bytes of the
    run's windows before it.
    """
    found = []
    total = int(offsets[-1])
    for begin in range(0, total - LENGTH + 1, _PIECE):
        end = min(begin + _PIECE, total - LENGTH + 1)
        change = np.zeros(end - begin + 1, np.int32)
        # Windows that start in the last LENGTH - 1 bytes of a document would leave it.
        until = offsets[1:]
        since = np.maximum(until - LENGTH + 1, offsets[:-1])
        a, b = np.clip(since - begin, 0, end - begin), np.clip(until - begin, 0, end - begin)
        np.add.at(change, a, 1)
        np.add.at(change, b, -1)
        valid = np.cumsum(change[:-1]) == 0
        h, at, first, last = piece_anchors(data[begin : end + LENGTH - 1], valid)
        doc = np.searchsorted(offsets, first + begin, side="right") - 1
        found.append((doc, h, at + begin - offsets[doc], at - last, at - first))
    if not found:
        return (np.zeros(0, np.int64),) * 5
    return tuple(np.concatenate(c) for c in zip(*found))


def packed(place: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return place.astype(np.int64) << 14 | low.astype(np.int64) << 7 | high.astype(np.int64)


def unpacked(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return at >> 14, at >> 7 & 127, at & 127


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column end to end, and the borders of its rows."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        doc, h, place, low, high = anchors(*_bytes_of(batch.column(1)))
        at = packed(place, low, high)
        # Rows of an anchor repeated in this batch need no partner; one of them still tells
        # the other batches.
        order = np.argsort(h, kind="stable")
        same = h[order][1:] == h[order][:-1]
        later = order[1:][same]
        leads = order[:-1][same & ~np.concatenate([[False], same[:-1]])]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([h, h[leads]])),
                pa.array(np.concatenate([key[doc], key[doc[leads]]])),
                pa.array(np.concatenate([at, at[leads]])),
                pa.array(_roles(len(h), later, leads)),
            ],
            ["h", "k", "at", "role"],
        )


#: What a row does on its way: it asks for a partner, is known to have one (and is dealt out
#: freely), or only tells its anchor's task that there is one.
ASKS, KNOWN, TELLS = range(3)


def _roles(n: int, later: np.ndarray, leads: np.ndarray) -> np.ndarray:
    """Roles of a batch's rows and, after them, of one more row for each lead."""
    roles = np.full(n + len(leads), ASKS, np.int8)
    roles[later] = KNOWN
    roles[leads] = TELLS
    roles[n:] = KNOWN
    return roles


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep known rows and rows whose anchor another row of the partition shares."""
    waiting = []
    for batch in batches:
        h, k, at, role = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        known = role == KNOWN
        if known.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[known]), pa.array(k[known]), pa.array(at[known])], ["h", "k", "at"]
            )
        waiting.append((h[~known], k[~known], at[~known], role[~known]))
    if not waiting:
        return
    h, k, at, role = (np.concatenate(c) for c in zip(*waiting))
    order = np.argsort(h, kind="stable")
    h, k, at, role = h[order], k[order], at[order], role[order]
    new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    partners = np.bincount(group) if len(h) else np.zeros(0, np.int64)
    marked = np.bincount(group, role == TELLS) if len(h) else np.zeros(0)
    keep = ((partners > 1) | (marked > 0))[group] & (role == ASKS) if len(h) else np.zeros(0, bool)
    yield pa.RecordBatch.from_arrays(
        [pa.array(h[keep]), pa.array(k[keep]), pa.array(at[keep])], ["h", "k", "at"]
    )


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes that the windows of each repeated anchor cover, at fixed offsets."""
    width = _REACH + LENGTH
    for batch in batches:
        data, offsets = _bytes_of(batch.column(1))
        lists = batch.column(2)
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        flat = lists.flatten()
        h = flat.field("h").to_numpy(zero_copy_only=False)
        at = flat.field("at").to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(batch.num_rows), sizes)
        key = batch.column(0).to_numpy()[doc]
        place, low, high = unpacked(at)
        base = offsets[doc] + place
        for cut in range(0, len(h), 1 << 14):
            part = slice(cut, cut + (1 << 14))
            rel = np.arange(-_REACH, LENGTH)[None, :]
            inside = (rel >= -high[part, None]) & (rel < LENGTH - low[part, None])
            where = np.where(inside, base[part, None] + rel, 0)
            around = np.where(inside, data[where], 0).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h[part]),
                    pa.array(key[part]),
                    pa.array(at[part]),
                    pa.FixedSizeBinaryArray.from_buffers(
                        pa.binary(width), len(around), [None, pa.py_buffer(around.tobytes())]
                    ).cast(pa.binary()),
                ],
                ["h", "k", "at", "around"],
            )


class _Least:
    """Least value between two positions, by doubling."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        step = 1
        while 2 * step <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Minimum of values[a + 1 .. b], for a < b."""
        span = b - a
        level = np.frexp(span.astype(np.float64))[1] - 1
        out = np.empty(len(span), self.rows[0].dtype)
        for i in np.unique(level):
            pick = level == i
            row = self.rows[i]
            out[pick] = np.minimum(row[a[pick] + 1], row[b[pick] - (1 << i) + 1])
        return out


def expand(k: np.ndarray, at: np.ndarray, around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Removed byte ranges (key, from, to) among rows that hold all rows of their anchors."""
    place, low, high = unpacked(at)
    n = len(k)
    forward = np.zeros((n, 104), np.uint8)
    forward[:, :LENGTH] = around[:, _REACH:]
    words = forward.view(">u8").astype(np.uint64)
    order = np.lexsort(tuple(words[:, i] for i in range(words.shape[1] - 1, -1, -1)))
    age = np.empty(n, np.int64)
    age[np.lexsort((place, k))] = np.arange(n)
    # Common prefixes of neighbours in suffix order; from here on rows go by that order.
    k, place, low, high, age, around = (x[order] for x in (k, place, low, high, age, around))
    differ = forward[order][1:] != forward[order][:-1]
    common = np.where(differ.any(1), differ.argmax(1), LENGTH).clip(max=LENGTH).astype(np.uint8)
    least = _Least(np.concatenate([np.zeros(1, np.uint8), common]))

    live = np.arange(n)
    interval = np.cumsum(np.concatenate([[0], common < GRAM]).astype(np.int64))
    rows, levels = [], []
    for level in range(_REACH + 1):
        if level:
            # Backward extension: the stable sort keeps suffix order in each interval.
            before = around[live, _REACH - level].astype(np.int64)
            label = interval * 256 + before
            turn = np.argsort(label, kind="stable")
            live, label = live[turn], label[turn]
            interval = np.cumsum(np.concatenate([[0], label[1:] != label[:-1]]).astype(np.int64))
        size = np.bincount(interval)
        shared = (size[interval] > 1) & (high[live] >= level)
        live, interval = live[shared], interval[shared]
        if not len(live):
            break
        due = low[live] <= level
        some, group = live[due], interval[due]
        if len(some) < 2:
            continue
        near = np.zeros(len(some), bool)
        near[1:] = group[1:] == group[:-1]
        second = np.flatnonzero(near)
        near[second] = least.between(some[second - 1], some[second]) >= LENGTH - level
        heads = np.flatnonzero(~near)
        first = np.minimum.reduceat(age[some], heads)
        late = age[some] != np.repeat(first, np.diff(np.concatenate([heads, [len(some)]])))
        rows.append(some[late])
        levels.append(np.full(int(late.sum()), level))
    if not rows:
        return (np.zeros(0, np.int64),) * 3
    row, level = np.concatenate(rows), np.concatenate(levels)
    turn = np.lexsort((level, row))
    row, level = row[turn], level[turn]
    cut = np.flatnonzero((np.diff(row) != 0) | (np.diff(level) != 1)) + 1
    first = np.concatenate([[0], cut]).astype(np.int64) if len(row) else np.zeros(0, np.int64)
    last = np.concatenate([cut, [len(row)]]).astype(np.int64) - 1 if len(row) else np.zeros(0, np.int64)
    r = row[first]
    return k[r], place[r] - level[last], place[r] - level[first] + LENGTH


def _expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = []
    for batch in batches:
        if batch.num_rows:
            blob = batch.column(2).cast(pa.binary())
            begin = np.frombuffer(blob.buffers()[1], np.int32)[blob.offset]
            raw = np.frombuffer(blob.buffers()[2], np.uint8)[begin : begin + batch.num_rows * (_REACH + LENGTH)]
            parts.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), raw.reshape(batch.num_rows, -1)))
    if parts:
        k, begin, end = expand(*(np.concatenate(c) for c in zip(*parts)))
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(begin), pa.array(end)], ["k", "s", "e"])


_SPAN = "k bigint, s bigint, e bigint"


def _hot_spans(rows: DataFrame) -> DataFrame:
    """Removed ranges among rows of frequent anchors, without meeting in one task."""
    bounds = F.col("at").bitwiseAND(F.lit((1 << 14) - 1)).alias("bounds")
    digest = F.md5(F.col("around")).alias("digest")
    marked = stored(rows.select("h", "k", "at", "around", bounds, digest), "suffix-hot")
    same = ["h", "bounds", "digest"]
    first = stored(marked.groupBy(*same).agg(F.min(F.struct("k", "at")).alias("f")), "suffix-first")
    joined = lookup(marked, first, same)
    low = F.shiftright("bounds", 7).bitwiseAND(F.lit(127))
    high = F.col("bounds").bitwiseAND(F.lit(127))
    place = F.shiftright("at", 14)
    leads = (F.col("k") == F.col("f.k")) & (F.col("at") == F.col("f.at"))
    whole = joined.where(~leads).select("k", (place - high).alias("s"), (place - low + LENGTH).alias("e"))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, at, around in zip(*(batch.column(i).to_pylist() for i in range(3))):
                place, low, high = (int(x) for x in unpacked(np.array(at)))
                for a in range(low, high + 1):
                    window = around[_REACH - a : _REACH - a + LENGTH]
                    out.append((xxhash.xxh3_128_digest(window), key, place - a))
            names, keys, starts = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array(keys, pa.int64()), pa.array(starts, pa.int64())],
                ["w", "k", "s"],
            )

    each = stored(
        joined.where(leads)
        .select("k", "at", "around")
        .mapInArrow(windows, "w binary, k bigint, s bigint"),
        "suffix-windows",
    )
    counted = each.groupBy("w").agg(F.min(F.struct("k", "s")).alias("f"), F.count("*").alias("n"))
    repeated = stored(counted.where("n > 1").select("w", "f"), "suffix-repeated")
    later = lookup(each, repeated, ["w"]).where((F.col("k") != F.col("f.k")) | (F.col("s") != F.col("f.s")))
    return whole.unionByName(later.select("k", "s", (F.col("s") + LENGTH).alias("e")))


def _keyed(df: DataFrame, row_id: str, text: str) -> tuple[DataFrame, bool]:
    """``df`` with ``__k``: a number per document in document order; whether rows can share one."""
    ids = F.col(f"`{row_id}`").cast("bigint")
    odd = df.groupBy(ids.alias("i")).agg(F.count("*").alias("n")).where("n > 1 OR i IS NULL")
    if odd.isEmpty():
        return df.withColumn("__k", ids), False
    # Ids that repeat or are missing: number the distinct (id, text digest) pairs in order.
    digest = F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    pairs = df.select(ids.alias("__i"), digest.alias("__d")).distinct()
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = pairs.repartitionByRange(width, F.col("__i").asc_nulls_first(), F.col("__d"))
    ordered = ordered.sortWithinPartitions(F.col("__i").asc_nulls_first(), F.col("__d"))
    numbered = stored(ordered.withColumn("__k", F.monotonically_increasing_id()), "suffix-order")
    with_digest = df.withColumn("__d", digest).withColumn("__i", ids)
    named = numbered.withColumnsRenamed({"__i": "__i2", "__d": "__d2"})
    match = (F.col("__d") == F.col("__d2")) & F.col("__i").eqNullSafe(F.col("__i2"))
    return with_digest.join(named, match).drop("__d", "__i", "__d2", "__i2"), True


def removed_spans(docs: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Byte ranges (k, s, e), possibly overlapping, to remove from ``docs`` (k, text)."""
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = docs.select("k", "text").mapInArrow(_anchor_rows, "h bigint, k bigint, at bigint, role tinyint")
    free = F.xxhash64("h", "k", "at")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(width, -(-size // BYTES_PER_TASK))
    dealt = runs.repartition(tasks, F.when(F.col("role") == KNOWN, free).otherwise(F.col("h")))
    candidates = stored(dealt.mapInArrow(_repeated, "h bigint, k bigint, at bigint"), "suffix-anchors")
    hot = stored(
        candidates.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > hot_rows).select("h"),
        "suffix-hot-anchors",
    )
    n = candidates.count()
    listed = candidates.groupBy("k").agg(F.collect_list(F.struct("h", "at")).alias("a"))
    around = (
        docs.select("k", "text")
        .join(listed, "k")
        .mapInArrow(_surroundings, "h bigint, k bigint, at bigint, around binary")
    )
    tasks = max(width, -(-n // ROWS_PER_TASK))

    def spans(rows: DataFrame) -> DataFrame:
        dealt = rows.select("k", "at", "around", "h").repartition(tasks, "h").drop("h")
        return dealt.mapInArrow(_expanded, _SPAN)

    if hot.isEmpty():
        return stored(spans(around), "suffix-spans")
    around = stored(around, "suffix-around")
    usual = spans(lookup(around, hot, ["h"], "left_anti"))
    return stored(usual.unionByName(_hot_spans(lookup(around, hot, ["h"], "left_semi"))), "suffix-spans")


def merged(spans: list) -> list[tuple[int, int]]:
    """Maximal runs of removed bytes."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def whole_characters(data: bytes, runs: list[tuple[int, int]]) -> str:
    """The text without the characters that lie wholly inside a removed run."""
    kept, at = [], 0
    for s, e in runs:
        while s < e and data[s] & 0xC0 == 0x80:
            s += 1
        while e < len(data) and e > s and data[e] & 0xC0 == 0x80:
            e -= 1
        kept.append(data[at:s])
        at = max(e, s)
    kept.append(data[at:])
    return b"".join(kept).decode("utf-8", "replace")


_CUT = T.StructType(
    [
        T.StructField("kept", T.BinaryType()),
        T.StructField("text", T.StringType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
    ]
)


@F.pandas_udf(_CUT)
def cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    out = []
    for text, ranges in zip(texts, spans):
        data = (text or "").encode("utf-8", "surrogatepass")
        runs = merged([(r["s"], r["e"]) for r in ranges]) if ranges is not None else []
        kept, at = [], 0
        for s, e in runs:
            kept.append(data[at:s])
            at = e
        kept.append(data[at:])
        whole = text if not runs else whole_characters(data, runs)
        out.append((b"".join(kept), whole, len(data), sum(e - s for s, e in runs), len(runs)))
    return pd.DataFrame(out, columns=[f.name for f in _CUT])


def deduplicate(
    df: DataFrame, row_id: str = "doc_id", text: str = "text", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``df`` with ``__cut``: kept bytes, kept text (whole characters), and counts."""
    keyed, shared = _keyed(df, row_id, text)
    docs = keyed.select(F.col("__k").alias("k"), F.col(f"`{text}`").alias("text"))
    if shared:
        # A document listed several times is no repetition of itself.
        docs = stored(docs.dropDuplicates(["k"]), "suffix-documents")
    spans = removed_spans(docs, hot_rows)
    listed = spans.groupBy(F.col("k").alias("__k")).agg(F.collect_list(F.struct("s", "e")).alias("__spans"))
    joined = keyed.join(listed, "__k", "left")
    rest: list[Column] = [F.col(f"`{c}`") for c in df.columns]
    return joined.select(*rest, cut(F.col(f"`{text}`"), F.col("__spans")).alias("__cut"))
