"""Removal of word sequences that an earlier document has, by prefix-partitioned suffix trees.

A window is 13 consecutive words of one document. Every word of a window whose word sequence also
starts in a document with a smaller id is removed.

*Copies.* Documents with equal texts are folded first: the one with the least id stands for all,
the others lose every word (if they have a window at all). Texts are known by a 128-bit digest.

*Sampled suffixes.* Of the six 8-word strings in a window the one with the least hash is its
anchor. Equal windows have the same anchor at the same place, so trees over the suffixes that
start at anchors (and the words before them) find all equal windows.

*Prefixes.* Suffixes are partitioned by their prefix. One exchange of (prefix, document) drops the
prefixes that one text alone has; a prefix met twice in a batch is known to repeat before it,
so a frequent one reaches its task as one row per batch. What is left is dealt out by prefix, in
as many tasks as its number asks for.

*Subtrees.* A task numbers its words, sorts its suffixes and takes the common prefixes of
neighbours: the intervals of suffixes with at least d common words are the internal nodes of depth
d. The same over the words before the anchor, read backward, gives the nodes to the left. Windows
that reach o words to the left are equal if they share a right node of depth 13 - o and a left
node of depth o; the least document of each such pair is what the others are judged by. Whole
words are compared; hashes only choose anchors and partitions.

*Long prefixes.* A prefix with more than ``HOT_ROWS`` suffixes is lengthened to all 13 words from
the start of each window. Its subtree is then a single node, whose least document an aggregate
finds that combines before the shuffle, by a 128-bit digest of the window.

Defined cases: a null text has no words; words of one document never match itself; rows with one
id are documents of equal rank, which do not judge each other; a null id comes after all others;
texts under 13 words stay; an empty table stays empty; further columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from wharf.llm.common import scratch, stored
from wharf.plans.joins import lookup

WINDOW = 13
PREFIX = 8
#: Most words of a window before its anchor.
REACH = WINDOW - PREFIX
#: Suffixes of one prefix that may meet in one task.
HOT_ROWS = 50_000
#: Suffixes that one task holds with their words (about 130 bytes each).
ROWS_PER_TASK = 60_000
#: Suffixes of one document whose equal surroundings are folded together.
FOLDED = 1 << 16
#: Bytes of text for each task that compares prefixes (about one of 24 bytes for 14 of them).
BYTES_PER_TASK = 32 << 20
#: Bytes of a text that are split into words at once, and windows that are looked at together.
BLOCK = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LAST = (1 << 63) - 1


def blocks(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a block at a time."""
    at = 0
    while at < len(data):
        space = _SPACE.search(data, at + BLOCK)
        end = space.start() if space else len(data)
        yield data[at:end].split()
        at = end


def places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the words of a text."""
    space = np.ones(len(data) + 2, bool)
    space[1:-1] = _IS_SPACE[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(space[1:] != space[:-1])
    return edges[::2], edges[1::2]


def word_hashes(data: bytes) -> np.ndarray:
    made = [np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) for words in blocks(data)]
    return np.concatenate(made) if made else np.zeros(0, np.uint64)


def _sliding(values: np.ndarray, pick: Callable) -> np.ndarray:
    """Least or greatest of each REACH + 1 neighbours."""
    held = 1
    while held <= REACH:
        step = min(held, REACH + 1 - held)
        values = pick(values[:-step], values[step:])
        held += step
    return values


def anchors(hashes: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the anchors among the words, ascending, and the hashes of their prefixes.

    ``inside`` tells for each of the windows whether it counts (lies in one document).
    """
    n = len(hashes) - WINDOW + 1
    found, prefixes = [], []
    for at in range(0, n, BLOCK):
        last = min(at + BLOCK, n)
        part = hashes[at : last + WINDOW - 1]
        grams = np.zeros(len(part) - PREFIX + 1, np.uint64)
        for i in range(PREFIX):
            grams = (grams ^ part[i : i + len(grams)]) * np.uint64(0x9E3779B97F4A7C15)
            grams ^= grams >> np.uint64(29)
        least = _sliding(grams, np.minimum)
        if inside is not None:
            least[~inside[at:last]] = 0
        edge = np.zeros(REACH, np.uint64)
        chosen = _sliding(np.concatenate([edge, least, edge]), np.maximum) == grams
        # A prefix whose hash is zero would be met outside of windows too; it only adds anchors.
        where = np.flatnonzero(chosen)
        found.append(where + at)
        prefixes.append(grams[where])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    position, first = np.unique(np.concatenate(found), return_index=True)
    return position, np.concatenate(prefixes)[first]


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(documents, sizes, word hashes) of a batch, a few megabytes of text at a time."""
    ks, sizes, hashes, held = [], [], [], 0
    for k, value in zip(batch.column(0).to_pylist(), batch.column(1)):
        data = value.as_py() or b""
        made = word_hashes(data)
        ks.append(k)
        sizes.append(len(made))
        hashes.append(made)
        held += len(made)
        if held >= BLOCK:
            yield np.array(ks, np.int64), np.array(sizes), np.concatenate(hashes)
            ks, sizes, hashes, held = [], [], [], 0
    if ks:
        yield np.array(ks, np.int64), np.array(sizes), np.concatenate(hashes)


_PREFIX_ROW = "h bigint, k bigint, m bigint, known boolean"


def _prefix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(prefix, text, suffixes of it there); ``known`` if two texts of the batch have it.

    One row of each known prefix is also sent as not known, to meet those of other batches.
    """
    for batch in batches:
        for k, sizes, hashes in _groups(batch):
            if len(hashes) < WINDOW:
                continue
            of = np.repeat(np.arange(len(k)), sizes)
            inside = of[: len(of) - WINDOW + 1] == of[WINDOW - 1 :]
            position, prefix = anchors(hashes, inside)
            if not len(position):
                continue
            doc = k[of[position]]
            order = np.lexsort((doc, prefix))
            prefix, doc = prefix[order], doc[order]
            first = np.flatnonzero(
                np.concatenate([[True], (prefix[1:] != prefix[:-1]) | (doc[1:] != doc[:-1])])
            )
            m = np.diff(np.append(first, len(prefix)))
            prefix, doc = prefix[first], doc[first]
            same = np.zeros(len(prefix) + 1, bool)
            same[1:-1] = prefix[1:] == prefix[:-1]
            known = same[:-1] | same[1:]
            sent = np.flatnonzero(known & ~same[:-1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([prefix, prefix[sent]]).view(np.int64)),
                    pa.array(np.concatenate([doc, doc[sent]])),
                    pa.array(np.concatenate([m, np.zeros(len(sent), np.int64)]).astype(np.int64)),
                    pa.array(np.concatenate([known, np.zeros(len(sent), bool)])),
                ],
                ["h", "k", "m", "known"],
            )


_SHARED_ROW = "h bigint, k bigint, m bigint"


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows whose prefix at least two texts have."""
    held = []
    for batch in batches:
        known = batch.column(3).to_numpy(zero_copy_only=False)
        columns = [batch.column(i).to_numpy() for i in range(3)]
        if known.any():
            yield pa.RecordBatch.from_arrays([pa.array(c[known]) for c in columns], ["h", "k", "m"])
        held.append([c[~known] for c in columns])
    if not held:
        return
    h, k, m = (np.concatenate(c) for c in zip(*held))
    held.clear()
    order = np.lexsort((m, k, h))
    h, k, m = h[order], k[order], m[order]
    # A text listed several times counts once.
    last = np.append((h[1:] != h[:-1]) | (k[1:] != k[:-1]), True)
    h, k, m = h[last], k[last], m[last]
    same = np.zeros(len(h) + 1, bool)
    same[1:-1] = h[1:] == h[:-1]
    # Rows that only stand for known ones (m = 0) have been passed on already.
    keep = (same[:-1] | same[1:]) & (m > 0)
    if keep.any():
        yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (h, k, m)], ["h", "k", "m"])


_SUFFIX_ROW = "h bigint, d binary, r bigint, at binary, before int, words binary"


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shared prefixes with the words around them; equal surroundings of a document are one row."""
    for batch in batches:
        rows: list[tuple] = []
        size = 0
        for i in range(batch.num_rows):
            d, r = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            data = batch.column(2)[i].as_py() or b""
            wanted = np.sort(batch.column(3)[i].values.to_numpy().view(np.uint64))
            position, prefix = anchors(word_hashes(data))
            near = np.searchsorted(wanted, prefix).clip(max=len(wanted) - 1)
            chosen = wanted[near] == prefix
            starts, ends = places(data)
            at_of, prefix_of = position[chosen], prefix[chosen].view(np.int64)
            for part in range(0, len(at_of), FOLDED):
                # Equal surroundings of one document have equal windows.
                folded: dict[tuple, list[int]] = {}
                few = slice(part, part + FOLDED)
                for at, h in zip(at_of[few].tolist(), prefix_of[few].tolist()):
                    low, high = max(at - REACH, 0), min(at + WINDOW, len(starts))
                    around = b" ".join(data[starts[low] : ends[high - 1]].split())
                    folded.setdefault((h, at - low, around), []).append(at)
                for (h, before, around), at in folded.items():
                    rows.append((h, d, r, np.array(at, np.int64).tobytes(), before, around))
                    size += len(around) + 8 * len(at)
                    if size >= 1 << 23:
                        yield _suffix_batch(rows)
                        rows, size = [], 0
        if rows:
            yield _suffix_batch(rows)


def _suffix_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, ["h", "d", "r", "at", "before", "words"])


def numbered(before: list[int], words: list[bytes]) -> np.ndarray:
    """One row of word numbers for each suffix: REACH words before its start, 13 from it on.

    Words that are not there are -1. Numbers hold within the call.
    """
    number: dict[bytes, int] = {}
    out = np.full((len(words), REACH + WINDOW), -1, np.int64)
    for i, (left, around) in enumerate(zip(before, words)):
        ids = [number.setdefault(w, len(number)) for w in around.split()]
        out[i, REACH - left : REACH - left + len(ids)] = ids
    return out


def nodes(strings: np.ndarray) -> np.ndarray:
    """Node of each row at each depth of the tree of ``strings`` (rows of word numbers).

    Column d names the node of depth d above the row: the interval, in sorted order, of rows with
    at least d common words.
    """
    order = np.lexsort(strings.T[::-1])
    placed = strings[order]
    common = np.logical_and.accumulate(placed[1:] == placed[:-1], axis=1).sum(axis=1)
    out = np.zeros((len(strings), strings.shape[1] + 1), np.int64)
    for depth in range(1, out.shape[1]):
        out[order[1:], depth] = np.cumsum(common < depth)
    return out


def repeated_windows(tokens: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each suffix a bit for each o: the window from o words before it is in a lesser document."""
    right, left = nodes(tokens[:, REACH:]), nodes(tokens[:, :REACH][:, ::-1])
    bits = np.zeros(len(tokens), np.int64)
    for o in range(REACH + 1):
        whole = np.flatnonzero(
            (tokens[:, REACH - o] >= 0) & (tokens[:, REACH + WINDOW - o - 1] >= 0)
        )
        if not len(whole):
            continue
        pair = right[whole, WINDOW - o] * len(tokens) + left[whole, o]
        _, node = np.unique(pair, return_inverse=True)
        least = np.full(node.max() + 1, _LAST)
        np.minimum.at(least, node, rank[whole])
        bits[whole[rank[whole] > least[node]]] |= 1 << o
    return bits


_FOUND_ROW = "d binary, at bigint, bits bigint"


def _found(d: list[bytes], at: list[bytes], bits: np.ndarray) -> pa.RecordBatch:
    hit = np.flatnonzero(bits)
    positions = [np.frombuffer(at[i], np.int64) for i in hit]
    sizes = [len(p) for p in positions]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([d[i] for i, size in zip(hit, sizes) for _ in range(size)], pa.binary()),
            pa.array(np.concatenate(positions) if positions else np.zeros(0, np.int64)),
            pa.array(np.repeat(bits[hit], sizes)),
        ],
        ["d", "at", "bits"],
    )


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if b.num_rows]
    if held:
        rows = pa.Table.from_batches(held)
        held.clear()
        tokens = numbered(rows["before"].to_pylist(), rows["words"].to_pylist())
        bits = repeated_windows(tokens, rows["r"].to_numpy())
        yield _found(rows["d"].to_pylist(), rows["at"].to_pylist(), bits)


_WINDOW_ROW = "w binary, d binary, r bigint, at binary, bits bigint"


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every whole window around the suffixes of a frequent prefix, by its digest."""
    for batch in batches:
        out: list[tuple] = []
        rows = zip(*(batch.column(name).to_pylist() for name in ("d", "r", "at", "before", "words")))
        for d, r, at, before, around in rows:
            words = around.split()
            for o in range(before + 1):
                window = words[before - o : before - o + WINDOW]
                if len(window) == WINDOW:
                    digest = xxhash.xxh3_128_digest(b" ".join(window))
                    out.append((digest, d, r, at, 1 << o))
        if out:
            kinds = [pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["w", "d", "r", "at", "bits"])


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield _found(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_numpy())


def found_windows(texts: DataFrame, copies: DataFrame, size: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Windows that a lesser document has: ``d, at, bits`` (bit o: it starts o words before ``at``).

    ``texts`` has the digest ``d``, its short form ``k``, the rank ``r`` and ``text`` as bytes;
    ``copies`` tells of digests with several rows which rank stands for them. ``size`` is the
    number of bytes of all texts, by which tasks are sized.
    """
    width = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = texts.select("k", "text").mapInArrow(_prefix_rows, _PREFIX_ROW)
    anywhere = F.xxhash64("h", "k")
    dealt = rows.repartition(
        max(width, -(-size // BYTES_PER_TASK)), F.when(F.col("known"), anywhere).otherwise(F.col("h"))
    )
    shared = stored(dealt.mapInArrow(_shared, _SHARED_ROW), "substring-prefixes", free=True)
    # Known prefixes of a text listed in several batches come several times.
    shared = stored(shared.groupBy("h", "k").agg(F.max("m").alias("m")), "substring-shared")
    total = shared.agg(F.sum("m")).first()[0] or 0
    often = shared.groupBy("h").agg(F.sum("m").alias("n")).where(F.col("n") > hot_rows)
    hot = stored(often.select("h"), "substring-long")
    listed = shared.groupBy("k").agg(F.collect_list("h").alias("hs"))
    # Digests that share their short form: one, but for chance.
    of_copies = copies.groupBy("k").agg(F.collect_list(F.struct("d", "least", "twice")).alias("copies"))
    own = F.get(F.filter("copies", lambda c: c["d"] == F.col("d")), F.lit(0))
    docs = (
        texts.join(listed.join(of_copies, "k", "left"), "k")
        .select("d", "r", "text", "hs", own.alias("own"))
        .where(F.col("own").isNull() | (F.col("r") == F.col("own.least")))
    )
    columns = ["d", "r", "text", "hs"]
    if not copies.where("twice").isEmpty():
        # A document listed several times is read once.
        again = F.coalesce(F.col("own.twice"), F.lit(False))
        docs = docs.where(~again).unionByName(docs.where(again).dropDuplicates(["d"]))
    suffixes = docs.select(*columns).mapInArrow(_suffixes, _SUFFIX_ROW)
    tasks = max(width, -(-total // ROWS_PER_TASK))

    def grown(part: DataFrame) -> DataFrame:
        return part.repartition(tasks, "h").mapInArrow(_subtrees, _FOUND_ROW)

    if hot.isEmpty():
        return grown(suffixes)
    suffixes = stored(suffixes, "substring-suffixes", free=True)
    windows = stored(
        lookup(suffixes, hot, ["h"], "left_semi").mapInArrow(_windows, _WINDOW_ROW), "substring-hot"
    )
    least = stored(
        windows.groupBy("w").agg(F.min("r").alias("least"), F.max("r").alias("most")).where("least < most"),
        "substring-least",
    )
    judged = lookup(windows, least.select("w", "least"), ["w"]).where(F.col("r") > F.col("least"))
    long = judged.select("d", "at", "bits").mapInArrow(_placed, _FOUND_ROW)
    usual = grown(lookup(suffixes, hot, ["h"], "left_anti"))
    return usual.unionByName(long)


_CUT = T.StructType(
    [
        T.StructField("kept", T.StringType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField(
            "spans",
            T.ArrayType(
                T.StructType([T.StructField("s", T.LongType()), T.StructField("e", T.LongType())])
            ),
        ),
    ]
)


def removed_words(n: int, at: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which of ``n`` words the found windows cover."""
    change = np.zeros(n + 1, np.int64)
    for o in range(REACH + 1):
        start = at[(bits >> o) & 1 == 1] - o
        np.add.at(change, start, 1)
        np.add.at(change, start + WINDOW, -1)
    return np.cumsum(change[:-1]) > 0


@F.arrow_udf(_CUT)
def cut(texts: pa.Array, whole: pa.Array, found: pa.Array) -> pa.Array:
    out = []
    for text, everything, windows in zip(texts, whole, found):
        data = text.as_py() or b""
        starts, ends = places(data)
        n = len(starts)
        if everything.as_py() and n >= WINDOW:
            gone = np.ones(n, bool)
        elif windows.is_valid:
            at, bits = (windows.values.field(i).to_numpy() for i in range(2))
            gone = removed_words(n, at, bits)
        else:
            gone = np.zeros(n, bool)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
        spans = [{"s": int(s), "e": int(e)} for s, e in zip(edges[::2], edges[1::2])]
        # Words between two removed runs are one stretch of the text.
        low, high = np.append(0, edges[1::2]), np.append(edges[::2], n)
        parts = [b" ".join(data[starts[a] : ends[b - 1]].split()) for a, b in zip(low, high) if a < b]
        kept = b" ".join(parts).decode("utf-8", "replace")
        out.append({"kept": kept, "n_words": n, "n_removed": int(gone.sum()), "spans": spans})
    return pa.array(out, to_arrow_type(_CUT))


def deduplicate(
    df: DataFrame, row_id: str = "doc_id", text: str = "text", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Two columns: ``row``, the row of ``df`` as it is, and ``cut``: what is left of its text.

    ``cut`` has ``kept`` (the words left, joined by one space), ``n_words``, ``n_removed`` and
    ``spans``, the maximal runs of removed words.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    data = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b""))
    digest = F.unhex(F.substring(F.sha2(data, 256), 1, 32))
    rank = F.coalesce(F.col(f"`{row_id}`").cast("bigint"), F.lit(_LAST))
    texts = df.select(digest.alias("d"), rank.alias("r"), data.alias("text")).select(
        "d", F.xxhash64("d").alias("k"), "r", "text"
    )
    listed = texts.groupBy("d", "k", "r").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")
    )
    grouped = stored(
        listed.groupBy("d", "k").agg(
            F.min(F.struct("r", "n")).alias("first"), F.count("*").alias("c"), F.sum("size").alias("size")
        ),
        "substring-digests",
    )
    size = grouped.agg(F.sum("size")).first()[0] or 0
    several = (F.col("c") > 1) | (F.col("first.n") > 1)
    copies = stored(
        grouped.where(several).select(
            "d", "k", F.col("first.r").alias("least"), (F.col("first.n") > 1).alias("twice")
        ),
        "substring-copies",
    )
    with scratch(df.sparkSession) as keep:
        found = keep(found_windows(texts, copies, size, hot_rows), "substring-found", free=True)
    windows = found.groupBy("d").agg(F.collect_list(F.struct("at", "bits")).alias("found"))
    known = windows.join(copies.select("d", "least"), "d", "full")
    judged = df.select(row, digest.alias("d"), rank.alias("r")).join(known, "d", "left")
    whole = F.coalesce(F.col("r") > F.col("least"), F.lit(False))
    return judged.select(
        "row", cut(F.col("row").getField(text).cast("binary"), whole, "found").alias("cut")
    )
