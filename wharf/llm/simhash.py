"""Near-duplicates by 64-bit SimHash fingerprints and Golay-code fuzzy keys.

A fingerprint is cut into three segments. At most four differing bits in all leave two segments
with at most two differing bits together, and a Golay key set tolerates two bits; so two
linked fingerprints share a key (pair of segments, codeword index, codeword index). Equal
fingerprints are folded first. Distinct ones meet by key, candidates are verified on all 64
bits, each partition reports a spanning forest of its links (never all pairs of a group), and
components are joined over all partitions.

Defined cases: a null, empty or blank text has fingerprint zero and is linked like any other;
repeated rows share a fingerprint; a null id never becomes a component id while the component
has another; an empty table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wharf.llm import golay
from wharf.llm.common import stored
from wharf.llm.components import components
from wharf.plans.joins import lookup

SHINGLE = 4
SEED = 42
MOST_BITS = 4
#: Words of a text that are taken apart at once.
WORDS_AT_ONCE = 1 << 15
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Low bit and width of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Key rows that one task compares (16 bytes each).
KEYS_PER_TASK = 1_000_000
#: Fingerprints that one task expands to their keys, and distinct ones of a key that meet in one task.
PRINTS_PER_TASK = 100_000
HOT_ROWS = 20_000


def word_blocks(text: bytes, size: int) -> Iterator[list[bytes]]:
    """Words of ``text`` in blocks; each ends with the ``size - 1`` words that follow it.

    So every shingle lies in exactly one block, and only one block of words is held at a time.
    """
    space = _SPACE[np.frombuffer(text, np.uint8)]
    first = ~space
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    for at in range(0, max(len(starts) - size + 1, 1), WORDS_AT_ONCE):
        after = at + WORDS_AT_ONCE + size - 1
        low = starts[at] if len(starts) else len(text)
        yield text[low : starts[after] if after < len(starts) else len(text)].split()


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Unsigned SimHash of one text over word shingles."""
    digest = xxhash.xxh64_intdigest
    total, n = np.zeros(64, np.int64), 0
    for words in word_blocks((text or "").encode("utf-8", "surrogatepass").lower(), size):
        if not words:
            return 0
        last = max(len(words) - size + 1, 1)
        hashes = np.fromiter(
            (digest(b" ".join(words[i : i + size]), SEED) for i in range(last)), np.uint64, last
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(0, dtype=np.int64)
        n += last
    return sum(1 << int(b) for b in np.flatnonzero(2 * total > n))


@F.pandas_udf(T.LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    made = np.fromiter((fingerprint(t) for t in texts), np.uint64, len(texts))
    return pd.Series(made.view(np.int64))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def fuzzy_keys(fps: np.ndarray, made: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(key, position in ``fps``) for every fuzzy key of every fingerprint."""
    raw = fps.view(np.uint64)
    near = [
        golay.keys(((raw >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64), made)
        for low, width in SEGMENTS
    ]
    keys, at = [], []
    for pair, (i, j) in enumerate(combinations(range(len(SEGMENTS)), 2)):
        left, right = near[i][:, :, None], near[j][:, None, :]
        valid = (left >= 0) & (right >= 0)
        where = np.nonzero(valid)
        keys.append(((pair << 24) | (left << 12) | right)[where])
        at.append(where[0])
    return np.concatenate(keys), np.concatenate(at)


class _Forest:
    """Least reachable position, kept while links come in batches."""

    def __init__(self, size: int):
        self.least = np.arange(size)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.least[a], self.least[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            low = np.minimum(ra, rb)
            np.minimum.at(self.least, ra, low)
            np.minimum.at(self.least, rb, low)
            while True:
                jumped = self.least[self.least]
                if np.array_equal(jumped, self.least):
                    break
                self.least = jumped


def forest_links(keys: np.ndarray, fps: np.ndarray, most: int = MOST_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, least fingerprint reachable) among those that share a key.

    Only pairs within ``most`` bits count. Neighbours of a key are compared at growing
    distance in the sorted order, so memory stays linear however large a key's group is.
    """
    order = np.lexsort((fps, keys))
    keys, fps = keys[order], fps[order]
    distinct, vertex = np.unique(fps, return_inverse=True)
    forest = _Forest(len(distinct))
    left = np.arange(len(keys))
    shift = 1
    while len(left):
        left = left[left + shift < len(keys)]
        left = left[keys[left] == keys[left + shift]]
        right = left + shift
        close = np.bitwise_count((fps[left] ^ fps[right]).view(np.uint64)) <= most
        forest.add(vertex[left[close]], vertex[right[close]])
        shift += 1
    moved = np.flatnonzero(forest.least != np.arange(len(distinct)))
    return distinct[moved], distinct[forest.least[moved]]


def links(distinct: DataFrame, most: int = MOST_BITS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Links (a, b) that connect all of ``distinct`` (column fp) within ``most`` bits.

    A key of more than ``hot_rows`` distinct fingerprints (those of a template, say) is compared in
    pairs of blocks, by many tasks.
    """
    n = distinct.count()

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = golay.tables()
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            keys, at = fuzzy_keys(fps, made)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[at])], ["key", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if parts:
            a, b = forest_links(*(np.concatenate(c) for c in zip(*parts)), most)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    configured = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(configured, -(-n * 82 // KEYS_PER_TASK))
    # Few input files would make few tasks of the expansion.
    spread = distinct.select("fp").repartition(max(configured, -(-n // PRINTS_PER_TASK)))
    keyed = spread.mapInArrow(expand, "key bigint, fp bigint")
    usual, hot = keyed, None
    if n > hot_rows:
        counts = stored(keyed.groupBy("key").agg(F.count("*").alias("g")).where(F.col("g") > hot_rows), "hot-keys")
        if not counts.isEmpty():
            usual = lookup(keyed, counts.select("key"), ["key"], "left_anti")
            hot = _block_pairs(lookup(keyed, counts, ["key"]), hot_rows)
    found = usual.repartition(tasks, "key").mapInArrow(compare, "a bigint, b bigint")
    if hot is None:
        return found
    return found.unionAll(hot.repartition(tasks, "key").mapInArrow(compare, "a bigint, b bigint"))


def _block_pairs(keyed: DataFrame, hot_rows: int) -> DataFrame:
    """Rows (key, fp) of keys with ``g`` fingerprints, dealt out so that each two of a key meet.

    A key is cut into blocks, and every pair of blocks is a key of its own with a bounded number of
    rows; a row goes to the pairs of its block.
    """
    blocks = F.greatest(F.ceil(F.col("g") * 2 / F.lit(hot_rows)), F.lit(2)).cast("bigint")
    own = keyed.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    others = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    pair = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    return others.select(pair.alias("key"), "fp")


def near_duplicates(prints: DataFrame, row_id: str = "doc_id") -> DataFrame:
    """``prints`` (with a column fp) plus component_id, the smallest id reachable.

    A column of that name is replaced.
    """
    prints = prints.select(*[F.col(f"`{c}`") for c in prints.columns if c != "component_id"])
    distinct = stored(
        prints.groupBy("fp").agg(F.min(f"`{row_id}`").alias("__least")), "fingerprints"
    )
    joined = components(links(distinct))
    rooted = distinct.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("__root"), "__least"
    )
    least = rooted.groupBy("__root").agg(F.min("__least").alias("component_id"))
    named = stored(rooted.join(least, "__root").select("fp", "component_id"), "components")
    return lookup(prints, named, ["fp"])
