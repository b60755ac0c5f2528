"""Spelling variants of a corpus vocabulary, by asymmetric q-chunks.

*Vocabulary.* Words are counted within a batch before they are shuffled; frequent words with at
least six letters stay. All further work is on the vocabulary.

*Chunks.* Two words are near if one edit (insert, delete, replace) leads from one to the other. The
shorter one (either, at equal length) gives two disjoint chunks, its first and its last half. One
edit spoils at most one of them. The other word gives its grams of that length at the places where a
chunk can be after one edit, that is, moved by at most one: from its start, and up to its end.
Words that share a chunk meet in an equi-join and are verified by their edit distance.

*Frequent chunks.* Where a chunk would bring more than ``CANDIDATES`` pairs together, what it leaves
open is cut into two halves again, one of which an edit must leave whole too, and so on until few
words meet or a single letter is open. So no common beginning or ending makes all its words meet,
and no pair is lost. A pair that would be met by both halves counts at the first one only.

*Forms.* A word's form is its most frequent near word, if that is far more frequent. Counts grow
along forms, so chains end; roots are found by doubling the length of the pointers.

Defined cases: a null or empty text has no words; a null id is written as nothing before the colon;
repeated rows count as often as they come; among equally frequent near words the first in
code-point order is taken; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from math import ceil, log, log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wharf.llm.common import scratch, stored
from wharf.plans.joins import lookup

SHORTEST, LEAST = 6, 5
#: How many times as frequent as a word its form is.
RATIO = 5
#: One occurrence in so many is misspelt on purpose (by its digest).
MISSPELT = 199
#: Pairs that one chunk may bring together before it is cut further.
CANDIDATES = 4096
#: Characters of a text that are split into words at once; words a batch holds before it sends them.
BLOCK, HELD = 1 << 20, 1 << 18

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_NO_RUN = re.compile("[^A-Za-zÀ-ÿ]")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def runs(text: str) -> Counter[str]:
    """The lower-cased runs of letters of one text."""
    raw: Counter[str] = Counter()
    at = 0
    while at < len(text):
        gap = _NO_RUN.search(text, at + BLOCK)
        end = gap.start() if gap else len(text)
        raw.update(_RUN.findall(text, at, end))
        at = end
    out: Counter[str] = Counter()
    for run, n in raw.items():
        out[run.lower() if run.isascii() else run.translate(_LOWER)] += n
    return out


def spelt(doc_id: str, run: str) -> str:
    """The run as the contract has it: without one letter where its digest says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % MISSPELT:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def send(held: Counter[str]) -> pa.RecordBatch:
        columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    held: Counter[str] = Counter()
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for run, n in runs(text.as_py() or "").items():
                word = spelt(doc_id or "", run)
                if len(word) >= SHORTEST:
                    held[word] += n
            if len(held) >= HELD:
                yield send(held)
                held.clear()
    if held:
        yield send(held)


def vocabulary(documents: DataFrame) -> DataFrame:
    """``word, n`` of the words that count, from ``doc_id, text``."""
    texts = documents.select(F.col("doc_id").cast("string"), "text")
    counted = texts.mapInArrow(_counted, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def _first(word: Column, length: Column) -> Column:
    return F.substr(word, F.lit(1), length)


def _last(word: Column, length: Column) -> Column:
    return F.when(length > 0, F.substr(word, F.length(word) - length + 1, length)).otherwise("")


def _open(words: DataFrame) -> DataFrame:
    """Every word in both roles, with nothing matched yet.

    ``size`` is the length of the word that gives chunks; a word gives grams to chunks of its own
    length and of one letter less. ``head`` and ``tail`` letters are matched so far; a pair counts
    if fewer than ``before`` first letters are equal.
    """
    size = F.length("word")
    roles = F.array(
        F.struct(F.lit(True).alias("chunk"), size.alias("size")),
        F.struct(F.lit(False).alias("chunk"), size.alias("size")),
        F.struct(F.lit(False).alias("chunk"), (size - 1).alias("size")),
    )
    return words.select("word", "n", F.inline(roles)).select(
        "*",
        F.lit(1).cast("bigint").alias("path"),
        F.lit(0).alias("head"),
        F.lit(0).alias("tail"),
        F.lit(None).cast("int").alias("before"),
    ).where(F.col("size") >= SHORTEST)


def _cut(rows: DataFrame) -> DataFrame:
    """Each row at the two halves of what is open, with the ``key`` of what is matched then."""
    half = F.floor((F.col("size") - F.col("head") - F.col("tail")) / 2).cast("int")
    parts = F.array(
        F.struct(
            (F.col("path") * 2).alias("path"),
            (F.col("head") + half).alias("head"),
            F.col("tail"),
            F.col("before"),
        ),
        F.struct(
            (F.col("path") * 2 + 1).alias("path"),
            F.col("head"),
            (F.col("tail") + half).alias("tail"),
            F.least("before", F.col("head") + half).alias("before"),
        ),
    )
    cut = rows.select("word", "n", "chunk", "size", F.inline(parts))
    word = F.col("word")
    key = F.xxhash64("size", "path", _first(word, F.col("head")), _last(word, F.col("tail")))
    return cut.withColumn("key", key)


def _met(rows: DataFrame) -> DataFrame:
    """Near words (a, an, b, bn), each pair once, of the rows that share a key."""
    chunks = rows.where("chunk").select(
        "key", "size", "head", "tail", "before", F.col("word").alias("a"), F.col("n").alias("an")
    )
    grams = rows.where("NOT chunk").select("key", F.col("word").alias("b"), F.col("n").alias("bn"))
    a, b = F.col("a"), F.col("b")
    # Keys are digests: the shared halves are compared too, so that a pair counts at one key only.
    shares = F.startswith(b, _first(a, F.col("head"))) & F.endswith(b, _last(a, F.col("tail")))
    elsewhere = F.coalesce(F.startswith(b, _first(a, F.col("before"))), F.lit(False))
    once = (F.length(b) > F.col("size")) | (a < b)
    near = F.levenshtein(a, b, 1) == 1
    met = chunks.join(grams, "key").where(once & shares & ~elsewhere & near)
    return met.select("a", "an", "b", "bn")


def near_words(words: DataFrame, candidates: int = CANDIDATES) -> DataFrame:
    """All pairs of ``words`` (word, n) that differ by one edit: ``a, an, b, bn``, each once."""
    rows, found = _open(words), []
    while True:
        rows = stored(_cut(rows), "spelling-chunks")
        sizes = rows.groupBy("key").agg(
            F.sum(F.col("chunk").cast("bigint")).alias("c"),
            F.sum((~F.col("chunk")).cast("bigint")).alias("g"),
            F.max(F.col("size") - F.col("head") - F.col("tail")).alias("left"),
        )
        # A word that shares its key with itself alone has no partner there.
        sizes = sizes.where("c > 0 AND c * g > 1")
        done = (F.col("c") * F.col("g") <= candidates) | (F.col("left") < 2)
        sizes = stored(sizes.select("key", done.alias("done")), "spelling-sizes")
        rows = lookup(rows, sizes, ["key"])
        found.append(stored(_met(rows.where("done")), "spelling-pairs"))
        rest = sizes.where("NOT done")
        if rest.isEmpty():
            return reduce(DataFrame.unionAll, found)
        rows = rows.where("NOT done").drop("done", "key")


def roots(forms: DataFrame, longest: int) -> DataFrame:
    """The end of the chain of forms of every word that has one: ``word, root``.

    ``forms`` has ``word, form``; chains have at most ``longest`` steps.
    """
    ends = forms.select("word", F.col("form").alias("root"))
    for _ in range(ceil(log2(max(longest, 1)))):
        ends = stored(ends, "spelling-roots")
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        ends = lookup(ends, further, ["root"], "left").select(
            "word", F.coalesce("__next", "root").alias("root")
        )
    return ends


def variants(words: DataFrame, candidates: int = CANDIDATES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a vocabulary (word, n)."""
    words = stored(words, "spelling-words")
    with scratch(words.sparkSession) as keep:
        pairs = keep(near_words(words, candidates), "spelling-near")
    both = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("bn").alias("near_n")),
                F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("an").alias("near_n")),
            )
        )
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")
    )
    joined = words.join(best, "word", "left")
    is_form = -F.col("best.minus") >= RATIO * F.col("n")
    formed = stored(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"),
            F.when(is_form, -F.col("best.minus")).alias("form_n"),
        ),
        "spelling-forms",
    )
    most = formed.agg(F.max("n")).first()[0] or LEAST
    # Every step multiplies the count by RATIO at least.
    longest = int(log(max(most, 1) / max(LEAST, 1), RATIO) + 1e-9) + 1
    ends = roots(formed.where("form IS NOT NULL"), longest)
    return lookup(formed, ends, ["word"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
