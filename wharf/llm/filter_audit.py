"""How filters interact: what each removes in every order, and its fair share of all removals.

*Ledger.* Each document is judged once, by all filters, and becomes one bit mask. Documents are
counted by part and mask; all later work is on these counts (at most 2^n for a part).

*Coalitions.* v(S) is the number of documents that a set S of filters removes together. Filter i
applied after the set S removes v(S + i) - v(S); these differences are the steps of all orders.

*Potential.* The removal game has the potential P({}) = 0, |S| P(S) = v(S) + sum of P(S - i) over
the filters of S. The Shapley value of a filter is P(all) - P(all without it). Potentials are kept
times n!, where they are whole numbers, so that the value summed over all n! orders is exact.

Defined cases: a null text is empty; an empty text has no words; a null id is smaller than none
and none is smaller than it, so such a row never fails as a copy; repeated rows count as often as
they come; several labels of an id count as 1 if one of them is 1, a missing label as 0; null and
empty names of a part are one part; an empty table has no parts; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping, Sequence
from itertools import permutations
from math import factorial

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wharf.llm.common import stored
from wharf.plans.joins import lookup

#: Bytes of a text that are split into words at once.
BLOCK = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
# Upper-case letters, symbols, and the bytes that continue a character.
_UPPER = bytes(range(0x41, 0x5B))
_SYMBOLS = b"#$%&*|"
_CONTINUES = bytes(range(0x80, 0xC0))


def word_counts(data: bytes) -> tuple[int, int]:
    """Words and distinct words; only the distinct ones of the blocks so far are held."""
    n, seen, at = 0, set(), 0
    while at < len(data):
        space = _SPACE.search(data, at + BLOCK)
        end = space.start() if space else len(data)
        words = data[at:end].split()
        n += len(words)
        seen.update(words)
        at = end
    return n, len(seen)


def judge(data: bytes) -> int:
    """Bits of the filters A to D that a text fails, A lowest."""
    words, distinct = word_counts(data)
    points = len(data.translate(None, _CONTINUES))
    upper = len(data) - len(data.translate(None, _UPPER))
    fails = (
        words < 200,
        100 * distinct < 50 * words,
        100 * upper > 3 * points,
        len(data.translate(None, _SYMBOLS)) < len(data),
    )
    return sum(1 << bit for bit, failed in enumerate(fails) if failed)


_JUDGED = T.StructType(
    [T.StructField("mask", T.IntegerType()), T.StructField("digest", T.BinaryType())]
)


@F.pandas_udf(_JUDGED)
def judged(texts: pd.Series) -> pd.DataFrame:
    """Bits of A to D and a 256-bit digest of each text, given as bytes."""
    rows = [(judge(t), hashlib.sha256(t).digest()) for t in (t or b"" for t in texts)]
    return pd.DataFrame(rows, columns=["mask", "digest"])


def masks(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, good, toxic`` of every document (``doc_id, text, lang``).

    Filter E, the copy of a smaller id, is found by digest: texts do not travel, and a group of
    copies is folded to its least id before the shuffle.
    """
    rows = stored(
        documents.select(
            F.col("doc_id").alias("id"),
            F.coalesce("lang", F.lit("")).alias("part"),
            judged(F.col("text").cast("binary")).alias("j"),
        ).select("id", "part", "j.*"),
        "filter-masks",
    )
    several = rows.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    copied = stored(several.where("least < most").select("digest", "least"), "filter-copies")
    known = labels.where("quality = 1 OR toxic = 1").groupBy(F.col("doc_id").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    known = stored(known, "filter-labels")
    found = lookup(lookup(rows, copied, ["digest"], "left"), known, ["id"], "left")
    copy = F.when(F.col("id") > F.col("least"), 1 << 4).otherwise(0)
    return found.select(
        "part",
        F.col("mask").bitwiseOR(copy).alias("mask"),
        F.coalesce("good", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"),
    )


def _meets(mask: Column, coalition: Column) -> Column:
    return mask.bitwiseAND(coalition) != 0


def coalitions(judged_rows: DataFrame, names: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Per ``part`` one array for each measure: its value removed by each of the 2^n coalitions.

    Measure ``n`` counts documents. Arrays are indexed by the coalition's mask; ``total`` is the
    number of documents of the part.
    """
    sums = {"n": F.count("*"), **{name: F.sum(value) for name, value in measures.items()}}
    counted = judged_rows.groupBy("part", "mask").agg(
        *[total.cast("bigint").alias(name) for name, total in sums.items()]
    )
    # At most 2^n entries a part, one for each mask.
    held = counted.groupBy("part").agg(
        F.sum("n").alias("total"), F.collect_list(F.struct("mask", *sums)).alias("held")
    )
    every = F.sequence(F.lit(0), F.lit((1 << len(names)) - 1))

    def removed(name: str) -> Column:
        return F.transform(
            every,
            lambda s: F.aggregate(
                F.filter("held", lambda m: _meets(m["mask"], s)),
                F.lit(0).cast("bigint"),
                lambda total, m: total + m[name],
            ),
        )

    return held.select("part", "total", *[removed(name).alias(name) for name in sums])


def potentials(values: Column, n: int) -> Column:
    """Potentials of all coalitions, times n!, from the array of their values."""

    def next_one(made: Column, s: Column) -> Column:
        whole = F.lit(factorial(n)).cast("bigint") * F.get(values, s)
        for bit in range(n):
            smaller = F.get(made, s.bitwiseXOR(F.lit(1 << bit)))
            whole = whole + F.when(_meets(s, F.lit(1 << bit)), smaller).otherwise(F.lit(0))
        size = F.bit_count(s).cast("bigint")
        return F.concat(made, F.array(F.call_function("div", whole, size)))

    start = F.array(F.lit(0).cast("bigint"))
    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << n) - 1)), start, next_one)


def shapley(potential: Column, n: int, bit: Column) -> Column:
    """The Shapley value times n!: the removals of a filter summed over all orders."""
    everyone = (1 << n) - 1
    one = F.call_function("shiftleft", F.lit(1), bit)
    return F.get(potential, F.lit(everyone)) - F.get(potential, F.lit(everyone).bitwiseXOR(one))


def steps(games: DataFrame, names: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Every step of every order, from the table of :func:`coalitions`.

    ``part, filter_order, step, kept, removed, redundant, unique_fails``, one column for each of
    ``measures`` (what the step removes of it) and ``shapley``.
    """
    n = len(names)
    # Fixed size: n! orders, whatever the data.
    orders = F.array(*[F.lit("".join(order)) for order in permutations(names)])
    letters = F.lit("".join(names))
    wide = games.withColumn("potential", potentials(F.col("n"), n)).withColumn(
        "filter_order", F.explode(orders)
    )

    def bits_before(step: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(n)),
            F.lit(0),
            lambda mask, k: F.when(
                k < step,
                mask.bitwiseOR(
                    F.call_function(
                        "shiftleft",
                        F.lit(1),
                        F.call_function("instr", letters, F.substr("filter_order", k, F.lit(1))) - 1,
                    )
                ),
            ).otherwise(mask),
        )

    placed = wide.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    letter = F.substr("filter_order", F.col("step"), F.lit(1))
    placed = placed.withColumn("bit", F.call_function("instr", letters, letter) - 1).withColumn(
        "before", bits_before(F.col("step"))
    )
    one = F.call_function("shiftleft", F.lit(1), F.col("bit"))
    everyone = F.lit((1 << n) - 1)

    def difference(name: str) -> Column:
        after = F.get(F.col(name), F.col("before").bitwiseOR(one))
        return after - F.get(F.col(name), F.col("before"))

    alone = F.get(F.col("n"), everyone) - F.get(F.col("n"), everyone.bitwiseXOR(one))
    return placed.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.get(F.col("n"), F.col("before").bitwiseOR(one))).alias("kept"),
        difference("n").alias("removed"),
        (F.get(F.col("n"), one) - difference("n")).alias("redundant"),
        alone.alias("unique_fails"),
        *[difference(name).alias(name) for name in measures],
        shapley(F.col("potential"), n, F.col("bit")).alias("shapley"),
    )


def audit(judged_rows: DataFrame, names: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """All steps of all orders of the filters ``names`` (one letter each, lowest bit first).

    ``judged_rows`` has ``part`` and ``mask``; ``measures`` are whole-number columns of it whose
    removal is added up beside the documents.
    """
    if len(set(names)) != len(names) or any(len(name) != 1 for name in names):
        raise ValueError(f"filters are told apart by one letter each, got {list(names)}")
    return steps(coalitions(judged_rows, names, measures), names, list(measures))
