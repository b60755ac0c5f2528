"""Quality rules by a bitmask ledger.

Every rule is evaluated once. The ledger keeps, per document, the measurements and one bit
per failed rule; policies are masks over those bits, so a new policy version or an ablation
reads the ledger and never the texts.

Defined cases: a null text has no words (it fails the word rule, like an empty one); repeated
rows get equal ledger rows; an empty table gives an empty ledger; further columns of the
input are passed through untouched, under their own names, unless they clash with a ledger
column, which then replaces them.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

# The characters counted as symbols, and the white space between words.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


def repeat_words(words: list[bytes]) -> int:
    """Words covered by a 3-word window that occurs at least twice."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    if len(number) == n:
        return 0
    size = len(number)
    pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1]
    windows = pairs[:-1].astype(np.int64) * size + ids[2:]
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : shift + len(twice)] |= twice
    return int(covered.sum())


def measure_text(text: str | None) -> tuple[int, int, int, int, int, int]:
    """The measurements of one text, in the order of MEASURES."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    spaces = sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - spaces,
        symbols,
        len(lines),
        len(lines) - len(set(lines)),
        repeat_words(words),
    )


@F.pandas_udf(T.StructType([T.StructField(name, T.LongType()) for name in MEASURES]))
def measured(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure_text(t) for t in texts], columns=list(MEASURES), dtype="int64")


@dataclass(frozen=True)
class Rule:
    """A named rule; ``bit`` never changes once a ledger was written with it."""

    bit: int
    name: str
    fails: Column


def rules() -> list[Rule]:
    """The rules over the measurement columns, one bit each."""
    words, lines = F.col("n_words"), F.col("n_lines")
    checks = [
        ("few_words", words < 50),
        ("repeated_windows", 100 * F.col("n_repeat_words") > 50 * words),
        ("symbol_heavy", 4 * F.col("n_symbols") > words),
        ("repeated_lines", 10 * F.col("n_dup_lines") > 3 * lines),
        ("short_words", F.col("word_chars") < 2 * words),
        ("long_words", F.col("word_chars") > 20 * words),
    ]
    return [Rule(bit, name, check) for bit, (name, check) in enumerate(checks)]


#: Policy versions: the names of the rules that reject a document. Versions are never edited.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbol_heavy", "repeated_lines"),
    "v2": (
        "few_words",
        "repeated_windows",
        "symbol_heavy",
        "repeated_lines",
        "short_words",
        "long_words",
    ),
}


def mask_of(names: Iterable[str]) -> int:
    bits = {rule.name: rule.bit for rule in rules()}
    return sum(1 << bits[name] for name in set(names))


def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without its text, with the measurements and ``failures``, one bit per rule."""
    taken = {*MEASURES, "failures", text}
    rest = [F.col(f"`{c}`") for c in df.columns if c not in taken]
    found = df.select(*rest, measured(F.col(f"`{text}`")).alias("__m"))
    wide = found.select(*rest, "__m.*")
    failures = F.lit(0).cast("bigint")
    for rule in rules():
        failures = failures.bitwiseOR(F.when(rule.fails, F.lit(1 << rule.bit)).otherwise(F.lit(0)))
    return wide.withColumn("failures", failures)


def rejected(policy: str) -> Column:
    """True where the policy version rejects a ledger row."""
    return F.col("failures").bitwiseAND(F.lit(mask_of(POLICIES[policy]))) != 0


def apply_policy(entries: DataFrame, policy: str) -> DataFrame:
    """The ledger rows with ``kept`` under one policy version."""
    return entries.withColumn("kept", ~rejected(policy))


def ablation(entries: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents it fails, fails alone, and what is kept without it.

    One aggregate by failure bits (at most 2^rules groups); the rest works on those counts.
    """
    mask = mask_of(POLICIES[policy])
    counts = entries.groupBy(F.col("failures").bitwiseAND(F.lit(mask)).alias("bits")).agg(
        F.count("*").alias("n")
    )
    named = {rule.name: rule.bit for rule in rules()}
    parts = F.array(
        *[
            F.struct(F.lit(name).alias("rule"), F.lit(1 << named[name]).cast("bigint").alias("bit"))
            for name in POLICIES[policy]
        ]
    )
    each = counts.select("bits", "n", F.explode(parts).alias("r")).select("bits", "n", "r.*")
    failed = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(failed, F.col("n"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n"))), F.lit(0)).alias("n_alone"),
        F.coalesce(
            F.sum(F.when(F.col("bits").isin(0) | (F.col("bits") == F.col("bit")), F.col("n"))),
            F.lit(0),
        ).alias("n_kept_without"),
    )


def keep(df: DataFrame, policy: str = "v2", text: str = "text") -> DataFrame:
    """The rows of ``df``, all columns unchanged, that the policy keeps."""
    names = df.columns
    boxed = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"), F.col(f"`{text}`"))
    kept = ledger(boxed, text).where(~rejected(policy))
    return kept.select(*[F.col("__row").getField(c).alias(c) for c in names])
