"""The corpus pipeline: rules, near-duplicates, repeated passages, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
reread as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wharf.llm import mixing, pieces, quality_rules, shingles, suffix_dedup, tokenizers
from wharf.llm.common import prepare, scratch, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the policy rejects go."""
    prepare(spark)
    return quality_rules.keep(docs, "v2")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id.

    Five-word shingles, similarity 0.8 or more: ``op8_simhash`` has a digest of its own.
    """
    prepare(spark)
    return shingles.keep_one(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has leave the text, in whole characters."""
    prepare(spark)
    cut = suffix_dedup.deduplicate(docs)
    changed = F.col("__cut.n_spans") > 0
    text = F.when(changed, F.col("__cut.text")).otherwise(F.col("text"))
    out = cut.withColumn("text", text).withColumn(
        "n_chars", F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    )
    return out.drop("__cut")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document appears as often as the mix takes it."""
    prepare(spark)
    names = docs.columns
    boxed = docs.select(
        "doc_id", "source", "text", F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row")
    )
    mixed = mixing.mix(mixing.sized(boxed).drop("text"))
    repeated = mixed.where("copies > 0").select(
        "__row", F.explode(F.sequence(F.lit(1), F.col("copies")))
    )
    return repeated.select(*[F.col("__row").getField(c).alias(c) for c in names])


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their piece ids and the number of them."""
    prepare(spark)
    encoded = pieces.encode(docs, tokenizers.read(tokenizers.PIECES))
    return encoded.withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", rules),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", passages),
    ("mixing", mixture),
    ("sentencepiece", token_ids),
]

#: Shingle sets, sampling digests of all rows and piece ids have no SQL twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        # A stage's own tables go once its result is written.
        with scratch(spark) as keep:
            docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
