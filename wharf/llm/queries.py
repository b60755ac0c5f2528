"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wharf.llm import (
    chat,
    filter_audit,
    html_extraction,
    mixing,
    pieces,
    quality_model,
    quality_rules,
    sharding,
    simhash,
    spelling,
    substring_dedup,
    suffix_dedup,
    tokenizers,
    topk,
)
from wharf.llm.common import stored, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extraction.extract(pages).select("page_id", "url", "text", "n_chars")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards whose counts differ by at most one (law ``rows``)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return sharding.shard(rows, 40, seed=42).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, as count and digest, and the text decoded from them."""
    model = tokenizers.read(tokenizers.PIECES)
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = pieces.decode(pieces.encode(documents, model), model)
    spaces = F.replace(F.coalesce("text", F.lit("")), F.lit(pieces.SPACE), F.lit(" "))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == spaces).alias("round_trip"),
    )


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that says control strings, formatted and read back."""
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    spoken = F.lit("</s>[INST] ok [/INST]")
    probe = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        spoken.alias("text"),
    )
    ranks = tokenizers.read(tokenizers.RANKS)
    return chat.digests(chat.conversations(said.unionByName(probe), ranks), ranks)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that the mix takes."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    narrow = stored(mixing.sized(documents).drop("text"), "mix-sizes")
    return mixing.mix(narrow).select("doc_id", "size", "source_size", "target", "taken")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learned from the labels that are not held out."""
    third = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    stats = stored(
        quality_model.statistics(documents).withColumn("held_out", third == 1), "statistics"
    )
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    learned = stats.where(~F.col("held_out")).join(labels, "doc_id")
    model = quality_model.fit(stored(learned, "labelled"))
    scored = stats.select("doc_id", "held_out", model.score().cast("double").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that also start earlier as part of a 100-byte string."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.deduplicate(documents).select(
        "doc_id",
        "__cut.n_bytes",
        "__cut.n_removed",
        "__cut.n_spans",
        F.sha2("__cut.kept", 256).alias("kept_sha256"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    prints = stored(
        documents.select("doc_id", simhash.fingerprints("text").alias("fp")), "prints"
    )
    return simhash.near_duplicates(prints).select(
        "doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of every document under policy v2, in the columns of the digest."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    entries = quality_rules.apply_policy(quality_rules.ledger(documents), "v2")
    return entries.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        quality_rules.rejected("base").alias("base_failed"),
        "kept",
    )


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best vectors for every vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.search(vectors, F.col("vec_id") % 100 == 0, 10)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove at every step of all their orders, by language."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    rows = filter_audit.masks(documents, labels)
    lost = {"good_lost": F.col("good"), "toxic_lost": F.col("toxic")}
    return filter_audit.audit(rows, "ABCDE", lost)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that are part of a 13-word window of a smaller id."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.deduplicate(documents).select(
        "row.doc_id", "cut.n_words", "cut.n_removed", F.sha2("cut.kept", 256).alias("kept_sha256")
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the frequent words of all documents."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(spelling.vocabulary(documents))


QUERIES: dict[str, Query] = {
    fn.__name__: fn
    for fn in (
        op1_html_extraction,
        op2_sharding,
        op3_sentencepiece,
        op4_chat_formatting,
        op5_mixing,
        op6_quality_classifier,
        op7_suffix_dedup,
        op8_simhash,
        op9_quality_rules,
        op10_topk,
        op11_filter_audit,
        op12_substring_dedup,
        op13_spelling_variants,
    )
}
