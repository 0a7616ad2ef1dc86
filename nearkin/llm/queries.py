"""The registered queries of the subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.llm import (
    bpe,
    chat,
    exact,
    fingerprints,
    jaccard,
    licences,
    lines,
    packing,
    quality,
    repair,
    search,
    secrets,
    toxicity,
)
from nearkin.llm.oracle import SQL
from nearkin.session import stored

__all__ = ["QUERIES", "SQL"]

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and how near they are to each other."""
    return fingerprints.with_next(documents(spark, folder)).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", "near_edited", "near_next",
    )


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens, sources in the corpus's proportions."""
    pieces = packing.pack_documents(documents(spark, folder), tokenizer_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "source", "padded_to",
    )


def op3_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Maximal conversations, rendered."""
    return chat.rendered(spark.read.parquet(f"{folder}/conversations.parquet"))


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every document's ids and of the text they decode to."""
    return bpe.encode_decode_digests(documents(spark, folder), tokenizer_path())


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """What the quality rules see of every document, and their verdict."""
    return quality.judged(documents(spark, folder)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Probabilities of every document's toxicity categories, by a chain fitted on ``labels``."""
    docs = documents(spark, folder)
    chain = toxicity.train_on_labels(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    found = toxicity.predict(docs, chain)
    return found.select("doc_id", *[F.round(c, 6).alias(c) for c in found.columns if c.startswith("p_")], "is_toxic")


def op7_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and notices of every document."""
    return licences.summary(licences.scan(documents(spark, folder)))


def op8_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's component under shingle similarity of 0.8 or more."""
    return jaccard.similar_groups(documents(spark, folder))[0]


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document: exact patterns, and what the trained field adds."""
    docs = documents(spark, folder)
    return secrets.digests(secrets.find(docs, secrets.train(docs)))


def op10_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines whose template an earlier document has."""
    return lines.drop_recurring(documents(spark, folder)).select("doc_id", "text", "n_lines", "n_dropped")


def op11_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    index = stored(search.build(documents(spark, folder)), "search-index")
    return search.search(index, spark.read.parquet(f"{folder}/benchmark.parquet"))


def op12_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Which document stays of those with equal texts, for every document."""
    return exact.deduplicated(documents(spark, folder))


def op13_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of every damaged conversation, and the cheapest edits that repair it."""
    conversations = spark.read.parquet(f"{folder}/conversations.parquet")
    return repair.summary(repair.damaged(conversations), conversations)


QUERIES: dict[str, Query] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_packing": op2_packing,
    "op3_chat": op3_chat,
    "op4_bpe": op4_bpe,
    "op5_quality": op5_quality,
    "op6_toxicity": op6_toxicity,
    "op7_licences": op7_licences,
    "op8_jaccard": op8_jaccard,
    "op9_secrets": op9_secrets,
    "op10_lines": op10_lines,
    "op11_search": op11_search,
    "op12_exact": op12_exact,
    "op13_repair": op13_repair,
}
