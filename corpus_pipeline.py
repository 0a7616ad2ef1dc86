"""From raw documents to packed training sequences, in five stages over whole tables.

Every stage takes all rows that the one before kept, written as Parquet and read again. All but
the last return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.llm import jaccard, lines, packing, quality, secrets
from nearkin.llm.queries import tokenizer_path
from nearkin.session import intermediate_tables, scratch_path, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects; a null text is rejected as too short."""
    return quality.kept(docs).select(*COLUMNS)


def _unless_emptied(left: DataFrame) -> DataFrame:
    emptied = (F.col("n_dropped") > 0) & ~F.col("text").rlike(r"[^ \t\n\x0B\f\r]")
    return left.filter(F.col("text").isNull() | ~emptied)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines, then without recurring sentences of what is left.

    Those of which no text is left are dropped. The tables of the first step go before the second.
    """
    path = scratch_path(spark, "lines-left")
    with intermediate_tables(spark):
        _unless_emptied(lines.drop_recurring(docs, families=True)).select(*COLUMNS).write.parquet(path)
    left = spark.read.schema(docs.select(*COLUMNS).schema).parquet(path)
    return _with_length(_unless_emptied(lines.drop_recurring(left, unit=lines.SENTENCE, families=True)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: that of the smallest id.

    Rows without an id are in no group and stay; rows that repeat an id stay or go together.
    """
    groups, _ = jaccard.similar_groups(docs)
    copies = groups.filter("component_id != doc_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret replaced by a mark."""
    return _with_length(secrets.redact(docs, secrets.train(docs)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens, with their ids."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("pack_sequences", pack_sequences),
]

#: A trained model decides in one stage and a tokenizer in another; see tests/llm.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
