"""From a folder of texts to the tables a search reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from nearkin.functions.stopwords import ENGLISH_STOP_WORDS
from nearkin.operators.documents import compute_signatures, generate_shingles, preprocess_books
from nearkin.params import DEV, LshParams
from nearkin.sources import corpus, index_tables


def build_search_tables(
    spark: SparkSession,
    texts: str,
    folder: str,
    params: LshParams = DEV,
    pattern: str = "*.txt",
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
) -> int:
    """Read the text files of ``texts``, write both search tables under ``folder``; the new version.

    The tokens are written beside them, under ``tokens``, and read back for the signatures.
    """
    raw = corpus.load_raw_books(spark, texts, pattern)
    tokens = corpus.write_tokens(preprocess_books(raw, stop_words), f"{folder.rstrip('/')}/tokens")
    signatures = compute_signatures(generate_shingles(tokens, params.shingle_k), params.num_hashes, params.seed)
    return index_tables.write_search_tables(signatures, folder, params)
