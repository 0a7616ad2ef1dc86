"""From raw text to tokens, shingles and signatures: one row per document throughout."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from nearkin.functions import batches as many
from nearkin.functions import text
from nearkin.functions.binding import let, with_computed
from nearkin.functions.hashing import PRIME, hash_family, stable_hash, stable_hashes
from nearkin.functions.minhash import hashes_of, sign, sign_by, sign_sets
from nearkin.functions.shingles import word_shingles
from nearkin.functions.stopwords import ENGLISH_STOP_WORDS
from nearkin.params import DEV, LshParams

ANALYZERS = ("index", "raw")


def preprocess_books(
    raw: DataFrame, stop_words: Sequence[str] = ENGLISH_STOP_WORDS
) -> DataFrame:
    """``(path, content)`` files to ``(book_id, tokens)``, boilerplate stripped."""
    books = raw.select(
        text.file_id(F.col("path")).alias("book_id"),
        text.strip_boilerplate(F.col("content")).alias("content"),
    )
    return tokenize(books, stop_words)


def strip_lines(lines: DataFrame) -> DataFrame:
    """The lines ``path, line_no, line`` between each file's start and end marker.

    ``text.strip_boilerplate`` for files of any size: the markers' places are minima over a
    file's lines, and the lines stay where they are.
    """
    starts = lines.where(
        (F.col("line_no") < text.START_WITHIN_LINES) & text.begins_with_any(F.col("line"), text.START_MARKERS)
    ).groupBy("path").agg((F.min("line_no") + 1).alias("start"))
    # Only lines that begin with a marker are looked at again.
    marked = lines.where(text.begins_with_any(F.col("line"), text.END_MARKERS)).select("path", "line_no")
    begin = F.coalesce("start", F.lit(0))
    ends = (
        marked.join(starts, "path", "left")
        .where(F.col("line_no") >= F.greatest(begin, F.lit(text.END_FROM_LINE)))
        .groupBy("path").agg(F.min("line_no").alias("end"))
    )
    within = starts.join(ends, "path", "full")
    kept = lines.join(within, "path", "left")
    return kept.where(
        (F.col("line_no") >= begin) & (F.col("end").isNull() | (F.col("line_no") < F.col("end")))
    ).select("path", "line_no", "line")


def _lists(rows: DataFrame, value: str, name: str, least: int, lists: Callable[[pa.Array], list[list[bytes]]]) -> DataFrame:
    """``book_id`` and what ``lists`` makes of ``value``, in one Arrow pass; shorter ones are dropped."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in many.few_rows(batches):
            made = lists(batch.column(value))
            kept = [i for i, values in enumerate(made) if len(values) >= least]
            ids = batch.column("book_id").take(pa.array(kept, pa.int32()))
            yield pa.RecordBatch.from_arrays([ids, many.string_lists([made[i] for i in kept])], ["book_id", name])

    schema = StructType([rows.schema["book_id"], StructField(name, ArrayType(StringType()))])
    return rows.select("book_id", value).mapInArrow(run, schema)


def letters_of(books: DataFrame) -> DataFrame:
    """``book_id, letters``: ``text.alphabet_only`` as bytes, as Arrow maps read it."""
    return books.select("book_id", text.alphabet_only(F.col("content")).cast("binary").alias("letters"))


def tokenize(books: DataFrame, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> DataFrame:
    """``(book_id, content)`` to ``(book_id, tokens)``; documents without tokens are dropped."""
    stops = many.as_bytes(stop_words)

    def words(texts: pa.Array) -> list[list[bytes]]:
        return [many.index_words(t, stops) for t in texts.to_pylist()]

    return _lists(letters_of(books), "letters", "tokens", 1, words)


def generate_shingles(tokens: DataFrame, k: int = DEV.shingle_k) -> DataFrame:
    """``(book_id, tokens)`` to ``(book_id, shingles)``; fewer than ``k`` tokens drop the row."""

    def shingles(lists: pa.Array) -> list[list[bytes]]:
        return [many.shingles_of(words, k) for words in many.elements(lists)]

    return _lists(tokens, "tokens", "shingles", 1, shingles)


def _shingled(books: DataFrame, shingles: Column) -> DataFrame:
    computed = with_computed(books, "shingles", shingles)
    return computed.where(F.col("shingles").isNotNull()).select("book_id", "shingles")


def words_of(content: Column, analyzer: str, stop_words: Sequence[str]) -> Column:
    """``index``: as documents are indexed. ``raw``: lower-cased only, nothing removed."""
    if analyzer not in ANALYZERS:
        raise ValueError(f"analyzer must be one of {ANALYZERS}")
    return text.index_tokens(content, stop_words) if analyzer == "index" else text.raw_words(content)


def shingle_texts(
    books: DataFrame,
    k: int = DEV.shingle_k,
    analyzer: str = "raw",
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """``(book_id, content)`` straight to ``(book_id, shingles)``."""
    words = words_of(F.col("content"), analyzer, stop_words)
    if analyzer != "index":
        return _shingled(books, word_shingles(words, k))
    return _lists(letters_of(books), "letters", "shingles", 1, shingles_of_texts(k, stop_words))


def shingles_of_texts(k: int, stop_words: Sequence[str]) -> Callable[[pa.Array], list[list[bytes]]]:
    stops = many.as_bytes(stop_words)
    return lambda texts: [many.shingles_of(many.index_words(t, stops), k) for t in texts.to_pylist()]


def compute_signatures(
    shingled: DataFrame, num_hashes: int = DEV.num_hashes, seed: int = DEV.seed
) -> DataFrame:
    """Replace ``shingles`` by ``signature``; an empty or null set gives an empty signature."""
    return sign_sets(shingled, num_hashes, seed)


def signatures_by_grouping(
    shingled: DataFrame, num_hashes: int = DEV.num_hashes, seed: int = DEV.seed
) -> DataFrame:
    """``compute_signatures`` of ``(book_id, shingles)`` with grouped minima, all on the JVM.

    Shuffles ``num_hashes`` values per document; for clusters without Python workers.
    """
    exploded = shingled.select("book_id", F.explode_outer("shingles").alias("shingle"))
    hashed = exploded.select("book_id", stable_hash(F.col("shingle")).alias("h"))
    minima = hashed.groupBy("book_id").agg(
        *[
            F.min((F.col("h") * a + b) % PRIME).cast("int").alias(f"m{i}")
            for i, (a, b) in enumerate(hash_family(num_hashes, seed))
        ]
    )
    signature = F.array(*[F.col(f"m{i}") for i in range(num_hashes)])
    return minima.select(
        "book_id",
        F.when(F.col("m0").isNotNull(), signature)
        .otherwise(F.array().cast("array<int>"))
        .alias("signature"),
    )


def text_signatures(
    books: DataFrame,
    params: LshParams = DEV,
    analyzer: str = "index",
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """``(book_id, content)`` to ``(book_id, signature)`` in one narrow pass.

    Documents too short for one shingle are dropped, as ``generate_shingles`` drops them.
    """
    words = words_of(F.col("content"), analyzer, stop_words)
    if analyzer == "index":
        shingles = shingles_of_texts(params.shingle_k, stop_words)
        signed = sign_by(
            letters_of(books), "letters", lambda texts: hashes_of(shingles(texts)), params.num_hashes, params.seed
        )
    else:
        hashes = let(words, lambda w: stable_hashes(word_shingles(w, params.shingle_k)))
        signed = sign(books.select("book_id", hashes.alias("hashes")), params.num_hashes, params.seed)
    return signed.where(F.size("signature") > 0)
