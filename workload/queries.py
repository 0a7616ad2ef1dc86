"""The queries of the driver contract: each reads the given tables and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.functions import text
from nearkin.functions.hashing import stable_hash
from nearkin.operators import copies, documents, lookup, lsh
from nearkin.params import CLUSTER, DEV
from nearkin.plans import evaluate, explore, similar
from nearkin.session import scratch_path, stored
from nearkin.sources import catalog, corpus, index_tables, metadata, results

Query = Callable[[SparkSession, str], DataFrame]

# The document that the single-document searches start from.
ASKED_ID = 1
# Wide banding for short query texts: a pair of similarity 0.14 is found about every other time.
WIDE = CLUSTER.but(bands=50, rows=2, top_k=5)
EXACT_MIN_JACCARD = 0.2
SHELVES = ["src1", "SRC2", "9"]
SCALING_FACTORS = (1, 2, 3)


def _books(spark: SparkSession, folder: str) -> DataFrame:
    table = spark.read.parquet(f"{folder}/documents.parquet")
    return table.select(F.col("doc_id").alias("book_id"), F.col("text").alias("content"))


def _named_books(spark: SparkSession, folder: str) -> DataFrame:
    """Documents under ids as files have them: ``pg17``."""
    return _books(spark, folder).withColumn("book_id", F.concat(F.lit("pg"), F.col("book_id")))


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as ``(path, content)`` files; every fifth has a name without a number."""
    name = F.when(F.col("book_id") % 5 == 0, F.lit("notes")).otherwise(F.concat(F.lit("pg"), F.col("book_id")))
    path = F.concat(F.lit("file:///corpus/"), F.col("book_id"), F.lit("/"), name, F.lit(".txt"))
    return _wrapped(spark, folder).select(path.alias("path"), "content")


def _benchmark(spark: SparkSession, folder: str) -> DataFrame:
    table = spark.read.parquet(f"{folder}/benchmark.parquet")
    return table.select(F.col("item_id").alias("book_id"), F.col("text").alias("content"))


def _signatures(spark, folder, params=DEV) -> DataFrame:
    return stored(documents.text_signatures(_books(spark, folder), params), "signatures")


def _shingles(spark, folder) -> DataFrame:
    return documents.shingle_texts(_books(spark, folder), DEV.shingle_k, "index")


def _sets(spark, folder, num_hashes=None) -> DataFrame:
    return copies.text_sets(_books(spark, folder), DEV.shingle_k, num_hashes)


def _exploded(df: DataFrame, values: str, value: str) -> DataFrame:
    # No list here is empty, and the outer form does not test for it by computing it twice.
    return df.select("book_id", F.explode_outer(values).alias(value))


def _similarity_as_double(df: DataFrame) -> DataFrame:
    rounded = F.round(F.col("similarity").cast("double"), 6)
    return df.withColumn("similarity", rounded)


# Text and tokens


def _wrapped(spark, folder) -> DataFrame:
    """Documents in the shape of book files: two of three have both markers, beyond line 100."""
    preface = F.concat(
        F.repeat(F.lit("preface\n"), (F.col("book_id") % 5).cast("int")),
        F.lit("  *** Start of this text ***\n"),
        F.repeat(F.lit("front matter\n"), (F.col("book_id") % 7 + 98).cast("int")),
    )
    ending = F.lit("\r\nEnd of the Project text\nlicence — “terms”\n")
    content = F.when(F.col("book_id") % 3 == 0, F.col("content")).otherwise(
        F.concat(preface, F.col("content"), ending)
    )
    return _books(spark, folder).select("book_id", content.alias("content"))


def strip_boilerplate(spark, folder):
    body = text.strip_boilerplate(F.col("content"))
    return _wrapped(spark, folder).select("book_id", body.alias("body"))


def clean_text(spark, folder):
    cleaned = text.clean_text(F.col("content"))
    return _wrapped(spark, folder).select("book_id", cleaned.alias("cleaned"))


def tokens(spark, folder):
    tokenized = documents.tokenize(_books(spark, folder))
    return tokenized.select("book_id", F.posexplode_outer("tokens").alias("position", "token"))


def token_table(spark, folder):
    path = scratch_path(spark, "tokens")
    back = corpus.write_tokens(documents.tokenize(_books(spark, folder)), path)
    return back.select("book_id", F.size("tokens").alias("num_tokens"))


def token_stats(spark, folder):
    effect = explore.stop_word_effect(_books(spark, folder))
    return effect.withColumn("removed_pct", F.round("removed_pct", 6))


def top_token_docs(spark, folder):
    tokenized = documents.tokenize(_books(spark, folder))
    return explore.top_by(tokenized.select("book_id", F.size("tokens").alias("num_tokens")), "num_tokens")


def file_ids(spark, folder):
    path = F.col("path")
    return _files(spark, folder).select(
        "path", text.file_id(path).alias("book_id"), text.file_name(path).alias("filename"),
        text.file_number(path).alias("number"),
    )


def preprocessed_files(spark, folder):
    files = documents.preprocess_books(_files(spark, folder))
    return files.select("book_id", F.array_join("tokens", " ").alias("tokens"))


# Shingles, hashes and signatures


def shingles(spark, folder):
    tokenized = documents.tokenize(_books(spark, folder))
    return _exploded(documents.generate_shingles(tokenized, DEV.shingle_k), "shingles", "shingle")


def raw_shingles(spark, folder):
    raw = documents.shingle_texts(_books(spark, folder), DEV.shingle_k, "raw")
    return _exploded(raw, "shingles", "shingle")


def shingle_hashes(spark, folder):
    each = _exploded(_shingles(spark, folder), "shingles", "shingle")
    return each.select("book_id", "shingle", stable_hash(F.col("shingle")).alias("hash"))


def _by_position(signatures: DataFrame) -> DataFrame:
    return signatures.select("book_id", F.posexplode_outer("signature").alias("position", "value"))


def signatures(spark, folder):
    return _by_position(documents.text_signatures(_books(spark, folder), DEV))


def signatures_by_grouping(spark, folder):
    shingled = _shingles(spark, folder)
    return _by_position(documents.signatures_by_grouping(shingled, DEV.num_hashes))


def query_text_signatures(spark, folder):
    return _by_position(documents.text_signatures(_benchmark(spark, folder), CLUSTER, "raw"))


# Index and pairs


def lsh_index(spark, folder):
    return lsh.index_of(documents.text_signatures(_books(spark, folder), DEV), DEV)


def search_tables(spark, folder):
    path = scratch_path(spark, "search")
    signed = documents.text_signatures(_books(spark, folder), CLUSTER)
    index_tables.write_search_tables(signed, path, CLUSTER)
    return index_tables.read_search_tables(spark, path)[1]


def search_signatures(spark, folder):
    """The signatures of the written tables, as ``search_tables`` returns their index."""
    path = scratch_path(spark, "search")
    signed = documents.text_signatures(_books(spark, folder), CLUSTER)
    index_tables.write_search_tables(signed, path, CLUSTER)
    return _by_position(index_tables.read_search_tables(spark, path)[0].select("book_id", "signature"))


def shared_buckets(spark, folder):
    return lsh.shared_buckets(lsh.index_of(_signatures(spark, folder), DEV))


def candidate_pairs(spark, folder):
    return similar.candidate_pairs(_signatures(spark, folder), DEV)


def index_pairs(spark, folder):
    return lsh.pairs_of_signatures(_signatures(spark, folder, CLUSTER), CLUSTER)


def scored_pairs(spark, folder):
    scored = similar.scored_pairs(_signatures(spark, folder), DEV)
    return scored.orderBy(F.desc("similarity"), "book_id_1", "book_id_2")


def group_pairs(spark, folder):
    """Candidate pairs of groups of equal signatures: the answer without the pairs of copies."""
    pairs, _ = similar.candidate_groups(_signatures(spark, folder), DEV)
    return pairs.select(
        F.col("book_id_1").alias("group_1"), F.col("book_id_2").alias("group_2"), F.round("similarity", 6).alias("similarity")
    )


def group_members(spark, folder):
    """Who is in the groups of ``group_pairs``."""
    _, members = similar.candidate_groups(_signatures(spark, folder), DEV)
    return members.select(F.col("leader").alias("group"), "book_id")


def estimate_error(spark, folder):
    errors = similar.candidate_errors(_sets(spark, folder, CLUSTER.num_hashes), CLUSTER)
    return errors.withColumn("error", F.round("error", 9))


def exact_jaccard_pairs(spark, folder):
    """Pairs of exact similarity ``min_jaccard`` or more, which the result states."""
    pairs = similar.exact_pairs_above(_sets(spark, folder), EXACT_MIN_JACCARD)
    return pairs.withColumn("min_jaccard", F.lit(EXACT_MIN_JACCARD))


def named_pairs(spark, folder):
    """Scored pairs under text ids, with files of one name among them."""
    named = F.when(F.col("book_id") % 50 == 0, F.lit("")).otherwise(F.concat(F.lit("pg"), F.col("book_id")))
    signed = stored(
        documents.text_signatures(_books(spark, folder).withColumn("book_id", named), DEV), "signatures"
    )
    return _similarity_as_double(similar.scored_pairs(signed, DEV))


def truth_pairs(spark, folder):
    return similar.exact_pairs_above(_sets(spark, folder), evaluate.TRUTH_JACCARD)


def match_probability(spark, folder):
    pairs = similar.with_match_probability(exact_jaccard_pairs(spark, folder), DEV.bands, DEV.rows)
    return pairs.withColumn("probability", F.round("probability", 9))


# Search


def _search_tables(books, params=DEV):
    """Both tables as searches read them: stored, in order of their keys."""
    path = scratch_path(books.sparkSession, "search")
    index_tables.write_search_tables(documents.text_signatures(books, params), path, params)
    return index_tables.read_search_tables(books.sparkSession, path)


def similar_to_doc(spark, folder):
    tables = _search_tables(_books(spark, folder), WIDE)
    return _similarity_as_double(lookup.find_similar_books(*tables, ASKED_ID, DEV.top_k, WIDE))


def similar_enriched(spark, folder):
    tables = _search_tables(_named_books(spark, folder), WIDE)
    found = lookup.find_similar_books(*tables, f"pg{ASKED_ID}", DEV.top_k, WIDE)
    table = spark.read.parquet(f"{folder}/documents.parquet").select(
        F.col("doc_id").alias("GutenbergID"), F.col("lang").alias("Title"), F.col("source").alias("Author")
    )
    return _similarity_as_double(metadata.enrich(found, metadata.metadata_by_id(table)))


def similar_to_text(spark, folder):
    asked = _books(spark, folder).where(F.col("book_id") == ASKED_ID).first()["content"]
    found = lookup.find_similar_by_text(
        *_search_tables(_books(spark, folder), WIDE), asked, WIDE, analyzer="index"
    )
    return _similarity_as_double(found)


def similar_batch(spark, folder):
    found = lookup.find_similar_to_all(_signatures(spark, folder, CLUSTER), CLUSTER.but(top_k=5))
    return _similarity_as_double(found)


def similar_to_texts(spark, folder):
    asked = stored(documents.text_signatures(_benchmark(spark, folder), WIDE, "index"), "asked")
    found = lookup.find_similar_to_texts(asked, _signatures(spark, folder, WIDE), WIDE)
    return _similarity_as_double(found)


def brute_force_rank(spark, folder):
    ranked = lookup.rank_all(_signatures(spark, folder), ASKED_ID)
    return _similarity_as_double(ranked)


def comparisons_saved(spark, folder):
    tables = _search_tables(_books(spark, folder), WIDE)
    saved = lookup.comparisons_saved(*tables, ASKED_ID, WIDE)
    return saved.withColumn("saved_pct", F.round("saved_pct", 6))


def ranked_compare(spark, folder):
    # Sets as hashes and their signatures come out of one pass.
    sets = stored(_sets(spark, folder, WIDE.num_hashes).drop("copy_key"), "sets")
    signed = sets.select("book_id", "signature")
    index = stored(lsh.index_of(signed, WIDE), "index")
    return lookup.compare_ranking(signed, index, sets.select("book_id", "shingles"), ASKED_ID, WIDE)


# Evaluation


def _prepared(spark, folder, num_hashes):
    return evaluate.prepare(_sets(spark, folder, num_hashes), num_hashes)


def candidate_stats(spark, folder):
    stats = evaluate.candidate_stats(_prepared(spark, folder, CLUSTER.num_hashes), 20, 5)
    return stats.select(
        "n_docs",
        "max_candidates",
        "n_without",
        *[F.round(c, 9).alias(c) for c in ("avg_candidates", "share_without", "reduction")],
    )


def lsh_metrics(spark, folder):
    metrics = evaluate.lsh_metrics(_prepared(spark, folder, DEV.num_hashes), DEV.bands, DEV.rows)
    ratios = ("recall", "precision", "f1", "fpr")
    counts = [c for c in metrics.columns if c not in ratios]
    return metrics.select(*counts, *[F.round(r, 9).alias(r) for r in ratios])


def sweep_bands(spark, folder):
    return evaluate.sweep_bands(_prepared(spark, folder, evaluate.BAND_GRID_HASHES))


def sweep_hashes(spark, folder):
    return evaluate.sweep_hashes(_prepared(spark, folder, max(evaluate.HASH_GRID)))


def best_config(spark, folder):
    """The best configuration of both sweeps."""
    prepared = _prepared(spark, folder, max(evaluate.HASH_GRID))
    return evaluate.best_config(
        results.tagged_union({"TN1": evaluate.sweep_bands(prepared), "TN2": evaluate.sweep_hashes(prepared)})
    )


def lsh_vs_exact(spark, folder):
    return evaluate.lsh_vs_exact(_prepared(spark, folder, 100), 20, 5)


def experiment_results(spark, folder):
    prepared = _prepared(spark, folder, max(evaluate.HASH_GRID))
    table = results.tagged_union(
        {
            "TN1": evaluate.sweep_bands(prepared),
            "TN2": evaluate.sweep_hashes(prepared),
            "TN3": scalability(spark, folder),
            "TN4": evaluate.lsh_vs_exact(prepared, 20, 5),
        }
    )
    # Counts that are missing for some experiments are compared as doubles.
    whole = [F.col(c).cast("double").alias(c) if c in "nbr" else F.col(c) for c in table.columns]
    table = table.select(*whole)
    path = scratch_path(spark, "results")
    results.write_results(table, path)
    return results.read_results(spark, path, table.schema)


def scaling_counts(spark, folder):
    shingled = stored(_shingles(spark, folder), "shingles")
    return evaluate.scaling_counts(shingled, SCALING_FACTORS, 100, 20, 5)


def scalability(spark, folder):
    return evaluate.scalability(_shingles(spark, folder), SCALING_FACTORS, 100, 20, 5)


def replicate(spark, folder):
    books = _books(spark, folder)
    grown = evaluate.replicate(books, books.count() * 5 // 2)
    return grown.select("book_id", F.length("content").alias("num_chars"))


def sample_ids(spark, folder):
    return evaluate.sample_ids(_books(spark, folder), 10)


# Corpus statistics


def doc_stats(spark, folder):
    return explore.text_stats(_books(spark, folder))


def corpus_stats(spark, folder):
    effect = explore.cleaning_effect(_wrapped(spark, folder))
    return explore.corpus_summary(effect, ("raw_words", "cleaned_words", "raw_chars", "cleaned_chars"))


def word_histogram(spark, folder):
    bins = explore.word_histogram(doc_stats(spark, folder))
    return bins.select(
        "bin", F.round("bin_start", 6).alias("bin_start"), F.round("bin_end", 6).alias("bin_end"), "n_docs"
    )


def cleaning_effect(spark, folder):
    effect = explore.cleaning_effect(_wrapped(spark, folder))
    return effect.withColumn("reduction_pct", F.round("reduction_pct", 6))


def longest_cleaned(spark, folder):
    cleaned = explore.cleaning_effect(_wrapped(spark, folder)).select("book_id", "cleaned_words")
    # Every row meets a text, so the first ten need no others; texts stay where they are.
    longest = explore.top_by(cleaned.where(F.col("book_id").isNotNull()), "cleaned_words")
    joined = _books(spark, folder).join(F.broadcast(longest), "book_id")
    return explore.top_by(joined, "cleaned_words").select("book_id", "cleaned_words", "content")


def stage_counts(spark, folder):
    tokenized = stored(documents.tokenize(_books(spark, folder)), "tokens")
    shingled = stored(documents.generate_shingles(tokenized, DEV.shingle_k), "shingles")
    signed = stored(documents.compute_signatures(shingled, DEV.num_hashes), "signatures")
    return explore.stage_counts(
        {
            "documents": _books(spark, folder),
            "tokens": tokenized,
            "shingles": shingled,
            "signatures": signed,
            "lsh_index": lsh.index_of(signed, DEV),
        }
    )


# Catalogue and metadata


def _catalog(spark, folder) -> DataFrame:
    table = spark.read.parquet(f"{folder}/documents.parquet")
    return table.select(
        F.col("doc_id").cast("string").alias("Text#"),
        F.when(F.col("n_chars") % 4 == 0, "Sound").otherwise("Text").alias("Type"),
        F.lit(None).cast("string").alias("Issued"),
        F.concat(F.lit('A "title", no. '), F.col("doc_id")).alias("Title"),
        F.upper("lang").alias("Language"),
        F.lit(None).cast("string").alias("Authors"),
        F.lit(None).cast("string").alias("Subjects"),
        F.lit(None).cast("string").alias("LoCC"),
        F.concat(F.col("source"), F.lit("; all")).alias("Bookshelves"),
    )


def catalog_csv(spark, folder):
    path = scratch_path(spark, "catalog")
    _catalog(spark, folder).write.csv(path, header=True, escape='"', compression="gzip")
    back = catalog.load_catalog(spark, path)
    return back.select(F.col("Text#").alias("number"), *[c for c in back.columns if c != "Text#"])


def catalog_select(spark, folder):
    chosen = catalog.select_bookshelf(_catalog(spark, folder), "SRC1")
    return chosen.select(F.col("Text#").alias("number"), "Title", "Language", "Bookshelves")


def catalog_shelves(spark, folder):
    chosen = catalog.select_bookshelves(_catalog(spark, folder), SHELVES, 7, "e")
    return chosen.select("shelf", F.col("Text#").alias("number"), "Language", "Bookshelves")


def catalog_shelf_table(spark, folder):
    """Shelf names out of a table: a name or a part of one from every document."""
    table = spark.read.parquet(f"{folder}/documents.parquet")
    name = (
        F.when(F.col("doc_id") % 4 == 0, F.upper("source"))
        .when(F.col("doc_id") % 4 == 1, F.concat(F.substring("source", -1, 1), F.lit("; A")))
        .when(F.col("doc_id") % 4 == 2, F.col("doc_id").cast("string"))
        .otherwise(F.concat(F.col("source"), F.lit("; all "), F.col("doc_id")))
    )
    chosen = catalog.select_by_shelf_table(_catalog(spark, folder), table.select(name.alias("shelf")), 7, "e")
    return chosen.select("shelf", F.col("Text#").alias("number"), "Language", "Bookshelves")


def metadata_csv(spark, folder):
    path = scratch_path(spark, "metadata")
    table = spark.read.parquet(f"{folder}/documents.parquet").select(
        F.col("doc_id").alias("GutenbergID"),
        F.concat(F.lit('A "title", no. '), F.col("doc_id")).alias("Title"),
        F.col("lang").alias("Author"),
        F.col("source").alias("Bookshelf"),
        F.lit("none").alias("Link"),
    )
    table.write.csv(path, header=True, escape='"')
    return metadata.load_metadata(spark, path)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        strip_boilerplate, clean_text, tokens, token_table, token_stats, top_token_docs,
        shingles, raw_shingles, shingle_hashes, signatures, signatures_by_grouping,
        query_text_signatures, lsh_index, search_tables, shared_buckets, candidate_pairs,
        index_pairs, scored_pairs, named_pairs, file_ids, preprocessed_files, estimate_error, exact_jaccard_pairs, truth_pairs,
        match_probability, similar_to_doc, similar_enriched, similar_to_text, similar_batch,
        similar_to_texts, brute_force_rank, ranked_compare, candidate_stats, lsh_metrics,
        sweep_bands, sweep_hashes, best_config, lsh_vs_exact, experiment_results,
        scaling_counts, replicate, sample_ids, doc_stats, corpus_stats, word_histogram,
        cleaning_effect, longest_cleaned, stage_counts, catalog_csv, catalog_select,
        catalog_shelves, metadata_csv, search_signatures, group_pairs, group_members,
        comparisons_saved, scalability, catalog_shelf_table,
    )
}
