"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.operators import documents, lookup
from nearkin.params import CLUSTER
from nearkin.plans import evaluate, similar
from nearkin.session import intermediate_tables, stored
from nearkin.sources import index_tables
from workload.queries import ASKED_ID, QUERIES

HEADLINE = (
    "tokens",
    "shingles",
    "signatures",
    "lsh_index",
    "candidate_pairs",
    "scored_pairs",
    "truth_pairs",
    "similar_to_doc",
    "similar_batch",
    "similar_to_texts",
    "lsh_metrics",
    "sweep_bands",
    "sweep_hashes",
    "corpus_stats",
)
SCALING_FACTORS = (1, 2)
RUNS = 3


def timed(make: Callable[[], DataFrame], runs: int = RUNS) -> float:
    """The median of ``runs`` runs, from making the plan to its last row; tables go after each."""
    taken = []
    for _ in range(runs):
        with intermediate_tables(SparkSession.active()):
            start = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
    return round(statistics.median(taken), 3)


def perturbed(books: DataFrame, factor: int) -> DataFrame:
    """``factor`` replicas of every document, each with one word in nine changed in its own way."""
    replica = F.explode(F.sequence(F.lit(1), F.lit(factor)))
    words = F.transform(
        F.split("content", " "),
        lambda word, i: F.when(
            (F.col("replica") > 1) & (F.pmod(F.xxhash64("replica", "book_id", i), F.lit(9)) == 0),
            F.concat(word, F.lit("q"), F.translate(F.col("replica").cast("string"), "0123456789", "abcdefghij")),
        ).otherwise(word),
    )
    grown = books.withColumn("replica", replica)
    named = F.concat_ws("_", F.col("book_id").cast("string"), "replica")
    return grown.select(named.alias("book_id"), F.array_join(words, " ").alias("content"))


def scaling(spark: SparkSession, folder: str) -> list[dict]:
    """Seconds of signing, of all candidate pairs, and of exact pairs, for replicas that differ."""
    table = spark.read.parquet(f"{folder}/documents.parquet")
    books = table.select(F.col("doc_id").alias("book_id"), F.col("text").alias("content"))
    runs = []
    for factor in SCALING_FACTORS:
        with intermediate_tables(spark):
            grown = stored(perturbed(books, factor), "grown")
            start = time.perf_counter()
            signatures = stored(documents.text_signatures(grown, CLUSTER), "signatures")
            signed = time.perf_counter()
            n_pairs = similar.candidate_pairs(signatures, CLUSTER).count()
            paired = time.perf_counter()
            shingled = documents.shingle_texts(grown, CLUSTER.shingle_k, "index")
            n_exact = similar.exact_pairs_above(shingled, evaluate.TRUTH_JACCARD).count()
            runs.append(
                {
                    "size": grown.count(),
                    "signature_s": round(signed - start, 3),
                    "pairs_s": round(paired - signed, 3),
                    "exact_s": round(time.perf_counter() - paired, 3),
                    "n_candidates": n_pairs,
                    "n_exact": n_exact,
                }
            )
    return runs


def lookup_alone(spark: SparkSession, folder: str) -> float:
    """Seconds of one search on tables that are there, apart from building them."""
    table = spark.read.parquet(f"{folder}/documents.parquet")
    books = table.select(F.col("doc_id").alias("book_id"), F.col("text").alias("content"))
    with intermediate_tables(spark) as tables:
        index_tables.write_search_tables(documents.text_signatures(books, CLUSTER), tables, CLUSTER)
        stored_tables = index_tables.read_search_tables(spark, tables)
        return timed(lambda: lookup.find_similar_books(*stored_tables, ASKED_ID, params=CLUSTER), 5)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("nearkin-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="nearkin-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Compiles what all queries share; the first query would else pay for it.
    timed(lambda: QUERIES["signatures"](spark, folder), 1)
    seconds = {name: timed(lambda name=name: QUERIES[name](spark, folder)) for name in names}
    report = {}
    if not sys.argv[1:]:
        report["lookup_on_stored_tables"] = lookup_alone(spark, folder)
        report["scaling"] = scaling(spark, folder)
        # Both list all pairs of the whole corpus: like against like.
        report["exact_over_lsh"] = round(seconds["truth_pairs"] / seconds["candidate_pairs"], 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, each the median of its runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                **report,
            }
        )
    )


if __name__ == "__main__":
    main()
