"""Top-K search: one document, one text, or a whole table of queries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nearkin.functions.hashing import PRIME
from nearkin.functions.minhash import estimate_jaccard
from nearkin.functions.shingles import exact_jaccard
from nearkin.functions.stopwords import ENGLISH_STOP_WORDS
from nearkin.operators.copies import copy_groups, copy_members, first_members, with_copy_key
from nearkin.operators.documents import text_signatures
from nearkin.operators.lsh import BUCKET, first_meetings, index_of
from nearkin.operators.pairing import BLOCK_ROWS, matches_on_key
from nearkin.operators.similarity import estimate_pairs
from nearkin.params import DEV, LshParams
from nearkin.session import stored

# Candidates that are asked for by value in a table laid out by id; of more, all of it is read.
ASKED_BY_VALUE = 512
# Values of one condition: as many as the scan compares one by one with a row group's bounds.
VALUES_AT_ONCE = 10


def _ranked(scored: DataFrame, top_k: int) -> DataFrame:
    """Most similar first; equal similarities by id, which the limit needs to be repeatable."""
    return (
        scored.select("book_id", F.col("similarity").cast("float").alias("similarity"))
        .orderBy(F.desc("similarity"), "book_id")
        .limit(top_k)
    )


def signature_of(signatures: DataFrame, book_id) -> DataFrame:
    """``signature`` of one document in one row, null if the id is unknown."""
    return _of_book(signatures, book_id).agg(F.min("signature").alias("signature"))


def _buckets(signatures: DataFrame) -> int | None:
    """Into how many folders a table read by ``read_search_tables`` is dealt by id."""
    if "id_bucket" not in signatures.columns:
        return None
    return signatures.schema["id_bucket"].metadata.get("buckets")


def _bucket_of(book_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(book_id), F.lit(buckets)).cast("int")


def _of_book(signatures: DataFrame, book_id) -> DataFrame:
    """The rows of one id, out of its folder if the table is laid out by id."""
    named = F.lit(book_id).cast(signatures.schema["book_id"].dataType)
    found = signatures.where(F.col("book_id") == named)
    buckets = _buckets(signatures)
    return found if buckets is None else found.where(F.col("id_bucket") == _bucket_of(named, buckets))


def _any(conditions: list[Column]) -> Column:
    """Whether one of many conditions holds, as a tree of little depth."""
    while len(conditions) > 1:
        conditions = [reduce(or_, conditions[i : i + 2]) for i in range(0, len(conditions), 2)]
    return conditions[0]


def signatures_of(signatures: DataFrame, ids: DataFrame) -> DataFrame:
    """The signatures of the documents ``ids (book_id)``.

    Up to ASKED_BY_VALUE ids are asked for by value: their folders, and in these the row groups
    whose bounds hold one of them. More ids, or a table of another layout, meet in a join, and
    their stored size decides how.
    """
    known = stored(ids.where(F.col("book_id").isNotNull()), "candidates")
    buckets = _buckets(signatures)
    if buckets is not None:
        asked = known.select("book_id", _bucket_of(F.col("book_id"), buckets).alias("bucket"))
        few = asked.distinct().limit(ASKED_BY_VALUE + 1).collect()
        if not few:
            return signatures.where(F.lit(False))
        if len(few) <= ASKED_BY_VALUE:
            by_bucket: dict[int, list] = {}
            for row in few:
                by_bucket.setdefault(row.bucket, []).append(row.book_id)
            values = sorted(row.book_id for row in few)
            parts = [values[i : i + VALUES_AT_ONCE] for i in range(0, len(values), VALUES_AT_ONCE)]
            return signatures.where(
                F.col("id_bucket").isin(*by_bucket) & _any([F.col("book_id").isin(*part) for part in parts])
            )
    return signatures.join(known, "book_id", "left_semi")


def candidates_of(index: DataFrame, buckets: DataFrame) -> DataFrame:
    """Distinct ids with a bucket in common with ``buckets (band_id, bucket_hash)``."""
    wanted = buckets.select(*BUCKET).distinct()
    return index.join(wanted, list(BUCKET), "left_semi").select("book_id").distinct()


def in_buckets(index: DataFrame, signed: DataFrame, params: LshParams) -> DataFrame:
    """Distinct ids that share a bucket with a signature of ``signed``, a frame of one document.

    The buckets are computed from the signature, ``params.bands`` of them, and asked for by
    value: equalities that reach the row groups of an index stored in order of its buckets.
    """
    asked = index_of(signed, params).select(*BUCKET).distinct().collect()
    if not asked:
        return index.where(F.lit(False)).select("book_id")
    by_value = _any([F.col("bucket_hash") == v for v in sorted({r.bucket_hash for r in asked})])
    # One number for band and bucket is looked up in a set; nearly all rows end there, and a comparison
    # for each band would make code that the JVM does not compile.
    number = F.col("band_id").cast("bigint") * (PRIME + 1) + F.col("bucket_hash")
    exact = number.isin([r.band_id * (PRIME + 1) + r.bucket_hash for r in asked])
    return index.where(exact & by_value).select("book_id").distinct()


def _estimates(signatures: DataFrame, query: DataFrame) -> DataFrame:
    """``book_id, similarity`` of every signature to the one in ``query``, a one-row frame."""
    both = signatures.withColumn("_query", query.scalar()).where(F.col("_query").isNotNull())
    similarity = estimate_jaccard(F.col("signature"), F.col("_query"))
    return both.select("book_id", similarity.alias("similarity"))


def _score(candidates: DataFrame, signatures: DataFrame, query: DataFrame) -> DataFrame:
    """Similarity of the candidates to the one signature in ``query``.

    Of a table laid out by id only the candidates' part is read.
    """
    return _estimates(signatures_of(signatures, candidates), query)


def _candidates_of_book(
    signatures: DataFrame, index: DataFrame, book_id, params: LshParams | None
) -> DataFrame:
    named = F.col("book_id") == F.lit(book_id)
    if params is None:
        return candidates_of(index, index.where(named))
    return in_buckets(index, _of_book(signatures, book_id).select("signature"), params)


def find_similar_books(
    signatures: DataFrame,
    index: DataFrame,
    book_id,
    top_k: int = DEV.top_k,
    params: LshParams | None = None,
) -> DataFrame:
    """The ``top_k`` most similar documents to one of the corpus: ``book_id, similarity``.

    With the ``params`` that the index was built with, its buckets come from the one signature
    and the index is read where they are; without, the index is searched for the id first. An
    unknown id gives no rows.
    """
    candidates = _candidates_of_book(signatures, index, book_id, params)
    candidates = candidates.where(F.col("book_id") != F.lit(book_id))
    return _ranked(_score(candidates, signatures, signature_of(signatures, book_id)), top_k)


def find_similar_by_text(
    signatures: DataFrame,
    index: DataFrame,
    text: str,
    params: LshParams = DEV,
    analyzer: str = "raw",
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """The ``params.top_k`` most similar documents to a text that need not be in the corpus.

    ``analyzer="raw"`` only lower-cases the text, so shingles with stop words or punctuation
    meet nothing in an index of cleaned tokens; ``"index"`` treats it like the corpus. A text
    with fewer than ``shingle_k`` words gives no rows.
    """
    query = signatures.sparkSession.createDataFrame([("", text)], "book_id string, content string")
    # Of one row, and read twice: its buckets and its signature.
    signed = stored(text_signatures(query, params, analyzer, stop_words), "query")
    candidates = in_buckets(index, signed.select("signature"), params)
    return _ranked(
        _score(candidates, signatures, signed.agg(F.min("signature").alias("signature"))),
        params.top_k,
    )


def rank_all(signatures: DataFrame, book_id, top_k: int | None = None) -> DataFrame:
    """Estimate against every other document, without the index, most similar first."""
    others = signatures.where(F.col("book_id") != F.lit(book_id))
    scored = _estimates(others, signature_of(signatures, book_id))
    if top_k is not None:
        return _ranked(scored, top_k)
    return scored.select("book_id", F.col("similarity").cast("float").alias("similarity")).orderBy(
        F.desc("similarity"), "book_id"
    )


def comparisons_saved(
    signatures: DataFrame, index: DataFrame, book_id, params: LshParams | None = None
) -> DataFrame:
    """What the index saves one document: ``n_others, n_candidates, n_saved, saved_pct`` in one row.

    ``n_others`` are the documents that a search without the index compares with it, of which
    those that share no bucket are saved. An unknown id has no candidates and saves nothing.
    """
    candidates = _candidates_of_book(signatures, index, book_id, params)
    found = candidates.where(F.col("book_id") != F.lit(book_id)).agg(F.count(F.lit(1)).alias("n")).scalar()
    known = F.coalesce(_of_book(signatures, book_id).agg(F.count(F.lit(1)).alias("n")).scalar() > 0, F.lit(False))
    others = signatures.where(F.col("book_id") != F.lit(book_id)).agg(F.count(F.lit(1)).alias("_n"))
    counts = others.select(F.when(known, F.col("_n")).otherwise(F.lit(0)).alias("n_others"), found.alias("n_candidates"))
    saved = F.col("n_others") - F.col("n_candidates")
    return counts.select(
        "n_others", "n_candidates", saved.alias("n_saved"),
        F.when(F.col("n_others") > 0, saved / F.col("n_others") * 100).otherwise(F.lit(0.0)).alias("saved_pct"),
    )


def group_pairs(groups: DataFrame, params: LshParams, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Candidate pairs among groups of copies, by key: ``book_id_1, book_id_2``."""
    return first_meetings(groups, params, block_rows)


def _top_members(linked: DataFrame, firsts: DataFrame, keep: int) -> DataFrame:
    """``query, hits``: the ``keep`` best members for each query, best first.

    ``linked (query, leader, first_id, similarity)``. A group is worth its smallest id, so the
    first ``keep`` members come out of the first ``keep`` groups; both cuts are exact. An id that
    stands for several documents counts once, by its nearest; then fewer hits may be left.
    """
    best_groups = Window.partitionBy("query").orderBy(F.desc("similarity"), "first_id", "leader")
    best_members = Window.partitionBy("query").orderBy(F.desc("similarity"), "member")
    same_member = Window.partitionBy("query", "member").orderBy(F.desc("similarity"))
    groups = linked.withColumn("_rank", F.row_number().over(best_groups)).where(
        F.col("_rank") <= keep
    )
    members = (
        groups.drop("_rank")
        .join(firsts, "leader")
        .withColumn("_rank", F.row_number().over(same_member))
        .where(F.col("_rank") == 1)
        .withColumn("_rank", F.row_number().over(best_members))
        .where(F.col("_rank") <= keep)
    )
    hit = F.struct("_rank", F.col("member").alias("book_id"), "similarity")
    return members.groupBy("query").agg(F.sort_array(F.collect_list(hit)).alias("hits"))


def _numbered(hits: DataFrame, top_k: int) -> DataFrame:
    """``query_id, rank, book_id, similarity`` from the best ``hits`` of each asking document.

    An id that stands for several documents asks for all of them; each hit counts once, by its
    nearest. Both steps cut their rows before the shuffle.
    """
    each = hits.select("query_id", F.explode("hits").alias("hit"))
    nearest = each.groupBy("query_id", F.col("hit.book_id").alias("book_id")).agg(
        F.max("hit.similarity").alias("similarity")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "book_id")
    return (
        nearest.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top_k)
        .select("query_id", "rank", "book_id", F.col("similarity").cast("float").alias("similarity"))
    )


def _groups(signatures: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """``book_id (the group's key), first_id, n_copies, signature`` and ``leader, book_id``, stored."""
    usable = signatures.where(F.size("signature") > 0).select("book_id", "signature")
    keyed = stored(with_copy_key(usable, "signature"), f"{name}-keyed")
    groups = stored(copy_groups(keyed, "signature").withColumnRenamed("copy_key", "book_id"), name)
    return groups, stored(copy_members(keyed), f"{name}-members")


def find_similar_to_all(
    signatures: DataFrame, params: LshParams = DEV, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``find_similar_books`` for every document at once: ``query_id, rank, book_id, similarity``.

    Copies are searched once. A group's best ``top_k + 1`` members serve each of its documents,
    which leaves itself out, so a hot group costs its size and not its square.
    """
    keep = params.top_k + 1
    groups, members = _groups(signatures, "groups")
    pairs = stored(scored_leaders(groups, params, block_rows), "leader-pairs")
    firsts = groups.select(F.col("book_id").alias("leader"), "first_id")
    linked = pairs.select(
        F.col("book_id_1").alias("query"), F.col("book_id_2").alias("leader"), "similarity"
    ).unionByName(
        pairs.select(
            F.col("book_id_2").alias("query"), F.col("book_id_1").alias("leader"), "similarity"
        )
    ).unionByName(
        groups.where(F.col("n_copies") > 1).select(
            F.col("book_id").alias("query"),
            F.col("book_id").alias("leader"),
            F.lit(1.0).alias("similarity"),
        )
    )
    tops = _top_members(linked.join(firsts, "leader"), first_members(members, keep), keep)
    # One row of hits per group, and a group of many copies is cut into blocks to take it.
    own = matches_on_key(
        members.withColumnRenamed("book_id", "query_id"),
        tops.withColumnRenamed("query", "leader"),
        ["leader"],
        block_rows,
    )
    others = F.filter("hits", lambda hit: hit["book_id"] != F.col("query_id"))
    return _numbered(own.select("query_id", others.alias("hits")), params.top_k)


def scored_leaders(
    groups: DataFrame, params: LshParams, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Candidate pairs among leaders with their ``similarity``."""
    return estimate_pairs(group_pairs(groups, params, block_rows), groups)


def find_similar_to_texts(
    queries: DataFrame,
    signatures: DataFrame,
    params: LshParams = DEV,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``find_similar_by_text`` for a table of query signatures ``(book_id, signature)``.

    ``query_id, rank, book_id, similarity``. Ids are not compared: a query text that also
    stands in the corpus finds itself.
    """
    query_groups, askers = _groups(queries, "query-groups")
    groups, members = _groups(signatures, "groups")

    def buckets(of: DataFrame, name: str) -> DataFrame:
        return index_of(of.select(F.col("book_id").alias(name), "signature"), params)

    met = matches_on_key(
        buckets(query_groups, "query"), buckets(groups, "leader"), BUCKET, block_rows
    ).select("query", "leader").distinct()
    similarity = estimate_jaccard(F.col("_asked"), F.col("signature"))
    linked = (
        met.join(
            query_groups.select(
                F.col("book_id").alias("query"), F.col("signature").alias("_asked")
            ),
            "query",
        )
        .join(groups.select(F.col("book_id").alias("leader"), "first_id", "signature"), "leader")
        .select("query", "leader", "first_id", similarity.alias("similarity"))
    )
    tops = _top_members(linked, first_members(members, params.top_k), params.top_k)
    asked = askers.select(F.col("leader").alias("query"), F.col("book_id").alias("query_id"))
    return _numbered(
        matches_on_key(asked, tops, ["query"], block_rows).select("query_id", "hits"), params.top_k
    )


def compare_ranking(
    signatures: DataFrame,
    index: DataFrame,
    shingled: DataFrame,
    book_id,
    params: LshParams | None = None,
) -> DataFrame:
    """Every other document against one: ``book_id, jaccard, similarity, is_candidate``.

    Ordered by exact Jaccard. The query's set and signature are single values, so the corpus is
    read where it lies.
    """
    wanted = shingled.where(F.col("book_id") == F.lit(book_id))
    asked = wanted.agg(F.min(F.sort_array("shingles")).alias("shingles")).scalar()
    exact = (
        shingled.where(F.col("book_id") != F.lit(book_id))
        .withColumn("_asked", asked)
        .where(F.col("_asked").isNotNull())
        .select("book_id", exact_jaccard(F.col("shingles"), F.col("_asked")).alias("jaccard"))
    )
    candidates = _candidates_of_book(signatures, index, book_id, params)
    found = stored(candidates, "candidates").withColumn("_found", F.lit(True))
    return (
        exact.join(_estimates(signatures, signature_of(signatures, book_id)), "book_id")
        .join(found, "book_id", "left")
        .select(
            "book_id",
            "jaccard",
            "similarity",
            F.coalesce("_found", F.lit(False)).alias("is_candidate"),
        )
        .orderBy(F.desc("jaccard"), "book_id")
    )
