"""Similarity of given pairs, and all pairs above an exact similarity."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.functions.minhash import estimate_jaccard
from nearkin.functions.overlaps import Block, block_of, similar_between
from nearkin.functions.shingles import exact_jaccard
from nearkin.operators.copies import hashed_sets
from nearkin.operators.pairing import join_counted
from nearkin.session import delete_folder, intermediate_tables, scratch_path, stored, stored_at

# Sets and shingles of a block, of which two are in one task; fewer than LEAST_VALUES are not parted.
SET_BLOCK_ROWS, BLOCK_VALUES, LEAST_VALUES = 1 << 15, 1 << 22, 50_000
# Shingles that are shuffled for one step; more go in several steps, so that the disk never holds them all.
# A step reads its table once more, so there are not more than so many, and steps grow with the data.
STEP_VALUES, MOST_STEPS = 1 << 27, 16


def _with_both(pairs: DataFrame, books: DataFrame, *values: str) -> DataFrame:
    for side in (1, 2):
        of_side = books.select(
            F.col("book_id").alias(f"book_id_{side}"), *[F.col(v).alias(f"_{v}_{side}") for v in values]
        )
        pairs = pairs.join(of_side, f"book_id_{side}")
    return pairs


def estimate_pairs(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """Add ``similarity``, the estimate from the two signatures."""
    both = _with_both(pairs, signatures, "signature")
    similarity = estimate_jaccard(F.col("_signature_1"), F.col("_signature_2"))
    return both.select(*pairs.columns, similarity.alias("similarity"))


def _numbered(shingled: DataFrame) -> DataFrame:
    """``book_id, number, shingles`` with shingles as 64-bit hashes, stored."""
    if "number" in shingled.columns:
        return shingled.select("book_id", "number", "shingles")
    hashed = hashed_sets(shingled.select("book_id", "shingles"))
    return stored(hashed.select("book_id", F.monotonically_increasing_id().alias("number"), "shingles"), "numbered-sets")


def ranked_sets(shingled: DataFrame) -> DataFrame:
    """``book_id, number, n_shingles, ranks, holders`` of every set, stored: its shared shingles as integers.

    Shingles are ranked in one global order, those of few documents first, and those that the same
    documents hold side by side: a digest of these documents, ``holders``, stands beside each rank.
    The ranks grow with the order and leave gaps, so ranking takes no single task. Shingles of one
    document only have no rank: they are counted in ``n_shingles`` and can be shared by nobody.
    ``shingled`` may be the stored ``copies.numbered_sets``. Only hashes and numbers are shuffled.
    """
    numbered = _numbered(shingled)
    postings = numbered.select("number", F.explode("shingles").alias("shingle"))
    counted = stored(
        postings.groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("df"), F.bit_xor(F.xxhash64("number")).alias("holders"))
        .where(F.col("df") > 1),
        "shingle-counts",
    )
    order = ["df", "holders", "shingle"]
    ranks = stored(
        counted.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("rank", F.monotonically_increasing_id()),
        "shingle-ranks",
    )
    # One list per document: bounded by the document, which is a row already.
    held = (
        join_counted(postings, ranks, ["shingle"], "df")
        .groupBy("number")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "holders"))).alias("held"))
    )
    sizes = numbered.select("book_id", "number", F.size("shingles").alias("n_shingles"))
    none = F.array().cast("array<bigint>")
    return stored(
        sizes.join(held, "number", "left").select(
            "book_id", "number", "n_shingles",
            F.coalesce("held.rank", none).alias("ranks"), F.coalesce("held.holders", none).alias("holders"),
        ),
        "ranked-sets",
    )


def exact_pairs(pairs: DataFrame, shingled: DataFrame) -> DataFrame:
    """Add ``jaccard`` of the two shingle sets of each given pair.

    Sets meet their pairs as 64-bit hashes, those of some of the pairs in each step.
    """
    pairs, sets = stored(pairs, "pairs"), _numbered(shingled)
    both_sizes = _with_both(pairs, sets.select("book_id", F.size("shingles").alias("n")), "n")
    steps = _n_steps(both_sizes.agg(F.sum(F.col("_n_1") + F.col("_n_2"))).first()[0] or 0)
    parts = []
    for step in range(steps):
        of_step = F.pmod(F.xxhash64("book_id_1", "book_id_2"), F.lit(steps)) == step
        both = _with_both(pairs.where(of_step) if steps > 1 else pairs, sets, "shingles")
        jaccard = exact_jaccard(F.col("_shingles_1"), F.col("_shingles_2"))
        part = both.select(*pairs.columns, jaccard.alias("jaccard"))
        parts.append(stored(part, "exact-pairs") if steps > 1 else part)
    return _all_rows(parts)


def sets_of_pairs(pairs: DataFrame, groups: DataFrame, keyed: DataFrame) -> DataFrame:
    """``book_id, number, shingles`` of the groups that are in a pair, out of ``copies.numbered_sets``.

    ``groups (copy_key, book_id)`` as of ``copies.set_groups``. Sets are moved in steps.
    """
    ids = pairs.select(F.explode(F.array("book_id_1", "book_id_2")).alias("book_id")).distinct()
    wanted = stored(ids.join(groups.select("book_id", "copy_key"), "book_id"), "wanted")
    steps = _n_steps(keyed.agg(F.coalesce(F.sum(F.size("shingles")), F.lit(0))).first()[0])
    parts = []
    for step in range(steps):
        some = keyed.where(F.pmod(F.xxhash64("copy_key"), F.lit(steps)) == step) if steps > 1 else keyed
        # Copies become one row before they are moved, however many there are.
        different = some.groupBy("copy_key").agg(F.first("shingles").alias("shingles"))
        part = different.join(wanted, "copy_key").select("book_id", F.col("book_id").alias("number"), "shingles")
        parts.append(stored(part, "sets-of-pairs") if steps > 1 else part)
    return _all_rows(parts)


def estimate_error(pairs: DataFrame, shingled: DataFrame, signatures: DataFrame) -> DataFrame:
    """Add ``jaccard``, ``similarity`` and their absolute difference ``error``."""
    scored = exact_pairs(estimate_pairs(pairs, signatures), shingled)
    return scored.withColumn("error", F.abs(F.col("jaccard") - F.col("similarity")))


def _prefixes(sets: DataFrame, min_jaccard: float) -> DataFrame:
    """``book_id, n_shingles, at, holders``: the rarest shingles of each set, enough to meet.

    In one global order (rare first), two sets with J >= t share an element among the first
    ``n - ceil(t*n) + 1`` of each (prefix filtering: Chaudhuri et al. 2006; Xiao et al. 2008).
    Shingles of one document only come first in that order and meet nothing, so they count for
    the position ``at`` but are not joined. Of shingles that the same documents hold, which stand
    side by side, the first is joined: the others would bring the same pairs once more each.
    """
    n, alone = F.col("n_shingles"), F.col("n_shingles") - F.size("ranks")
    # The small amount taken off keeps rounding from lengthening the required overlap.
    prefix = n - F.ceil(n * min_jaccard - 1e-9).cast("int") + 1
    taken = F.transform(
        F.slice("holders", F.lit(1), F.greatest(prefix - alone, F.lit(0))),
        lambda held, i: F.struct(i.alias("i"), held.alias("holders"), F.get("holders", i - 1).alias("before")),
    )
    first = F.filter(taken, lambda x: (x["i"] == 0) | (x["holders"] != x["before"]))
    placed = sets.select("book_id", "n_shingles", alone.alias("_alone"), F.explode(first).alias("x"))
    return placed.select("book_id", "n_shingles", (F.col("_alone") + F.col("x.i")).alias("at"), "x.holders")


def _n_steps(n_values: int) -> int:
    return min(max(1, ceil(n_values / STEP_VALUES)), MOST_STEPS)


def _all_rows(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _shared(sets: DataFrame, folder: str, kept: Column) -> DataFrame:
    """``number`` and what ``kept`` keeps of each set's shingles that sets of another ``kind`` hold, once for each step.

    Sets of one kind are equal. A step takes its share of the different shingles, out of all sets
    ``number, kind, held``, and stores its rows under ``folder``.
    """
    spark = sets.sparkSession
    steps = _n_steps(sets.agg(F.coalesce(F.sum(F.size("held")), F.lit(0))).first()[0])
    postings = sets.select("number", "kind", F.explode("held").alias("shingle"))
    parts = []
    for step in range(steps):
        some = postings.where(F.pmod(F.col("shingle"), F.lit(steps)) == step) if steps > 1 else postings
        counted = some.groupBy("shingle").agg(
            F.count(F.lit(1)).alias("df"), F.min("kind").alias("lowest"), F.max("kind").alias("highest")
        )
        with intermediate_tables(spark):
            several = stored(counted.where("lowest < highest").select("shingle", "df"), "shingle-counts")
            held = join_counted(some.select("number", "shingle"), several, ["shingle"], "df")
            parts.append(stored_at(held.groupBy("number").agg(kept), f"{folder}/{step}"))
    return _all_rows(parts)


def _enough(n_shared: Column, min_jaccard: float) -> Column:
    """A similar set shares at least ``min_jaccard`` of all shingles."""
    # The small amount taken off keeps rounding from asking for one shingle more.
    return n_shared >= F.ceil(F.col("n_shingles") * min_jaccard - 1e-9)


def _able_sets(sets: DataFrame, min_jaccard: float) -> DataFrame:
    """Of ``name, number, kind, n_shingles, held``, stored, the sets that can be similar to one of another kind.

    Only counts are kept of the shingles that they share, and only sets that are able are moved.
    """
    spark = sets.sparkSession
    folder = scratch_path(spark, "shared-counts")
    shared = _shared(sets, folder, F.count(F.lit(1)).alias("n_shared"))
    totals = shared.groupBy("number").agg(F.sum("n_shared").alias("n_shared"))
    sized = totals.join(sets.select("number", "n_shingles"), "number")
    able = stored_at(sized.where(_enough(F.col("n_shared"), min_jaccard)).select("number"), f"{folder}/able")
    found = stored(sets.join(able, "number", "left_semi"), "able-sets")
    delete_folder(spark, folder)
    return found


def _pruned(able: DataFrame, min_jaccard: float) -> DataFrame:
    """``number, n_shingles, held`` without shingles of one set only, and then without sets that are not able."""
    spark = able.sparkSession
    folder = scratch_path(spark, "shared-shingles")
    # One list per document: bounded by the document, which is a row already.
    shared = _shared(able, folder, F.collect_list("shingle").alias("held"))
    held = shared.groupBy("number").agg(F.flatten(F.collect_list("held")).alias("held"))
    sized = held.join(able.select("number", "n_shingles"), "number").select("number", "n_shingles", "held")
    left = stored(sized.where(_enough(F.size("held"), min_jaccard)), "able-sets")
    delete_folder(spark, folder)
    return left


def _block(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, Block]:
    """The numbers and the sets of rows ``number, n_shingles, held``."""
    number, sizes, lengths, values = (
        np.concatenate([part(b) for b in batches]) if batches else np.empty(0, np.int64)
        for part in (
            lambda b: np.asarray(b.column("number")),
            lambda b: np.asarray(b.column("n_shingles")),
            lambda b: np.asarray(b.column("held").value_lengths()),
            lambda b: np.asarray(b.column("held").flatten()),
        )
    )
    return number, block_of(sizes, lengths, values)


def _similar_in_blocks(min_jaccard: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Similar pairs between the blocks of one group of rows, or inside its only block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: tuple[list, list] = ([], [])
        inside = False
        for batch in batches:
            inside = batch.column("low")[0] == batch.column("high")[0]
            later = batch.column("later")
            for side, wanted in zip(sides, (pc.invert(later), later)):
                side.append(batch.filter(wanted).select(["number", "n_shingles", "held"]))
        numbers, first = _block(sides[0])
        others, second = (numbers, first) if inside else _block(sides[1])
        for i, j, jaccard in similar_between(first, second, min_jaccard):
            columns = [pa.array(numbers[i]), pa.array(others[j]), pa.array(jaccard)]
            yield pa.RecordBatch.from_arrays(columns, ["book_id_1", "book_id_2", "jaccard"])

    return run


def similar_sets(
    shingled: DataFrame, min_jaccard: float, block_rows: int = SET_BLOCK_ROWS
) -> DataFrame:
    """All pairs with exact Jaccard >= ``min_jaccard``: ``book_id_1, book_id_2, jaccard``, stored.

    Sets that share too little with all others together are left out first. The others are
    dealt to blocks, and every two blocks meet in a group of their own, in which all shared
    shingles are counted side by side: no pair is shuffled but the similar ones. Each group is
    as large as two blocks, whatever the data, and groups are made in steps. Needs
    ``min_jaccard > 0``; pairs that share nothing have J = 0 and are not enumerated.
    """
    _check_threshold(min_jaccard)
    path = scratch_path(shingled.sparkSession, "similar")
    with intermediate_tables(shingled.sparkSession):
        sets = _sets(_numbered(shingled), "book_id", F.col("number"))
        return stored_at(similar_able(_able_sets(sets, min_jaccard), min_jaccard, block_rows), path)


def able_groups(keyed: DataFrame, min_jaccard: float) -> DataFrame:
    """Of ``copies.numbered_sets``, the groups of equal sets that can be similar to another, for ``similar_able``.

    Copies are told among the few sets that are able, so the others are never moved for it.
    """
    _check_threshold(min_jaccard)
    able = _able_sets(_sets(keyed, "copy_key", F.xxhash64("copy_key")), min_jaccard)
    values = [F.first(c).alias(c) for c in ("number", "n_shingles", "held")]
    return able.groupBy("name").agg(*values).withColumn("kind", F.col("number"))


def _check_threshold(min_jaccard: float) -> None:
    if not 0 < min_jaccard <= 1:
        raise ValueError("min_jaccard must be above 0 and at most 1")


def _sets(numbered: DataFrame, name: str, kind: Column) -> DataFrame:
    held = F.col("shingles")
    return numbered.select(
        F.col(name).alias("name"), "number", kind.alias("kind"), F.size(held).alias("n_shingles"), held.alias("held")
    )


def similar_able(able: DataFrame, min_jaccard: float, block_rows: int = SET_BLOCK_ROWS) -> DataFrame:
    """``similar_sets`` of the stored result of ``able_groups``, by ``name``."""
    parts = _similar_numbers(_pruned(able, min_jaccard), min_jaccard, block_rows)
    names = able.select(F.col("number").alias("book_id"), "name")
    one, two = F.col("_name_1"), F.col("_name_2")
    return _with_both(_all_rows(parts), names, "name").select(
        F.least(one, two).alias("book_id_1"), F.greatest(one, two).alias("book_id_2"), "jaccard"
    )


def _similar_numbers(able: DataFrame, min_jaccard: float, block_rows: int) -> list[DataFrame]:
    """Parts of ``book_id_1, book_id_2, jaccard`` of the similar ones among ``number, n_shingles, held``.

    Every block goes to all others, so what is shuffled grows with their number. A step makes the
    groups whose two blocks have a certain sum, modulo the steps: as many of each block, and no
    more shingles than the table holds or STEP_VALUES.
    """
    n_sets, n_held = able.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("held")), F.lit(0))).first()
    blocks = _n_blocks(able.sparkSession, n_sets, n_held, block_rows)
    steps = max(1, ceil(blocks * n_held / max(STEP_VALUES, n_held)))
    own, other = F.col("_own"), F.col("_other")
    dealt = able.withColumn("_own", F.pmod(F.xxhash64("number"), F.lit(blocks)).cast("int"))
    schema = "book_id_1 bigint, book_id_2 bigint, jaccard double"
    parts = []
    for step in range(steps):
        others = F.sequence(F.pmod(F.lit(step) - own, F.lit(steps)), F.lit(blocks - 1), F.lit(steps))
        met = dealt.withColumn("_other", F.explode(others)).select(
            F.least(own, other).alias("low"), F.greatest(own, other).alias("high"), (own > other).alias("later"),
            "number", F.col("n_shingles").cast("bigint").alias("n_shingles"), "held",
        )
        similar = met.groupBy("low", "high").applyInArrow(_similar_in_blocks(min_jaccard), schema)
        parts.append(stored(similar, "similar-numbers"))
    return parts


def _n_blocks(spark: SparkSession, n_sets: int, n_held: int, block_rows: int) -> int:
    """Blocks of at most about ``block_rows`` sets and BLOCK_VALUES shingles, more if that keeps all partitions busy."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    busy = min(ceil(sqrt(2 * partitions)), ceil(n_held / LEAST_VALUES))
    return max(1, ceil(n_sets / block_rows), ceil(n_held / BLOCK_VALUES), busy)
