"""Documents that are equal for the index, taken as one.

Equal documents share every bucket, so a third of the corpus in copies of one text would put a
third of all rows in one bucket of every band. One representative stands for all of them; what
concerns the single copies is counted from ``n_copies`` or joined back at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from nearkin.functions.batches import digests, elements, few_rows, mod_prime, set_hashes
from nearkin.functions.hashing import hash_family
from nearkin.functions.minhash import minima
from nearkin.functions.stopwords import ENGLISH_STOP_WORDS
from nearkin.operators.documents import letters_of, shingles_of_texts
from nearkin.operators.pairing import BLOCK_ROWS, matches_on_key, pairs_sharing_key
from nearkin.params import DEV
from nearkin.session import stored


def with_copy_key(books: DataFrame, value: str) -> DataFrame:
    """Add ``copy_key``, a 128-bit digest of the array ``value``, by which copies are told.

    The array is written out with its quotes and nulls, so no two arrays look the same. A set
    must come sorted to be recognised.
    """
    return books.withColumn("copy_key", F.md5(F.to_json(F.col(value))))


def hashed_sets(shingled: DataFrame, num_hashes: int | None = None, seed: int = 42) -> DataFrame:
    """``shingles`` as sorted 64-bit hashes, and ``copy_key``, by which equal sets are told.

    All in one Arrow pass, with ``signature`` if ``num_hashes`` is given. Two shingles with one
    hash matter only in two sets that are compared; of 10^8 pairs of sets of 1000 shingles, that
    happens in one run of 100,000. ``copy_key`` is a 128-bit digest of the hashes. A result of
    ``text_sets`` is returned as it is; it must have the signatures that are asked for.
    """
    if "copy_key" in shingled.columns:
        return shingled
    return _hashed(shingled, "shingles", elements, 0, num_hashes, seed)


def text_sets(
    books: DataFrame,
    k: int = DEV.shingle_k,
    num_hashes: int | None = None,
    seed: int = 42,
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """``hashed_sets`` of ``(book_id, content)``, analyzed as the index is: no list of strings leaves the pass."""
    shingles = shingles_of_texts(k, stop_words)
    return _hashed(letters_of(books), "letters", shingles, 1, num_hashes, seed)


def _hashed(
    rows: DataFrame, value: str, sets_of: Callable[[pa.Array], list[list[bytes]]], least: int, num_hashes: int | None, seed: int
) -> DataFrame:
    """The columns of ``hashed_sets`` in place of ``value``, without sets of fewer than ``least``."""
    kept = [field for field in rows.schema if field.name != value]
    names = [field.name for field in kept]
    added = [StructField("copy_key", StringType()), StructField("shingles", ArrayType(LongType()))]
    if num_hashes is not None:
        added.append(StructField("signature", ArrayType(IntegerType())))
        family = hash_family(num_hashes, seed)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            sets = sets_of(batch.column(value))
            chosen = [i for i, s in enumerate(sets) if len(s) >= least]
            # One digest of a shingle serves the set and the signature.
            joined = [digests(sets[i]) for i in chosen]
            hashed = [set_hashes(j) for j in joined]
            lengths = np.array([len(h) for h in hashed], dtype=np.int64)
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            flat = np.concatenate(hashed) if hashed else np.empty(0, np.int64)
            columns = [batch.column(name).take(pa.array(chosen, pa.int32())) for name in names]
            columns.append(pa.array([md5(h.tobytes(), usedforsecurity=False).hexdigest() for h in hashed], pa.string()))
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
            if num_hashes is not None:
                columns.append(minima(lengths, mod_prime(b"".join(joined)), family))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in (*kept, *added)])

    return rows.mapInArrow(run, StructType([*kept, *added]))


def numbered_sets(shingled: DataFrame, num_hashes: int | None = None) -> DataFrame:
    """``hashed_sets`` stored, with a ``number`` that tells rows apart in eight bytes."""
    hashed = hashed_sets(shingled, num_hashes)
    return stored(hashed.withColumn("number", F.monotonically_increasing_id()), "keyed")


def set_groups(keyed: DataFrame) -> DataFrame:
    """``copy_key, book_id (the group's number), n_copies`` and the ``signature`` of groups of equal sets.

    The sets themselves, which are most of the data, are not shuffled. Stored, numbers are eight bytes that stay.
    """
    groups = keyed.groupBy("copy_key").agg(F.count(F.lit(1)).alias("n_copies"), F.first("signature").alias("signature"))
    return groups.select("copy_key", F.monotonically_increasing_id().alias("book_id"), "n_copies", "signature")


def copy_groups(keyed: DataFrame, value: str) -> DataFrame:
    """``copy_key, first_id, n_copies, <value>``: one row per distinct array.

    ``first_id`` is the smallest id of the group, which need not be the group's alone: ids may
    repeat. Grouped by the digest and counted on the map side, so a hot group reaches the shuffle
    as one row per task and no array is compared or sorted.
    """
    return keyed.groupBy("copy_key").agg(
        F.min("book_id").alias("first_id"),
        F.count(F.lit(1)).alias("n_copies"),
        F.first(value).alias(value),
    )


def copy_members(keyed: DataFrame) -> DataFrame:
    """``leader, book_id``: every id of every group, named by the group's key."""
    return keyed.select(F.col("copy_key").alias("leader"), "book_id").distinct()


def first_members(members: DataFrame, count: int) -> DataFrame:
    """``leader, member``: the ``count`` smallest ids of each group.

    The rank filter limits groups before the shuffle, so a hot group sends few rows.
    """
    by_id = Window.partitionBy("leader").orderBy("book_id")
    return (
        members.withColumn("_rank", F.row_number().over(by_id))
        .where(F.col("_rank") <= count)
        .select("leader", F.col("book_id").alias("member"))
    )


def expand_pairs(
    leader_pairs: DataFrame,
    members: DataFrame,
    within: dict | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Pairs of leaders to pairs of documents, with the pairs inside each group added.

    ``leader_pairs`` has ``book_id_1, book_id_2`` (keys of groups) and value columns, likeness
    first; ``within`` gives the values of a pair of copies. Two leaders are given once. The result
    is the full list, once per two ids, so its size is that of the answer. Pairs are compared
    with each other only if an id is in more than one group.
    """
    values = [c for c in leader_pairs.columns if c not in ("book_id_1", "book_id_2")]
    across = stored(leader_pairs, "leader-pairs")
    for side in (1, 2):
        of_side = members.select(
            F.col("leader").alias(f"book_id_{side}"), F.col("book_id").alias(f"_member_{side}")
        )
        # A group of many copies in many pairs is cut into blocks on both sides.
        across = matches_on_key(across, of_side, [f"book_id_{side}"], block_rows)
    one, two = F.col("_member_1"), F.col("_member_2")
    across = across.where(one != two).select(
        F.least(one, two).alias("book_id_1"), F.greatest(one, two).alias("book_id_2"), *values
    )
    inside = pairs_sharing_key(members, ["leader"], "book_id", block_rows=block_rows).select(
        "book_id_1", "book_id_2", *[F.lit((within or {})[v]).alias(v) for v in values]
    )
    pairs = across.unionByName(inside)
    if members.groupBy("book_id").agg(F.count(F.lit(1)).alias("_groups")).where("_groups > 1").isEmpty():
        return pairs
    # An id that stands for several documents meets another more than once; the nearest counts.
    if not values:
        return pairs.distinct()
    best = F.max(F.struct(*values)).alias("_best")
    return pairs.groupBy("book_id_1", "book_id_2").agg(best).select("book_id_1", "book_id_2", "_best.*")
