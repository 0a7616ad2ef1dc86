"""Band index over signatures and what can be read from it."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from nearkin.functions.batches import digests, few_rows, mod_prime
from nearkin.operators.pairing import BLOCK_ROWS, join_counted, key_sizes, pairs_sharing_key
from nearkin.params import DEV, LshParams, check_banding
from nearkin.session import stored

BUCKET = ("band_id", "bucket_hash")


def build_lsh_index(
    signatures: DataFrame, bands: int = DEV.bands, rows: int = DEV.rows, earlier: bool = False
) -> DataFrame:
    """Replace ``signature`` by ``band_id, bucket_hash``: one row per document and band.

    Values beyond ``bands * rows`` are not used; an empty signature gives no row, one too short
    for the banding raises. ``band_bucket`` of all bands is taken in one Arrow pass.
    With ``earlier`` a row also lists the document's buckets in the bands before, in their order.
    """
    check_banding(bands * rows, bands, rows)
    kept = [field for field in signatures.schema if field.name != "signature"]
    names = [field.name for field in kept]
    added = [StructField(name, IntegerType()) for name in BUCKET]
    if earlier:
        added.append(StructField("earlier", ArrayType(IntegerType())))
    before = np.concatenate([np.arange(band) for band in range(bands)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            signature = batch.column("signature")
            lengths = np.asarray(signature.value_lengths().fill_null(-1), dtype=np.int64)
            if ((lengths != 0) & (lengths < bands * rows)).any():
                raise ValueError(f"signature shorter than {bands} bands of {rows} rows")
            filled = np.flatnonzero(lengths)
            starts = (np.cumsum(lengths) - lengths)[filled]
            places = starts[:, None] + np.arange(bands * rows)
            packed = np.asarray(signature.flatten(), dtype=np.int64)[places].astype(">i4").tobytes()
            buckets = mod_prime(digests(packed[i : i + 4 * rows] for i in range(0, len(packed), 4 * rows)))
            each = pa.array(np.repeat(filled, bands))
            columns = [batch.column(name).take(each) for name in names]
            columns += [pa.array(np.tile(np.arange(bands, dtype=np.int32), len(filled)))]
            columns += [pa.array(buckets.astype(np.int32))]
            if earlier:
                ends = np.cumsum(np.tile(np.arange(bands), len(filled)))
                lists = buckets.astype(np.int32).reshape(-1, bands)[:, before].ravel()
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                columns += [pa.ListArray.from_arrays(pa.array(offsets), pa.array(lists))]
            yield pa.RecordBatch.from_arrays(columns, [*names, *[field.name for field in added]])

    return signatures.mapInArrow(run, StructType([*kept, *added]))


def find_candidate_pairs(index: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Distinct ``(book_id_1, book_id_2)``, the smaller id first, that share a bucket.

    The list is as long as the definition makes it: quadratic in a group of equal documents.
    ``copies.copy_groups`` first, and counts instead of lists, keep later work linear. An index
    alone does not say in which band a pair meets first, so each task holds its different pairs;
    ``pairs_of_signatures`` lists the same pairs and holds none.
    """
    return pairs_sharing_key(index, BUCKET, "book_id", block_rows=block_rows).distinct()


def first_meetings(signatures: DataFrame, params: LshParams, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``find_candidate_pairs`` of signatures whose ids do not repeat, without holding any pair.

    Each row carries the buckets of the bands before its own, so a pair is given in the first
    band in which it meets and need not be compared with other pairs.
    """
    index = build_lsh_index(signatures.select("book_id", "signature"), params.bands, params.rows, earlier=True)
    return meet_first(index, block_rows=block_rows).select("book_id_1", "book_id_2")


def meet_first(index: DataFrame, carried: Sequence[str] = (), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Pairs of an index with ``earlier`` in the first band in which they meet, and ``carried`` of both."""
    met = pairs_sharing_key(index, BUCKET, "book_id", ["earlier", *carried], block_rows)
    # Nearly all repeats are those of copies and end at the band just before.
    last = F.get("earlier_1", F.size("earlier_1") - 1) == F.get("earlier_2", F.size("earlier_2") - 1)
    same = F.zip_with("earlier_1", "earlier_2", lambda one, two: one == two)
    first = ~F.coalesce(last, F.lit(False)) & ~F.exists(same, lambda bucket: bucket)
    return met.where(first).drop("earlier_1", "earlier_2")


def pairs_of_signatures(signatures: DataFrame, params: LshParams, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``find_candidate_pairs`` of ``index_of(signatures, params)``.

    Pairs are compared with each other only if an id stands for several documents.
    """
    pairs = first_meetings(signatures, params, block_rows)
    return pairs if key_sizes(signatures, ["book_id"], "_size").isEmpty() else pairs.distinct()


def shared_buckets(index: DataFrame) -> DataFrame:
    """Members of every bucket with more than one: ``band_id, bucket_hash, n_members, book_id``.

    One row per member; a list per bucket would have no bound.
    """
    sizes = stored(key_sizes(index, BUCKET, "n_members"), "bucket-sizes")
    return join_counted(index, sizes, BUCKET, "n_members").select(*BUCKET, "n_members", "book_id")


def match_probability(similarity: Column, bands: int | Column, rows: int | Column) -> Column:
    """Chance that two sets of this similarity share a bucket: ``1 - (1 - s^r)^b``."""
    return 1 - F.pow(1 - F.pow(similarity, F.lit(rows)), F.lit(bands))


def match_threshold(bands: int | Column, rows: int | Column) -> Column:
    """Similarity about which the match probability rises: ``(1/b)^(1/r)``."""
    return F.pow(1 / F.lit(bands).cast("double"), 1 / F.lit(rows).cast("double"))


def s_curve(configs: DataFrame, points: int = 200) -> DataFrame:
    """``bands, rows, similarity, probability`` at evenly spaced similarities from 0 to 1."""
    at = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: i / (points - 1))
    spaced = configs.select("bands", "rows", F.explode(at).alias("similarity"))
    return spaced.withColumn(
        "probability", match_probability(F.col("similarity"), F.col("bands"), F.col("rows"))
    )


def index_of(signatures: DataFrame, params: LshParams) -> DataFrame:
    return build_lsh_index(signatures, params.bands, params.rows)
