"""MinHash signatures and the similarity estimate between them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from nearkin.functions.batches import digests, elements, few_rows, mod_prime
from nearkin.functions.hashing import PRIME, hash_family

Lists = tuple[np.ndarray, np.ndarray]
# Hashes that go through the whole family at one time.
VALUES_AT_ONCE = 1 << 15


def minima(lengths: np.ndarray, values: np.ndarray, family: list[tuple[int, int]]) -> pa.ListArray:
    """One signature per list: the least ``(a*h + b) mod p`` over its values for every (a, b).

    Some lists at a time, so that their values stay in the processor's cache for all of the family.
    """
    filled = lengths > 0
    starts = (np.cumsum(lengths) - lengths)[filled]
    minima = np.empty((len(starts), len(family)), dtype=np.int32)
    low = 0
    while low < len(starts) and family:
        high = max(int(np.searchsorted(starts, starts[low] + VALUES_AT_ONCE)), low + 1)
        some = values[starts[low] : starts[high] if high < len(starts) else None]
        mixed, spare = np.empty((2, len(some)), dtype=np.int64)
        for i, (a, b) in enumerate(family):
            np.multiply(some, a, out=mixed)
            np.add(mixed, b, out=mixed)
            # 2^31 = 1 (mod p): the upper bits are added to the lower ones, and the sum is below 2p.
            np.right_shift(mixed, 31, out=spare)
            np.bitwise_and(mixed, PRIME, out=mixed)
            np.add(mixed, spare, out=mixed)
            np.subtract(mixed, PRIME, out=spare)
            # Below 0 is large without a sign, and the value before stays.
            np.minimum(mixed.view(np.uint64), spare.view(np.uint64), out=mixed.view(np.uint64))
            minima[low:high, i] = np.minimum.reduceat(mixed, starts[low:high] - starts[low])
        low = high
    ends = np.cumsum(np.where(filled, len(family), 0))
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(minima.ravel()))


def _listed(hashes: pa.ListArray) -> Lists:
    lengths = np.asarray(hashes.value_lengths().fill_null(0), dtype=np.int64)
    return lengths, np.asarray(hashes.flatten(), dtype=np.int64)


def hashes_of(sets: list[list[bytes]]) -> Lists:
    """The lengths of the sets and ``hashing.stable_hash`` of all their shingles."""
    lengths = np.array([len(s) for s in sets], dtype=np.int64)
    return lengths, mod_prime(b"".join(map(digests, sets)))


def sign_by(rows: DataFrame, value: str, lists: Callable[[pa.Array], Lists], num_hashes: int, seed: int) -> DataFrame:
    """Replace ``value`` by ``signature`` (``array<int>``); ``lists`` hashes a batch of values.

    One Arrow batch of documents is reduced by ``num_hashes`` vector passes. It needs no
    shuffle, where exploding the shingles and taking grouped minima moves a row of
    ``num_hashes`` buffers per document. An empty or null value gives an empty signature.
    """
    family = hash_family(num_hashes, seed)
    kept = [field for field in rows.schema if field.name != value]
    names = [field.name for field in kept]

    def signed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            columns = [batch.column(name) for name in names]
            columns.append(minima(*lists(batch.column(value)), family))
            yield pa.RecordBatch.from_arrays(columns, [*names, "signature"])

    schema = StructType([*kept, StructField("signature", ArrayType(IntegerType()))])
    return rows.mapInArrow(signed, schema)


def sign(hashed: DataFrame, num_hashes: int, seed: int = 42) -> DataFrame:
    """Replace ``hashes`` (``array<bigint>``) by ``signature``."""
    return sign_by(hashed, "hashes", _listed, num_hashes, seed)


def sign_sets(shingled: DataFrame, num_hashes: int, seed: int = 42) -> DataFrame:
    """Replace ``shingles`` (``array<string>``) by ``signature``, digests taken in the same pass."""
    return sign_by(shingled, "shingles", lambda sets: hashes_of(elements(sets)), num_hashes, seed)


def matching_positions(left: Column, right: Column) -> Column:
    return F.size(F.filter(F.zip_with(left, right, lambda a, b: a == b), lambda same: same))


def estimate_jaccard(left: Column, right: Column) -> Column:
    """Share of equal positions as double; 0 for empty signatures or different lengths."""
    comparable = (F.size(left) == F.size(right)) & (F.size(left) > 0)
    return F.when(
        comparable, matching_positions(left, right) / F.size(left)
    ).otherwise(F.lit(0.0))
