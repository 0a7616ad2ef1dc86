"""Tokens, shingles and digests of whole batches, for Arrow maps over documents."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from hashlib import md5

import numpy as np
import pyarrow as pa

from nearkin.functions.hashing import PRIME

# Documents whose words are Python objects at one time.
ROWS_AT_ONCE = 500
# Weights of the four 32-bit words of a digest modulo p, as 2^32 = 2 (mod p).
_WEIGHTS = np.array([8, 4, 2, 1], dtype=np.int64)


def few_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)


def index_words(letters: bytes | None, stop_words: frozenset[bytes]) -> list[bytes]:
    """``text.index_tokens`` out of ``text.alphabet_only``, whose white space is that of ASCII."""
    return [w for w in (letters or b"").split() if len(w) > 1 and w not in stop_words]


def as_bytes(stop_words: Sequence[str]) -> frozenset[bytes]:
    return frozenset(w.encode() for w in stop_words)


def shingles_of(words: Sequence[bytes | None], k: int) -> list[bytes]:
    """Distinct runs of ``k`` words in the order of their first places; none below ``k`` words."""
    runs = zip(*[words[i:] for i in range(k)])
    if None in words:
        return list(dict.fromkeys(b" ".join([w for w in run if w is not None]) for run in runs))
    return list(dict.fromkeys(map(b" ".join, runs)))


def digests(values: Iterable[bytes]) -> bytes:
    """The md5 of every value, side by side."""
    return b"".join([md5(v, usedforsecurity=False).digest() for v in values])


def mod_prime(joined: bytes) -> np.ndarray:
    """``hashing.md5_mod_prime`` of every digest in ``digests``."""
    return (np.frombuffer(joined, ">u4").reshape(-1, 4).astype(np.int64) @ _WEIGHTS) % PRIME


def elements(lists: pa.Array) -> list[list[bytes | None]]:
    """The strings of every list as bytes; a null list is empty."""
    flat = lists.flatten().cast(pa.binary()).to_pylist()
    ends = np.cumsum(np.asarray(lists.value_lengths().fill_null(0), dtype=np.int64)).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends)]


def string_lists(lists: list[list[bytes]]) -> pa.ListArray:
    """Lists of UTF-8 values as an Arrow column of strings; an empty list stays one."""
    offsets = np.cumsum([0, *map(len, lists)]).astype(np.int32)
    flat = pa.array([v for values in lists for v in values], pa.binary()).cast(pa.string())
    return pa.ListArray.from_arrays(pa.array(offsets), flat)


def set_hashes(joined: bytes) -> np.ndarray:
    """The first 64 bits of every digest in ``digests``, in order."""
    return np.sort(np.frombuffer(joined, "<i8")[::2])
