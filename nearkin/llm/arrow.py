"""Arrow batches inside tasks: chunks of bounded size, and words and their hashes as arrays.

Texts are handled as UTF-8 bytes. All separators used here are ASCII, and no byte of a longer
UTF-8 sequence is ASCII, so a table of 256 entries decides what a byte is.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

CHUNK_BYTES = 2 << 20
OUT_BYTES = 8 << 20


def batches_of_bytes(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows in slices of at most ``limit`` bytes of ``column``; a longer text is alone."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(column).cast(pa.large_binary()))
        sizes = pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


@contextmanager
def rows_per_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs started inside the block send ``rows`` rows at most to Python at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, giving Arrow's free memory back at a task's end: Python workers live on and take the next."""

    @functools.wraps(run)
    def tidy(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return tidy


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins, with the end as last entry."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    data = column.buffers()[2]
    if data is None or len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def byte_table(members: str) -> np.ndarray:
    """Which bytes are among ``members``, all ASCII."""
    table = np.zeros(256, dtype=bool)
    table[list(members.encode("ascii"))] = True
    return table


#: Space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = byte_table(" \t\n\x0b\x0c\r")
#: ASCII but for digits and letters in lower case.
NOT_WORD = byte_table("".join(chr(i) for i in range(128) if not (chr(i).isdigit() or chr(i).islower())))
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true, none across a text's bounds; and each text's first run."""
    before = np.zeros(len(inside) + 1, dtype=bool)
    before[1:] = inside
    before[bounds] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(inside) + 1, dtype=bool)
    after[:-1] = inside
    after[bounds] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, bounds)


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, count: int) -> np.ndarray:
    known = _powers.get(str(base))
    if known is None or len(known) < count:
        known = np.full(max(count, CHUNK_BYTES + 1), base, dtype=np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        # What a text longer than a chunk needs goes when it is done.
        if count <= CHUNK_BYTES + 1:
            _powers[str(base)] = known
    return known[:count]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; distinct values stay distinct."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice, from the differences of one running polynomial."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(
        mix(np.arange(1, 257, dtype=np.uint64))[data] * _power(_BASE, len(data)), out=sums[1:]
    )
    moved = (sums[ends] - sums[starts]) * _power(_INVERSE, len(data) + 1)[starts]
    return mix(moved + (ends - starts).astype(np.uint64) * _BASE)


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k`` consecutive words, across text bounds too."""
    count = max(0, len(words) - k + 1)
    out = np.zeros(count, dtype=np.uint64)
    for i in range(k):
        out *= _BASE
        out += words[i : i + count]
    return mix(out)


def chars_before(data: np.ndarray) -> np.ndarray:
    """How many code points begin before each byte, with one entry more at the end."""
    out = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out
