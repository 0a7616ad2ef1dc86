"""Homomorphic multiset fingerprints of documents by paragraph."""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.llm.arrow import CHUNK_BYTES, SPACES, batches_of_bytes, flat, grams, hashes, mix, runs
from nearkin.llm.columns import text_or_empty

#: Lanes of 64 bits that decide equality, summed modulo 2^64.
EXACT_LANES = 16
#: Lanes of 32 bits that measure likeness, summed modulo 2^32.
LIKENESS_LANES = 512
#: A piece's likeness vector is a stretch of so many drawn values that begins where its hash says.
DRAWN = 1 << 21
#: A lane's value for a piece is a Cauchy variable times this, as an integer.
SCALE = 8
#: Pieces whose vectors are added up at a time.
PIECES_AT_ONCE = 256
#: Words in the pieces of a paragraph that the likeness lanes count.
PIECE_WORDS = 3
ROWS_PER_RANGE = 500
MAX_RANGES = 10_000


class Fingerprint:
    """The sum of the vectors of a multiset of paragraphs; a value that can be added and taken away.

    A paragraph's vector has two parts. The exact lanes are an extendable hash of its bytes,
    so that two multisets differ in them but for chance. The likeness lanes add up, for each of
    the paragraph's word pieces, a vector of Cauchy variables that its hash names: in every lane
    of the difference of two sums stands a Cauchy variable whose scale is the sum of the absolute
    differences of the pieces' counts, so that pieces which repeat count as often as they do.
    Sums do not depend on the order of paragraphs, and a paragraph is inserted or deleted by
    adding or subtracting its vector.
    """

    __slots__ = ("exact", "likeness", "pieces")

    def __init__(self, exact=None, likeness=None, pieces: int = 0):
        self.exact = np.zeros(EXACT_LANES, np.uint64) if exact is None else exact
        self.likeness = np.zeros(LIKENESS_LANES, np.uint32) if likeness is None else likeness
        self.pieces = pieces

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(
            self.exact + other.exact, self.likeness + other.likeness, self.pieces + other.pieces
        )

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(
            self.exact - other.exact, self.likeness - other.likeness, self.pieces - other.pieces
        )

    def to_text(self) -> str:
        """All lanes in base 64; equal for equal multisets only."""
        return base64.b64encode(
            self.exact.astype("<u8").tobytes()
            + self.likeness.astype("<u4").tobytes()
            + self.pieces.to_bytes(8, "little")
        ).decode("ascii")

    @classmethod
    def from_text(cls, text: str) -> Fingerprint:
        raw = base64.b64decode(text)
        cut = EXACT_LANES * 8
        return cls(
            np.frombuffer(raw[:cut], "<u8").copy(),
            np.frombuffer(raw[cut:-8], "<u4").copy(),
            int.from_bytes(raw[-8:], "little"),
        )

    def near(self, other: Fingerprint) -> float:
        """Estimated Jaccard likeness of the two multisets of pieces, from 0 to 1; 1 if equal."""
        return likeness([self], [other])[0]


def _scales(lanes: np.ndarray) -> np.ndarray:
    """The likeliest scale of the Cauchy variables in each row."""
    squares = lanes.astype(np.float64) ** 2
    scale = np.median(np.abs(lanes), axis=1).astype(np.float64) ** 2
    some = scale > 0
    for _ in range(12):
        shares = scale[some, None] / (scale[some, None] + squares[some])
        scale[some] *= lanes.shape[1] / 2 / shares.sum(axis=1)
    return np.sqrt(scale)


def likeness(left: list[Fingerprint], right: list[Fingerprint]) -> list[float]:
    """``near`` of many pairs at once."""
    if not left:
        return []
    apart = np.stack([a.likeness - b.likeness for a, b in zip(left, right, strict=True)]).astype(np.int32)
    both = np.array([a.pieces + b.pieces for a, b in zip(left, right, strict=True)], np.float64)
    least = np.array([abs(a.pieces - b.pieces) for a, b in zip(left, right, strict=True)], np.float64)
    differing = np.clip(_scales(apart) / SCALE, least, both)
    found = np.divide(both - differing, both + differing, out=np.zeros(len(both)), where=both > 0)
    return [
        1.0 if np.array_equal(a.exact, b.exact) else float(x) for a, b, x in zip(left, right, found, strict=True)
    ]


@functools.cache
def _piece_vectors() -> np.ndarray:
    """All stretches of the drawn values, by where they begin; the same in every process."""
    drawn = np.random.default_rng(20_011).standard_cauchy(DRAWN) * SCALE
    # The rare large values carry the scale of long sums and must not be cut.
    return np.lib.stride_tricks.sliding_window_view(np.rint(drawn).astype(np.int32), LIKENESS_LANES)


def _vectors(texts: list[str]) -> Iterator[Fingerprint]:
    """Of each text, the sum over its paragraphs: the parts between line feeds, the empty ones too."""
    column = pa.array(texts, pa.large_string())
    data, bounds = flat(column)
    starts, ends, _ = runs(data != 10, bounds)
    words = runs(~SPACES[data], bounds)
    word_hashes = hashes(data, words[0], words[1])
    # A piece stays inside its paragraph, as the vector is the paragraph's own.
    line = np.searchsorted(starts, words[0], side="right")
    found = grams(word_hashes, PIECE_WORDS)
    inside = line[: len(found)] == line[PIECE_WORDS - 1 :] if len(found) else np.zeros(0, bool)
    piece_at, piece = np.flatnonzero(inside), found[inside]
    # Paragraphs too short for a piece count as one.
    n_words = np.bincount(line, minlength=len(starts) + 1)[1:]
    short = np.flatnonzero((n_words > 0) & (n_words < PIECE_WORDS))
    short_hash = mix(hashes(data, starts[short], ends[short]) + np.uint64(1))
    at = np.concatenate([words[0][piece_at], starts[short]])
    piece = np.concatenate([piece, short_hash])
    owner = np.searchsorted(bounds, at, side="right") - 1
    order = np.argsort(owner, kind="stable")
    vectors = _piece_vectors()
    which = (piece % np.uint64(len(vectors))).astype(np.int64)[order]
    ends = np.cumsum(np.bincount(owner, minlength=len(texts)))
    for i, text in enumerate(texts):
        exact = np.zeros(EXACT_LANES, np.uint64)
        if text:
            for paragraph in text.split("\n"):
                digest = hashlib.shake_128(paragraph.encode("utf-8")).digest(EXACT_LANES * 8)
                exact += np.frombuffer(digest, "<u8")
        a, b = int(ends[i - 1]) if i else 0, int(ends[i])
        lanes = np.zeros(LIKENESS_LANES, np.int64)
        for at in range(a, b, PIECES_AT_ONCE):
            lanes += vectors[which[at : min(b, at + PIECES_AT_ONCE)]].sum(axis=0, dtype=np.int64)
        yield Fingerprint(exact, lanes.astype(np.uint32), b - a)


def of_paragraphs(paragraphs: Iterable[str]) -> Fingerprint:
    """The fingerprint of the document that these paragraphs make up, in any order."""
    total = Fingerprint()
    for paragraph in paragraphs:
        total = total + next(_vectors([paragraph]))
    return total


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every document. A null text is empty, with a fingerprint of zeros."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))

    def run(batches):
        for batch in batches_of_bytes(batches, "text"):
            made = [f.to_text() for f in _vectors(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(made, pa.string())], names=["doc_id", "fingerprint"]
            )

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def merged(fingerprints: DataFrame, *keys: str) -> DataFrame:
    """The fingerprint of the union of the multisets of all rows of each key.

    Sums do not depend on order, so every task adds up its own rows of a key first.
    """
    kinds = ", ".join(f"`{k}` {fingerprints.schema[k].dataType.simpleString()}" for k in keys)

    def add_up(batches):
        sums: dict[tuple, Fingerprint] = {}
        for batch in batches:
            for row in batch.select([*keys, "fingerprint"]).to_pylist():
                key = tuple(row[k] for k in keys)
                sums[key] = sums.get(key, Fingerprint()) + Fingerprint.from_text(row["fingerprint"])
                if len(sums) > 50_000:
                    yield from flush(sums)
                    sums = {}
        yield from flush(sums)

    def flush(sums):
        rows = [dict(zip(keys, k, strict=True)) | {"fingerprint": f.to_text()} for k, f in sums.items()]
        if rows:
            yield from pa.Table.from_pylist(rows).to_batches()

    schema = f"{kinds}, fingerprint string"
    partial = fingerprints.select(*keys, "fingerprint").mapInArrow(add_up, schema)
    return partial.groupBy(*keys).applyInArrow(
        lambda table: pa.Table.from_batches(list(add_up(table.to_batches()))), schema
    )


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next``.

    Each document beside the next one in ascending id (equal ids by text, nulls first, the last
    followed by the first) and its edited text: the last quarter of its code points replaced
    by the first as many of the next document. Documents are dealt out by ranges of the id whose
    bounds are quantiles, at most MAX_RANGES; the first document of a range goes to the range
    before, too. Inside a range rows are sorted on disk if need be and read as a stream. A null
    text is empty; an empty table gives an empty one.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")
    )
    n_ranges = min(MAX_RANGES, rows.count() // ROWS_PER_RANGE + 1)
    shares = [i / n_ranges for i in range(1, n_ranges)]
    found = rows.agg(F.percentile_approx("doc_id", shares, 100 * n_ranges)).first()[0] if shares else None
    bounds = np.array(sorted(set(found or [])), dtype=np.int64)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        # Null ids come first, as in the sort.
        known = ids.fillna(np.iinfo(np.int64).min).astype("int64")
        return pd.Series(np.searchsorted(bounds, known, side="right").astype(np.int32))

    # At most one row per range.
    heads = rows.groupBy(range_of("doc_id").alias("range")).agg(F.min("doc_id").alias("head")).collect()
    has_null = rows.filter(F.col("doc_id").isNull()).limit(1).count() > 0
    order = sorted((r["range"], None if has_null and r["range"] == 0 else r["head"]) for r in heads)
    before = {head: order[i - 1][0] for i, (_, head) in enumerate(order)}

    @F.pandas_udf("array<int>")
    def targets(ids: pd.Series) -> pd.Series:
        own = np.searchsorted(bounds, ids.fillna(np.iinfo(np.int64).min).astype("int64"), side="right")
        keys = [None if pd.isna(i) else int(i) for i in ids]
        return pd.Series([[r, before[k]] if k in before else [r, -1] for r, k in zip(own, keys, strict=True)])

    dealt = (
        rows.withColumn("targets", targets("doc_id"))
        .select("doc_id", "text", F.posexplode("targets").alias("tail", "range"))
        .filter("range >= 0")
        .repartition("range")
        .sortWithinPartitions("range", "tail", "doc_id", "text")
    )
    return dealt.mapInArrow(
        _next_to_each,
        "doc_id long, n_chars long, edited string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, str]]:
    """Id, text and next text of the rows that are not copies of another range's first."""
    held = None
    for batch in batches_of_bytes(batches, "text"):
        columns = [batch.column(c).to_pylist() for c in ("range", "tail", "doc_id", "text")]
        for range_, tail, doc_id, text in zip(*columns, strict=True):
            if held is not None and held[0] == range_:
                yield held[1], held[2], text
            held = None if tail else (range_, doc_id, text)


def _next_to_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunk, size = [], 0
    for row in _neighbours(batches):
        chunk.append(row)
        size += len(row[1])
        if size > CHUNK_BYTES:
            yield _compared(chunk)
            chunk, size = [], 0
    if chunk:
        yield _compared(chunk)


def _compared(chunk: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
    ids, texts, following = map(list, zip(*chunk, strict=True))
    edited = []
    for text, after in zip(texts, following, strict=True):
        quarter = len(text) // 4
        edited.append(text[: len(text) - quarter] + after[:quarter])
    own, changed = list(_vectors(texts)), list(_vectors(edited))
    apart = [i for i in range(len(texts)) if i + 1 == len(texts) or following[i] is not texts[i + 1]]
    fresh = dict(zip(apart, _vectors([following[i] for i in apart]), strict=True))
    after = [fresh[i] if i in fresh else own[i + 1] for i in range(len(texts))]
    columns = {
        "doc_id": pa.array(ids, pa.int64()),
        "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        "edited": pa.array(edited, pa.string()),
        "fingerprint": [f.to_text() for f in own],
        "edited_fingerprint": [f.to_text() for f in changed],
        "near_edited": likeness(own, changed),
        "near_next": likeness(own, after),
    }
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))
