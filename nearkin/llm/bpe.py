"""Byte-level BPE over a distinct-word table, and back.

A word is a run of white space with the run of other characters after it: no piece of the
tokenizer's own splitter reaches from a visible character into white space, so words can be
encoded by themselves and their ids put side by side.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.llm.arrow import OUT_BYTES, batches_of_bytes
from nearkin.llm.columns import text_or_empty

#: White space of the Unicode property White_Space; fixed by the tokenizer's splitter.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: All but the blank and the line feed: their presence asks for the general pattern.
RARE_WHITE = [c for c in map(chr, range(0x3001)) if re.match(f"[{WHITE}]", c) and c not in " \n"]
_USUAL = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_GENERAL = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: Letter and number classes of these characters are the same in all versions of Unicode.
_SETTLED = re.compile(r"[\x00-\u024f]*").fullmatch

BLOCK_BYTES = 8 << 20
WORDS_PER_BUCKET = 200_000
#: Words that a process keeps with their ids, none longer than this: together some 100 MB at most.
CACHED_WORDS, CACHED_CHARS = 400_000, 40


def vocabulary(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


@functools.cache
def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for (fixed by the format)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """One vocabulary in one Python process: words to ids, ids to pieces."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self._cut = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self.cache: dict[str, bytes] = {}
        self._path = path

    def words(self, text: str) -> list[str]:
        if self._cut is not None and any(token in text for token in self.added):
            parts = self._cut.split(text)
            return [w for p in parts if p for w in ([p] if p in self.added else self._plain(p))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if any(c in text for c in RARE_WHITE):
            return _GENERAL.findall(text)
        return _USUAL.findall(text)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers."""
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    @functools.cached_property
    def pieces(self) -> list[bytes]:
        """The bytes of each id."""
        table, byte_of = [b""] * self.tokenizer.get_vocab_size(), _byte_of()
        for token, i in self.tokenizer.get_vocab().items():
            special = token in self.added
            table[i] = token.encode() if special else bytes(map(byte_of.__getitem__, token))
        return table

    def decode(self, ids: bytes) -> str:
        """Every id joined to its piece; bytes that are no UTF-8 become the replacement character."""
        found = np.frombuffer(ids, "<u4").tolist()
        return b"".join(map(self.pieces.__getitem__, found)).decode("utf-8", "replace")

    @functools.cached_property
    def _merges(self):
        """The same merges in tiktoken: every byte-level piece has its id as its rank."""
        import tiktoken

        ranks = {p: i for i, p in enumerate(self.pieces) if p and i not in self.added.values()}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """The ids of a whole text; words seen before come from a cache of bounded size."""
        cache = self.cache
        words = self.words(text)
        try:
            return b"".join(map(cache.__getitem__, words))
        except KeyError:
            pass
        if len(cache) > CACHED_WORDS:
            cache.clear()
        merges, long = self._merges.encode_ordinary, {}
        for word in words:
            if word not in cache and word not in long:
                known = cache if len(word) <= CACHED_CHARS else long
                if _SETTLED(word) and word not in self.added:
                    known[word] = array("I", merges(word)).tobytes()
                else:
                    known[word] = self.encode_words([word])[0]
        return b"".join([cache[w] if w in cache else long[w] for w in words])


@functools.lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """The process's own codec of a file; Python workers are reused from task to task."""
    return Codec(path)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Rows of the task in blocks of about BLOCK_BYTES; the same rows give the same blocks."""
    context = TaskContext.get()
    first = (context.partitionId() if context else 0) << 32
    held, size, count = [], 0, 0
    for batch in batches_of_bytes(batches, "text", BLOCK_BYTES):
        nbytes = batch.column("text").nbytes
        if held and size + nbytes > BLOCK_BYTES:
            yield first + count, held
            held, size, count = [], 0, count + 1
        held.append(batch)
        size += nbytes
    if held:
        yield first + count, held


def _pack(values: list[str]) -> bytes:
    raw = json.dumps(values, ensure_ascii=False).encode("utf-8")
    return zstandard.ZstdCompressor(level=3).compress(raw)


def _unpack(packed: bytes) -> list[str]:
    return json.loads(zstandard.ZstdDecompressor().decompress(packed))


def _buckets(words: set[str], n_buckets: int) -> dict[int, list[str]]:
    """The words in order, by bucket: the same from every task that has the same words."""
    out: dict[int, list[str]] = {}
    for word in sorted(words):
        out.setdefault(zlib.crc32(word.encode()) % n_buckets, []).append(word)
    return out


def _check_of(words: list[str]) -> int:
    return zlib.crc32("\0".join(words).encode(), len(words))


def _distinct_words(path: str, n_buckets: int):
    def run(batches):
        words = codec(path).words
        for block, held in _blocks(batches):
            seen: set[str] = set()
            for batch in held:
                for text in batch.column("text"):
                    seen.update(words(text.as_py()))
            for bucket, found in _buckets(seen, n_buckets).items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([bucket], pa.int32()),
                        pa.array([block], pa.int64()),
                        pa.array([_pack(found)], pa.binary()),
                    ],
                    names=["bucket", "block", "words"],
                )

    return run


def _encode_buckets(path: str):
    """Rows sorted by bucket; each distinct word of a bucket is encoded once."""

    def run(batches):
        encode, bucket, table = codec(path).encode_words, None, {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != bucket:
                    bucket, table = row["bucket"], {}
                words = _unpack(row["words"])
                if new := [w for w in words if w not in table]:
                    table.update(zip(new, encode(new), strict=True))
                ids = [table[w] for w in words]
                sizes = np.array([len(i) // 4 for i in ids], dtype="<u4").tobytes()
                packed = zstandard.ZstdCompressor(level=3).compress(sizes + b"".join(ids))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block"]], pa.int64()),
                        pa.array([bucket], pa.int32()),
                        pa.array([_check_of(words)], pa.int64()),
                        pa.array([packed], pa.binary()),
                    ],
                    names=["block", "bucket", "check", "ids"],
                )

    return run


def _pack_texts(batches):
    for block, held in _blocks(batches):
        table = pa.Table.from_batches(held)
        sink = pa.BufferOutputStream()
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
            writer.write_table(table)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
            names=["block", "rows"],
        )


def _assemble(path: str, n_buckets: int, with_text: bool):
    """Every position of a block's texts looks up the ids of its word."""

    def rows_of(packed: pa.ChunkedArray) -> Iterator[pa.RecordBatch]:
        for rows in packed:
            yield from batches_of_bytes(pa.ipc.open_stream(rows.as_py()), "text", OUT_BYTES)

    def grouped(texts: pa.Table, found: pa.Table) -> pa.Table:
        own, seen = codec(path), set()
        for batch in rows_of(texts["rows"]):
            for text in batch.column("text"):
                seen.update(own.words(text.as_py()))
        sent = {b: (c, i) for b, c, i in zip(*(found[n].to_pylist() for n in ("bucket", "check", "ids")), strict=True)}
        table: dict[str, bytes] = {}
        for bucket, words in _buckets(seen, n_buckets).items():
            check, packed = sent.pop(bucket, (None, b""))
            if check != _check_of(words):
                # Only texts that were read in another order the second time come here.
                table.update(zip(words, own.encode_words(words), strict=True))
                continue
            raw = zstandard.ZstdDecompressor().decompress(packed)
            sizes = np.frombuffer(raw, "<u4", count=len(words)).astype(np.int64)
            ends = (4 * (np.cumsum(sizes) + len(words))).tolist()
            table.update((w, raw[a:b]) for w, a, b in zip(words, [4 * len(words), *ends], ends, strict=False))
        del seen
        ids = (pa.field("ids", pa.binary()), pa.field("decoded", pa.string()))
        schema = pa.schema([texts_schema(texts), *ids[: 1 + with_text]])
        out = []
        for batch in rows_of(texts["rows"]):
            encoded = [b"".join(map(table.__getitem__, own.words(t.as_py()))) for t in batch.column("text")]
            columns = [batch.column("doc_id"), pa.array(encoded, pa.binary())]
            if with_text:
                columns.append(pa.array(map(own.decode, encoded), pa.string()))
            out.append(pa.RecordBatch.from_arrays(columns, schema=schema))
        return pa.Table.from_batches(out, schema)

    def texts_schema(texts: pa.Table) -> pa.Field:
        for rows in texts["rows"]:
            return pa.ipc.open_stream(rows.as_py()).schema.field("doc_id")
        raise ValueError("words without texts: the documents changed between two reads")

    return grouped


def encode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """``doc_id`` and ``ids`` of every document, as the file at ``path`` encodes it.

    ``ids`` are little-endian unsigned 32-bit integers in one binary. Blocks of documents list
    their distinct words; these meet in buckets by word, where each distinct word is encoded
    once; and the ids go back to their block, where every position looks up its word. Words and
    ids travel as one compressed list per block and bucket. With ``decoded`` the ids are decoded
    in the same place, as by ``decode``. A null text is empty and has no ids, rows may repeat,
    other columns are left out, and an empty table gives an empty one.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_bytes // 50 // WORDS_PER_BUCKET)
    words = (
        rows.mapInArrow(_distinct_words(path, n_buckets), "bucket int, block long, words binary")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_encode_buckets(path), "block long, bucket int, check long, ids binary")
    )
    texts = rows.mapInArrow(_pack_texts, "block long, rows binary")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids binary" + ", decoded string" * decoded
    return (
        texts.groupBy("block")
        .cogroup(words.groupBy("block"))
        .applyInArrow(_assemble(path, n_buckets, decoded), schema)
    )


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Add ``decoded``: the pieces of ``ids`` side by side, special tokens included.

    The id-to-piece table has as many rows as the vocabulary, whatever the corpus; every task
    holds it and joins the ids of a document to it by position. Bytes that are no UTF-8 become
    the replacement character. Null ids give an empty text.
    """
    names = [f.name for f in encoded.schema if f.name != "decoded"]
    schema = ", ".join(f"`{n}` {encoded.schema[n].dataType.simpleString()}" for n in names)

    def run(batches):
        own = codec(path)
        for whole in batches:
            for batch in batches_of_bytes([whole], "ids", OUT_BYTES):
                texts = [own.decode(value.as_py() or b"") for value in batch.column("ids")]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(texts, pa.string())],
                    names=[*batch.schema.names, "decoded"],
                )

    return encoded.select(*[f"`{n}`" for n in names]).mapInArrow(run, f"{schema}, decoded string")


def encode_decode_digests(docs: DataFrame, path: str) -> DataFrame:
    """One row per document with the digests of its ids and of the text they decode to."""
    return encode(docs, path, decoded=True).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
