"""Ranked lexical search: a sharded inverted index, searched by Block-Max MaxScore.

A shard is a run of documents that one task read. For each of its terms it has one row: a list of
(document, occurrences) in blocks, with the bounds of the list and of each block. Bounds are the
most occurrences and the shortest document, which give an upper bound of the score under any
weights, so the index does not depend on the corpus statistics.

Searching, a shard's lists are ordered by their bounds. Lists whose bounds together stay below the
score of the worst hit so far cannot bring a document up by themselves; only the others, the
essential ones, name candidates. Every further list is read for the candidates that can still
reach that score, and of it only the blocks whose bound lets one of them reach it. Hits are kept
from shard to shard of a task, and the tasks' hits are merged at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from nearkin.llm.arrow import CHUNK_BYTES, LOWER, batches_of_bytes, flat, runs
from nearkin.llm.columns import text_or_empty
from nearkin.session import stored

#: Bytes of term characters: letters and digits of ASCII, and all that is not ASCII.
IN_TERM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
#: A shard ends at so many bytes of text or documents; a longer text is a shard by itself.
SHARD_BYTES = 16 << 20
SHARD_DOCS = 1 << 16
BLOCK = 128
#: Items that are searched together; their terms' lists and weights are in a task at one time.
GROUP_ITEMS = 1024
TOP = 10
# Fixed values of the score: see ``search``.
WEIGHT, GAIN, LENGTH = 1000, 1_000_000_000, 8


def _cuts(inside: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of about CHUNK_BYTES that end where no term does."""
    start, size = 0, len(inside)
    while start < size:
        stop = min(size, start + CHUNK_BYTES)
        while stop < size and inside[stop - 1] and inside[stop]:
            window = inside[stop : stop + CHUNK_BYTES]
            gap = int(np.argmin(window))
            stop = stop + (gap if not window[gap] else len(window))
        yield start, stop
        start = stop


def terms_of(texts: pa.Array) -> Iterator[tuple[np.ndarray, pa.DictionaryArray]]:
    """The terms of texts in parts: which text each is in, and the term, A-Z in lower case."""
    data, bounds = flat(texts)
    inside = IN_TERM[data]
    for a, b in _cuts(inside, bounds):
        own = LOWER[data[a:b]]
        here = np.clip(bounds - a, 0, b - a)
        starts, ends, first = runs(inside[a:b], here)
        owner = np.repeat(np.arange(len(texts)), np.diff(first))
        offsets = np.zeros(len(starts) + 1, dtype=np.int32)
        np.cumsum(ends - starts, out=offsets[1:])
        letters = own[inside[a:b]]
        array = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
        yield owner, array.dictionary_encode()


@dataclass
class _Shard:
    """Postings of the documents read so far."""

    ids: list[pa.Array] = field(default_factory=list)
    terms: list[pa.Array] = field(default_factory=list)
    postings: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    n_docs: int = 0
    n_terms: int = 0
    n_bytes: int = 0

    def add(self, ids: pa.Array, texts: pa.Array) -> None:
        for owner, terms in terms_of(texts):
            codes = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            pairs, counts = np.unique(codes * len(texts) + owner, return_counts=True)
            code, doc = np.divmod(pairs, len(texts))
            self.postings.append((code + self.n_terms, doc + self.n_docs, counts))
            self.terms.append(terms.dictionary)
            self.n_terms += len(terms.dictionary)
        # A copy: a slice would hold the whole batch, texts included.
        self.ids.append(ids.take(pa.array(np.arange(len(ids)))))
        self.n_docs += len(ids)
        self.n_bytes += texts.nbytes

    def rows(self, shard: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """The header, which has no term, and the lists."""
        lengths = np.zeros(self.n_docs, dtype=np.int64)
        for _, doc, count in self.postings:
            np.add.at(lengths, doc, count)
        ids = pa.concat_arrays(self.ids)
        header = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([shard], pa.int64()), pa.array([None], pa.binary()),
                *[pa.array([int(v)], pa.int64()) for v in ((lengths > 0).sum(), lengths.sum(), 0)],
                pa.array([b""], pa.binary()), pa.array([lengths.tobytes()], pa.binary()), header,
            ],
            schema=schema,
        )
        if not self.n_terms:
            return
        names = pa.chunked_array(self.terms).combine_chunks().dictionary_encode()
        code = names.indices.to_numpy(zero_copy_only=False)[np.concatenate([p[0] for p in self.postings])].astype(np.int64)
        doc, tf = (np.concatenate([p[i] for p in self.postings]) for i in (1, 2))
        # A text in several parts has its terms once.
        key = code * self.n_docs + doc
        order = np.argsort(key, kind="stable")
        key, tf = key[order], tf[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        tf = np.add.reduceat(tf, first)
        code, doc = np.divmod(key[first], self.n_docs)
        starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        df = np.diff(np.append(starts, len(code)))
        most, least = np.maximum.reduceat(tf, starts), np.minimum.reduceat(lengths[doc], starts)
        words = names.dictionary.take(pa.array(code[starts]))
        short = (df <= BLOCK) & (most < 1 << 16)
        yield from self._short(shard, schema, words, short, df, most, least, doc, tf)
        for at in np.flatnonzero(~short).tolist():
            a, b = int(starts[at]), int(starts[at] + df[at])
            blocks, payload = _packed(doc[a:b], tf[a:b], lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int64()), words.slice(at, 1),
                    *[pa.array([int(v[at])], pa.int64()) for v in (df, most, least)],
                    pa.array([blocks], pa.binary()), pa.array([payload], pa.binary()), pa.nulls(1, schema.field("ids").type),
                ],
                schema=schema,
            )

    @staticmethod
    def _short(shard, schema, words, short, df, most, least, doc, tf) -> Iterator[pa.RecordBatch]:
        """Lists of one block, all at once: 16 bits of document, 16 of occurrences."""
        if not short.any():
            return
        payload = ((doc << 16) | tf)[np.repeat(short, df)].astype("<u4")
        offsets = np.concatenate([[0], np.cumsum(4 * df[short])]).astype(np.int32)
        n = int(short.sum())
        lists = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(payload)])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, shard), pa.int64()), words.filter(pa.array(short)),
                *[pa.array(v[short], pa.int64()) for v in (df, most, least)],
                pa.array([b""] * n, pa.binary()), lists, pa.nulls(n, schema.field("ids").type),
            ],
            schema=schema,
        )


def _packed(doc: np.ndarray, tf: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """Blocks of a list: last document, most occurrences, shortest document, end; and their bytes."""
    pack = zstandard.ZstdCompressor(level=1).compress
    table, parts, size = [], [], 0
    for a in range(0, len(doc), BLOCK):
        d, t = doc[a : a + BLOCK], tf[a : a + BLOCK]
        parts.append(pack(np.concatenate([np.diff(d, prepend=0), t]).astype("<u4").tobytes()))
        size += len(parts[-1])
        table.append((d[-1], t.max(), lengths[d].min(), size))
    return np.array(table, dtype="<i8").tobytes(), b"".join(parts)


def index_schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema(
        [("shard", pa.int64()), ("term", pa.binary()), ("df", pa.int64()), ("most", pa.int64()),
         ("least", pa.int64()), ("blocks", pa.binary()), ("payload", pa.binary()), ("ids", pa.list_(id_type))]
    )


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of ``docs``: ``shard, term, df, most, least, blocks, payload, ids``.

    ``term`` is UTF-8; a shard's row without a term has its documents' ids and lengths, and in
    ``df`` and ``most`` how many documents have a term and how many terms all have. Store it
    before it is searched. Null texts have no terms, rows that repeat an id are documents of
    their own, long texts are read in parts, an empty table gives an empty index.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, shard, schema = TaskContext.get().partitionId(), 0, _Shard(), None
        for batch in batches_of_bytes(batches, "text"):
            ids = batch.column("doc_id")
            schema = schema or index_schema(ids.type)
            full = shard.n_docs + len(ids) > SHARD_DOCS or shard.n_bytes + batch.column("text").nbytes > SHARD_BYTES
            if shard.n_docs and full:
                yield from shard.rows((task << 32) | n, schema)
                shard, n = _Shard(), n + 1
            shard.add(ids, batch.column("text"))
        if shard.n_docs:
            yield from shard.rows((task << 32) | n, schema)

    return rows.mapInArrow(
        run,
        f"shard long, term binary, df long, most long, least long, blocks binary, payload binary, ids array<{kind}>",
    )


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, term`` of all items, each term once; rows that repeat an id are one item."""
    rows = items.select(F.col(f"`{id_col}`").alias("item_id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of_bytes(batches, "text"):
            for owner, terms in terms_of(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item_id").take(pa.array(owner)), terms.dictionary_decode()], names=["item_id", "term"]
                )

    return rows.mapInArrow(run, f"item_id {kind}, term binary").distinct()


def _lengths(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Each document's length as a share of the mean, as the score has it, times LENGTH."""
    if len(lengths) and 90 * int(lengths.max()) * n_docs >= 1 << 63:
        lengths = lengths.astype(object)
    return (LENGTH * (10 + (90 * lengths * n_docs) // n_terms)).astype(np.int64)


class _List:
    """One term's postings in a shard, read block by block."""

    def __init__(self, row: dict, weight: int, norm, norms: np.ndarray):
        self.weight, self.norms, self.payload = weight, norms, row["payload"]
        self.blocks = np.frombuffer(row["blocks"], "<i8").reshape(-1, 4)
        most, least = np.array([row["most"]]), np.array([row["least"]])
        self.bound = int(self._gain(most, norm(least))[0])
        if len(self.blocks):
            self.bounds = self._gain(self.blocks[:, 1], norm(self.blocks[:, 2]))
            self.last = self.blocks[:, 0]
        self._read: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._whole: tuple[np.ndarray, np.ndarray] | None = None

    def _gain(self, tf: np.ndarray, norms: np.ndarray) -> np.ndarray:
        return self.weight * ((GAIN * tf) // (1000 * tf + norms))

    def block(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a block and what they gain from it."""
        if at not in self._read:
            a = int(self.blocks[at - 1, 3]) if at else 0
            raw = zstandard.ZstdDecompressor().decompress(self.payload[a : int(self.blocks[at, 3])])
            both = np.frombuffer(raw, "<u4").astype(np.int64)
            docs, tf = np.cumsum(both[: len(both) // 2]), both[len(both) // 2 :]
            self._read[at] = docs, self._gain(tf, self.norms[docs])
        return self._read[at]

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        if self._whole is None:
            if len(self.blocks):
                parts = [self.block(i) for i in range(len(self.blocks))]
                self._whole = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            else:
                both = np.frombuffer(self.payload, "<u4").astype(np.int64)
                docs = both >> 16
                self._whole = docs, self._gain(both & 0xFFFF, self.norms[docs])
        return self._whole

    def gains(self, docs: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What sorted ``docs`` gain, and which of them no block lets gain their ``need``.

        Blocks that none of their documents needs stay packed.
        """
        if not len(self.blocks) or self._whole is not None:
            own, gain = self.whole()
            at = np.minimum(np.searchsorted(own, docs), len(own) - 1)
            out = np.where(own[at] == docs, gain[at], 0)
            return out, out < need
        at = np.searchsorted(self.last, docs)
        most = np.append(self.bounds, 0)[at]
        out, lost = np.zeros(len(docs), dtype=np.int64), most < need
        asked = np.flatnonzero(~lost & (at < len(self.last)))
        for block in np.unique(at[asked]).tolist():
            mine = asked[at[asked] == block]
            own, gain = self.block(block)
            where = np.minimum(np.searchsorted(own, docs[mine]), len(own) - 1)
            out[mine] = np.where(own[where] == docs[mine], gain[where], 0)
        return out, lost | (out < need)


def _rank_key(hit: tuple[int, object]) -> tuple:
    score, doc = hit
    return (-score, doc is None, doc if doc is not None else 0)


def best_of_shard(
    ids: pa.Array, lists: list[_List], hits: list[tuple[int, object]], top: int, scores: np.ndarray
) -> list[tuple[int, object]]:
    """``hits`` and the shard's documents for the terms of ``lists``: the ``top`` best of both.

    ``scores`` is room for a number per document, all 0 before and after.
    """
    worst = max(1, hits[-1][0] if len(hits) == top else 1)
    own = sorted(lists, key=lambda x: x.bound)
    together = np.cumsum([x.bound for x in own])
    essential = int(np.searchsorted(together, worst, side="left"))
    if essential == len(own):
        return hits
    parts = [x.whole() for x in own[essential:]]
    for docs, gain in parts:
        scores[docs] += gain
    found = np.unique(np.concatenate([p[0] for p in parts]))
    reached = scores[found]
    scores[found] = 0
    for i in range(essential - 1, -1, -1):
        rest = int(together[i - 1]) if i else 0
        able = reached + rest + own[i].bound >= worst
        found, reached = found[able], reached[able]
        if not len(found):
            return hits
        gain, lost = own[i].gains(found, worst - rest - reached)
        found, reached = found[~lost], (reached + gain)[~lost]
    able = reached >= worst
    found, reached = found[able], reached[able]
    if len(found) > top:
        limit = np.partition(reached, len(reached) - top)[len(reached) - top]
        found, reached = found[reached >= limit], reached[reached >= limit]
    new = list(zip(reached.tolist(), ids.take(pa.array(found)).to_pylist(), strict=True))
    return sorted(hits + new, key=_rank_key)[:top]


def _searching(n_docs: int, n_terms: int, top: int, out: pa.Schema):
    def norm(lengths: np.ndarray) -> np.ndarray:
        return _lengths(lengths, n_docs, n_terms)

    def shards(batches):
        """The rows of one group and shard after the other, the header first."""
        key, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["group"], row["shard"]) != key and held:
                    yield key[0], held
                    held = []
                key = (row["group"], row["shard"])
                held.append(row)
        if held:
            yield key[0], held

    def flush(hits: dict) -> pa.RecordBatch:
        rows = [(item, score, doc) for item, found in hits.items() for score, doc in found]
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, hits = None, {}
        for number, (header, *rows) in shards(batches):
            if number != group:
                if any(hits.values()):
                    yield flush(hits)
                group, hits = number, {}
            ids = pa.array(header["ids"], out.field("doc_id").type)
            norms = norm(np.frombuffer(header["payload"], "<i8"))
            scores, asked = np.zeros(len(ids), dtype=np.int64), {}
            for row in rows:
                own = _List(row, row["weight"], norm, norms)
                for item in row["items"]:
                    asked.setdefault(item, []).append(own)
            for item, lists in asked.items():
                hits[item] = best_of_shard(ids, lists, hits.get(item, []), top, scores)
        if any(hits.values()):
            yield flush(hits)

    return run


def search(
    index: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """``item_id, rank, doc_id, score``: every item's ``top`` documents, equal scores by id, null ids last.

    ``index`` is the stored result of ``build``. With N documents that have terms, L terms in all,
    n terms in a document, a term in df documents and tf times in this one, all integers:
    weight = floor(1000 ln((2N+2) / (2df+1))), m = 10 + 90 n N div L, and the score is the sum of
    weight * (10^9 tf div (1000 tf + 8 m)) over the item's different terms. Documents that score 0
    are not listed. Items without terms have no rows, items of equal id are one, null ids are one.
    Only lists of asked terms leave the index; per task and item at most ``top`` hits come back.
    """
    spark = index.sparkSession
    header = index.filter("term IS NULL")
    n_docs, n_terms = header.agg(F.sum("df"), F.sum("most")).first()
    wanted = stored(item_terms(items, id_col, text_col), "search-terms")
    item_kind, doc_kind = wanted.schema["item_id"].dataType, index.schema["ids"].dataType.elementType
    n_groups = -(-wanted.select("item_id").distinct().count() // GROUP_ITEMS) or 1
    schema = f"item_id {item_kind.simpleString()}, score long, doc_id {doc_kind.simpleString()}"
    if not n_terms:
        return spark.createDataFrame([], schema).select("item_id", F.lit(1).alias("rank"), "doc_id", "score")
    lists = index.filter("term IS NOT NULL")
    counted = (
        lists.select("term", "df").join(wanted.select("term").distinct(), "term")
        .groupBy("term").agg(F.sum("df").alias("df"))
    )
    weight = F.floor(WEIGHT * F.log((2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long")
    group = F.pmod(F.xxhash64("item_id"), F.lit(n_groups))
    asked = stored(
        wanted.join(counted.withColumn("weight", weight).filter("weight > 0"), "term")
        .groupBy(group.alias("group"), "term", "weight").agg(F.collect_list(F.struct("item_id")).alias("items")),
        "search-asked",
    )
    chosen = lists.join(asked, "term").select(
        "group", "shard", "term", "weight", F.col("items.item_id").alias("items"), "most", "least", "blocks", "payload",
        F.lit(None).cast(index.schema["ids"].dataType).alias("ids"),
    )
    heads = header.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_groups - 1).cast("long"))).alias("group"), "shard", "term",
        F.lit(None).cast("long").alias("weight"), F.lit(None).cast(chosen.schema["items"].dataType).alias("items"),
        "most", "least", "blocks", "payload", "ids",
    )
    out = pa.schema([("item_id", to_arrow_type(item_kind)), ("score", pa.int64()), ("doc_id", to_arrow_type(doc_kind))])
    hits = (
        heads.unionByName(chosen).repartition("group", "shard")
        .sortWithinPartitions("group", "shard", F.col("term").asc_nulls_first())
        .mapInArrow(_searching(n_docs, n_terms, top, out), schema)
    )
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")
