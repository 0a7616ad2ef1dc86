"""Documents that share most of their word n-grams: a prefix-filtered join and its components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.llm.arrow import LOWER, OUT_BYTES, SPACES, batches_of_bytes, flat, grams, hashes, mix, rows_per_batch, runs
from nearkin.llm.columns import text_or_empty
from nearkin.session import stored

SHINGLE_WORDS = 5
#: Similarity as a share in percent: 100 * intersection >= 80 * union.
PERCENT = 80
#: The most frequent n-grams, which go last in the order of rarity; bounds what is broadcast.
FREQUENT = 500_000
#: Values that the average frequency of a document's shingles is cut to.
SCORES = 1 << 22
#: Postings of one n-gram that one task takes at most on average; a longer list is salted.
LIST_ROWS = 5_000
#: Equal ranges of the hash for which the suffix filter compares how many shingles two sets have.
RANGES = 256
#: N-grams of a document among which a task counts repeats before it hands them on.
COUNT_BATCH = 4_000_000
#: Bits of the table that leaves out documents without a candidate; its size is fixed.
FILTER_BITS = 1 << 23
#: Pairs that a task has in memory at a time with both sets.
SETS_PER_BATCH = 500


def shingle_sets(texts: pa.Array, k: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Of each text, the sorted distinct hashes of its k-word shingles; of fewer words, of all."""
    data, bounds = flat(texts)
    data = LOWER[data]
    starts, ends, first = runs(~SPACES[data], bounds)
    words = hashes(data, starts, ends)
    every = grams(words, k)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            found = np.sort(every[a : b - k + 1])
            keep = np.ones(len(found), dtype=bool)
            np.not_equal(found[1:], found[:-1], out=keep[1:])
            out.append(found[keep])
        elif b > a:
            out.append(mix(grams(words[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def prefix_length(size: int, percent: int = PERCENT) -> int:
    """How many of the rarest shingles two similar sets cannot both do without."""
    return size - -(-percent * size // 100) + 1


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))


def frequent_shingles(rows: DataFrame, most: int = FREQUENT) -> np.ndarray:
    """The most frequent shingles and how often they occur, rarest first, as rows of two columns.

    Every task counts all its shingles and hands on those that it met twice or more, so a
    shingle in more documents than there are tasks is found for certain, and a count is short by
    at most one a task. Counts of all tasks are added up.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches_of_bytes(batches, "text"):
            sets = shingle_sets(batch.column("text"))
            held += sets
            size += sum(map(len, sets))
            if size >= COUNT_BATCH:
                yield from repeated(held)
                held, size = [], 0
        if held:
            yield from repeated(held)

    def repeated(sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        values, counts = np.unique(np.concatenate(sets), return_counts=True)
        values, counts = values[counts > 1].view(np.int64), counts[counts > 1]
        for at in range(0, len(values), 500_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[at : at + 500_000]), pa.array(counts[at : at + 500_000])],
                names=["shingle", "n"],
            )

    counted = rows.mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "shingle").limit(most).toArrow()
    table = np.stack([top["shingle"].to_numpy(), top["n"].to_numpy()], axis=1)
    return table[np.argsort(table[:, 0])]


def _prefixes(frequent, percent: int):
    """Each document's size, digest, and prefix in the order rare first, hashes breaking ties."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = frequent.value
        known, often_of = table[:, 0].copy(), table[:, 1]
        bits = np.zeros(1 << 24, dtype=bool)
        bits[(known.view(np.uint64) >> np.uint64(40)).astype(np.int64)] = True
        for batch in batches_of_bytes(batches, "text"):
            sizes, digests, prefixes, counts, scores = [], [], [], [], []
            for found in shingle_sets(batch.column("text")):
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                values = found.view(np.int64)
                often = np.zeros(len(found), dtype=np.int64)
                maybe = np.flatnonzero(bits[(found >> np.uint64(40)).astype(np.int64)])
                if len(maybe):
                    at = np.minimum(np.searchsorted(known, values[maybe]), len(known) - 1)
                    hit = known[at] == values[maybe]
                    often[maybe[hit]] = often_of[at[hit]]
                scores.append(int(often.sum()) // max(1, len(found)))
                # The sets are sorted by hash, and the sort by count keeps that order.
                first = np.argsort(often, kind="stable")[: prefix_length(len(found), percent) if len(found) else 0]
                prefixes.append(values[first].tobytes())
                by_range = np.bincount((found >> np.uint64(56)).astype(np.int64), minlength=RANGES)
                counts.append(np.minimum(by_range, 65535).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(prefixes, pa.binary()),
                    pa.array(counts, pa.binary()),
                    pa.array(scores, pa.int64()),
                ],
                names=["doc_id", "size", "digest", "prefix", "counts", "score"],
            )

    return run


def _postings(frequent, percent: int):
    """One row per shingle of a prefix: shingle, salt, order, document, size and place in the prefix.

    The lists of frequent shingles are parted by a salt; the others have the salt -1. A list is
    ordered by class of size, within which two sizes may be similar, then by how common the
    document's shingles are on average: the text that others were made from comes first.
    """
    width = np.log(max(1.01, 100 / percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = frequent.value
        hot = table[table[:, 1] > LIST_ROWS]
        for batch in batches_of_bytes(batches, "prefix", OUT_BYTES):
            prefixes = [np.frombuffer(p, np.int64) for p in batch.column("prefix").to_pylist()]
            lengths = np.array([len(p) for p in prefixes], dtype=np.int64)
            if not lengths.sum():
                continue
            shingle = np.concatenate(prefixes)
            doc = np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), lengths)
            size = np.repeat(batch.column("size").to_numpy(zero_copy_only=False), lengths)
            place = np.arange(len(shingle)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            score = np.minimum(batch.column("score").to_numpy(zero_copy_only=False), SCORES - 1)
            sizes = np.maximum(batch.column("size").to_numpy(zero_copy_only=False), 1)
            order = np.floor(np.log(sizes) / width).astype(np.int64) * SCORES + (SCORES - 1 - score)
            salt = np.full(len(shingle), -1, dtype=np.int64)
            if len(hot):
                at = np.minimum(np.searchsorted(hot[:, 0], shingle), len(hot) - 1)
                hit = np.flatnonzero(hot[at, 0] == shingle)
                parts = hot[at[hit], 1] // LIST_ROWS + 1
                salt[hit] = (mix(doc[hit].astype(np.uint64)) % parts.astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shingle), pa.array(salt.astype(np.int32)),
                    pa.array(np.repeat(order, lengths).astype(np.int32)), pa.array(doc),
                    pa.array((size << 24) | np.minimum(place, (1 << 24) - 1)),
                ],
                names=["shingle", "salt", "place_in_list", "doc_id", "size_place"],
            )

    return run


def _lists_of_two(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of shingle, salt, list and document: those not alone, each with its hub.

    A hub is the first document of its class of size in a list; its own hub is that of the class
    below, so that a group that reaches over two classes hangs together. Lists run on from batch
    to batch; only the last row and its hub are carried. A part of a salted list, told by a
    salt from 0 on, stays even if alone, as other parts have rows.
    """
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = ["shingle", "salt", "doc_id", "size_place", "hub"]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
        )

    hub, hub_class = 0, -1
    held: tuple | None = None
    held_alone = False
    for batch in batches:
        shingle, salt, order, doc, packed = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        if not len(shingle):
            continue
        size_class = order // SCORES
        same = np.zeros(len(shingle) + 1, dtype=bool)
        same[1:-1] = (shingle[1:] == shingle[:-1]) & (salt[1:] == salt[:-1])
        same[0] = held is not None and held[0] == shingle[0] and held[1] == salt[0]
        out = [held] if held is not None and (same[0] or not held_alone) else []
        last = len(shingle) - 1
        # Rows with a neighbour in their list; the last one waits for the next batch.
        paired = same[:-1] | same[1:] | (salt >= 0)
        paired[last] = True
        for i in np.flatnonzero(paired).tolist():
            of_row, own_class = int(doc[i]), int(size_class[i])
            if not same[i]:
                row_hub, hub, hub_class = of_row, of_row, own_class
            elif own_class != hub_class:
                row_hub = hub if own_class == hub_class + 1 else of_row
                hub, hub_class = of_row, own_class
            else:
                row_hub = hub
            row = (int(shingle[i]), int(salt[i]), of_row, int(packed[i]), row_hub)
            if i == last:
                held, held_alone = row, not (same[i] or salt[i] >= 0)
            else:
                out.append(row)
        if out:
            yield made(out)
    if held is not None and not held_alone:
        yield made([held])


def components(spark: SparkSession, edges: DataFrame, name: str = "components") -> DataFrame:
    """``doc_id, component_id`` of every end of ``edges`` (``a``, ``b``): the smallest id in reach.

    Every round hangs each vertex and its larger neighbours on the smallest neighbour, then its
    smaller ones; the number of rounds grows with the logarithm of the longest path. Rounds are
    written to the shared folder. Edges repeat at most once per end and shrink towards stars, so
    a vertex of many neighbours is folded by a minimum that is taken task by task first.
    """
    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31)))).first())

    current = edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
    current = stored(current.filter("v != u").distinct(), name)
    before, now = None, state(current)
    while now != before:
        both = current.union(current.select(F.col("u").alias("v"), F.col("v").alias("u")))
        smallest = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.filter("u > v").join(smallest, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = stored(large.filter("v != u").distinct(), name)
        lower = large.groupBy("v").agg(F.min("u").alias("m"))
        ends = F.array(F.col("v"), F.col("u"))
        small = large.join(lower, "v").select(F.explode(ends).alias("v"), F.col("m").alias("u"))
        current = stored(small.filter("v != u").distinct(), name)
        before, now = now, state(current)
    stars = current.select(F.col("v").alias("doc_id"), F.col("u").alias("component_id"))
    roots = current.select(F.col("u").alias("doc_id"), F.col("u").alias("component_id")).distinct()
    return stored(stars.union(roots), name)


def shared_at_most(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The most that pairs of sets can share, from their counts by range of the hash, row by row.

    As a suffix filter: parted at the same places of one order, two sets share in each part no
    more than the smaller one has there.
    """
    return np.minimum(one, two).sum(axis=1, dtype=np.int64)


def _plausible(percent: int):
    """Pairs that the suffix filter leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, RANGES)
                for c in ("counts_a", "counts_b")
            )
            both = batch.column("size_a").to_numpy() + batch.column("size_b").to_numpy()
            full = (one == 65535).any(axis=1) | (two == 65535).any(axis=1)
            keep = full | ((100 + percent) * shared_at_most(one, two) >= percent * both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _verify(percent: int):
    """Pairs with both sets beside them: those that are similar enough, with their overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            columns = [batch.column(c).to_pylist() for c in ("a", "b", "set_a", "set_b")]
            for a, b, raw_a, raw_b in zip(*columns, strict=True):
                one, two = np.frombuffer(raw_a, np.uint64), np.frombuffer(raw_b, np.uint64)
                both = len(one) + len(two)
                # 100 * x >= percent * (both - x)
                least = -(-percent * both // (100 + percent))
                shared = len(np.intersect1d(one, two, assume_unique=True))
                if shared >= least:
                    kept.append((a, b, shared, both - shared))
            values = list(zip(*kept, strict=True)) if kept else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.int64()) for v in values], names=["a", "b", "n_shared", "n_union"]
            )

    return run


def _sets_among(wanted):
    """Sets of the documents that the bit table may name; others are skipped, not shingled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(wanted.value, np.uint8)
        for whole in batches:
            ids = whole.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            at = (mix(ids.astype(np.uint64)) % np.uint64(FILTER_BITS)).astype(np.int64)
            chosen = whole.filter(pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))
            for batch in batches_of_bytes([chosen], "text"):
                sets = [s.tobytes() for s in shingle_sets(batch.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sets, pa.binary())], names=["doc_id", "set"]
                )

    return run


def _bits_of(ids: DataFrame) -> bytes:
    """A bit table of fixed size in which every id of ``ids`` is set; others may be, too."""

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(FILTER_BITS, dtype=bool)
        for batch in batches:
            at = mix(batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)) % np.uint64(FILTER_BITS)
            own[at.astype(np.int64)] = True
        words = np.packbits(own, bitorder="little").view("<i8")
        place = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(words[place])], names=["place", "word"])

    words = (
        ids.select("doc_id").mapInArrow(set_bits, "place long, word long")
        .groupBy("place").agg(F.bit_or("word").alias("word")).toArrow()
    )
    table = np.zeros(FILTER_BITS // 64, dtype="<i8")
    table[words["place"].to_numpy()] = words["word"].to_numpy()
    return table.tobytes()


def _filtered(pairs: DataFrame, keyed: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and counts let them be similar; what is joined to them is small."""
    sides = [
        keyed.select(F.col("doc_id").alias(x), F.col("size").alias(f"size_{x}"), F.col("counts").alias(f"counts_{x}"))
        for x in ("a", "b")
    ]
    beside = pairs.join(sides[0], "a").join(sides[1], "b")
    shorter, longer = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    return beside.filter(100 * shorter >= percent * longer).mapInArrow(_plausible(percent), "a long, b long").distinct()


def _verified(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Stored pairs that are similar, each looked at once; sets are made again for their ends only."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    wanted = rows.sparkSession.sparkContext.broadcast(_bits_of(ends))
    sets = rows.filter("doc_id is not null").mapInArrow(_sets_among(wanted), "doc_id long, set binary")
    one = sets.select(F.col("doc_id").alias("a"), F.col("set").alias("set_a"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("set").alias("set_b"))
    beside = pairs.join(one, "a").join(two, "b").select("a", "b", "set_a", "set_b")
    similar = beside.mapInArrow(_verify(percent), "a long, b long, n_shared long, n_union long")
    with rows_per_batch(rows.sparkSession, SETS_PER_BATCH):
        return stored(similar.distinct(), "jaccard-links")


def _pair(one: str, two: str) -> list:
    return [F.least(one, two).alias("a"), F.greatest(one, two).alias("b")]


def _first_pairs(lists: DataFrame) -> DataFrame:
    """Each document with the hub it shares most lists with, and hubs of one salted shingle."""
    shared = lists.filter("doc_id != hub").groupBy("doc_id", "hub").agg(F.count("*").alias("n"))
    best = shared.groupBy("doc_id").agg(F.max_by("hub", F.struct("n", -F.col("hub"))).alias("hub"))
    hubs = lists.filter("salt >= 0").select("shingle", "hub").distinct()
    across = hubs.join(hubs.groupBy("shingle").agg(F.min("hub").alias("least")), "shingle")
    across = across.filter("hub != least").select(*_pair("hub", "least"))
    return best.select(*_pair("doc_id", "hub")).union(across).distinct()


def _other_pairs(lists: DataFrame, found: DataFrame, done: DataFrame, percent: int) -> DataFrame:
    """Pairs of a list that no component holds yet, by length and position still able to be similar.

    Of each list that has several components, the documents outside its main one meet all
    others of another component. The bound by position counts from a shingle on, and holds at
    the first one that a pair shares.
    """
    placed = lists.join(found, "doc_id", "left").select(
        "shingle", "doc_id",
        F.shiftright("size_place", 24).alias("size"),
        F.col("size_place").bitwiseAND(F.lit((1 << 24) - 1)).alias("place"),
        F.coalesce("component_id", "doc_id").alias("component"),
    )
    counts = placed.groupBy("shingle", "component").agg(F.count("*").alias("n"))
    main = (
        counts.groupBy("shingle")
        .agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("parts"))
        .filter("parts > 1")
        .select("shingle", "main")
    )
    open_lists = placed.join(main, "shingle")
    left = open_lists.filter("component != main").select(
        "shingle", *[F.col(c).alias(f"{c}_l") for c in ("doc_id", "size", "place", "component")]
    )
    right = open_lists.drop("main")
    shorter, longer = F.least("size_l", "size"), F.greatest("size_l", "size")
    rest = F.least(F.col("size_l") - F.col("place_l"), F.col("size") - F.col("place"))
    pairs = left.join(right, "shingle").filter(
        (F.col("component_l") != F.col("component"))
        & (100 * shorter >= percent * longer)
        & ((100 + percent) * rest >= percent * (F.col("size_l") + F.col("size")))
    )
    return pairs.select(*_pair("doc_id_l", "doc_id")).distinct().join(done, ["a", "b"], "left_anti")


def similar_groups(
    docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Components of documents linked by 5-word shingles, and the verified links that made them.

    The first result has one row per row of ``docs``: ``doc_id, n_shingles, component_id``, the
    smallest id in reach. The second has ``a, b, n_shared, n_union`` between representatives.

    Equal sets are one vertex, named by its smallest id. A set's prefix holds its rarest
    shingles, as many as two similar sets cannot both miss; documents that share one are a list.
    First every document is verified against one hub of its lists. Then pairs of a list that no
    component holds yet pass filters by length, position and suffix and are verified, each
    once. Links inside a component add nothing to the result and are not listed. A null text
    is empty; an empty set links with nothing; rows of equal id share their links; rows without an
    id link with nothing and have no component; an empty table gives empty results.
    """
    spark = docs.sparkSession
    rows = _rows(docs, id_col, text_col)
    frequent = spark.sparkContext.broadcast(frequent_shingles(rows))
    keyed = stored(
        rows.mapInArrow(_prefixes(frequent, percent), "doc_id long, size long, digest binary, prefix binary, counts binary, score long"),
        "jaccard-prefixes",
    )
    linked = keyed.filter("size > 0 and doc_id is not null")
    sets_of = linked.groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"),
        *[F.first(c).alias(c) for c in ("size", "prefix", "score")],
    )
    lists = stored(
        sets_of.select("doc_id", "size", "prefix", "score")
        .mapInArrow(
            _postings(frequent, percent), "shingle long, salt int, place_in_list int, doc_id long, size_place long"
        )
        .repartition("shingle", "salt")
        .sortWithinPartitions("shingle", "salt", "place_in_list", "doc_id")
        .mapInArrow(_lists_of_two, "shingle long, salt int, doc_id long, size_place long, hub long"),
        "jaccard-lists",
    )
    first = stored(_first_pairs(lists), "jaccard-first-pairs")
    links = _verified(stored(_filtered(first, keyed, percent), "jaccard-pairs"), rows, percent)
    found = components(spark, links)
    second = stored(_filtered(_other_pairs(lists, found, first, percent), keyed, percent), "jaccard-pairs")
    more = _verified(second, rows, percent)
    all_links = links.union(more)
    if more.limit(1).count():
        stars = found.select(F.col("doc_id").alias("a"), F.col("component_id").alias("b"))
        found = components(spark, stars.union(more.select("a", "b")))
    names = linked.groupBy("digest").agg(F.min("doc_id").alias("representative"))
    members = (
        keyed.select("doc_id", "size", F.when(F.expr("size > 0 and doc_id is not null"), F.col("digest")).alias("digest"))
        .join(names, "digest", "left")
        .join(found.select(F.col("doc_id").alias("representative"), "component_id"), "representative", "left")
        .select(
            "doc_id",
            F.col("size").alias("n_shingles"),
            F.coalesce("component_id", "representative", "doc_id").alias("component_id"),
        )
    )
    return members, all_links
