"""Ranked search: against scoring every document in Python."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nearkin.llm import search
from nearkin.session import stored

from . import definitions


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def listed(found):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=lambda r: r[:2])


def searched(docs, items, **options):
    return listed(search.search(stored(search.build(docs), "index"), items, **options))


def words(rng, n, vocabulary=60):
    return " ".join(f"w{int(rng.random() ** 3 * vocabulary)}" for _ in range(n))


@pytest.mark.parametrize("shard_docs, block, groups", [(1 << 16, 128, 1024), (40, 4, 2), (7, 3, 1)])
def test_matches_scoring_every_document(spark, docs_of, monkeypatch, shard_docs, block, groups):
    rng = random.Random(shard_docs)
    texts = [words(rng, rng.choice([1, 5, 30, 200])) for _ in range(300)] + ["w1 w2"] * 20
    rows = list(enumerate(texts))
    items = [(i, words(rng, 12)) for i in range(8)] + [(20, "w1"), (21, "w59 w58"), (22, "absent"), (20, "w3 w1")]
    monkeypatch.setattr(search, "GROUP_ITEMS", groups)
    shards = []
    for a in range(0, len(rows), shard_docs):
        shard = search._Shard()
        part = rows[a : a + shard_docs]
        shard.add(pa.array([i for i, _ in part], pa.int64()), pa.array([t for _, t in part]))
        shards.append(shard)
    monkeypatch.setattr(search, "BLOCK", block)
    schema = search.index_schema(pa.int64())
    batches = [b for n, shard in enumerate(shards) for b in shard.rows(n, schema)]
    table = pa.Table.from_batches(batches, schema).to_pylist()
    index = spark.createDataFrame(
        [tuple(r.values()) for r in table],
        "shard long, term binary, df long, most long, least long, blocks binary, payload binary, ids array<long>",
    )
    assert listed(search.search(stored(index, "index"), items_of(spark, items))) == definitions.ranked(rows, items)


def test_bounds_hold_and_blocks_stay_packed(monkeypatch):
    """Fewer blocks are read than there are, and no list or block gains more than its bound."""
    rng = random.Random(3)
    monkeypatch.setattr(search, "BLOCK", 8)
    rows = [(i, words(rng, rng.choice([3, 40]), 30)) for i in range(2000)] + [(5000 + i, "rare w1 w2 w0") for i in range(12)]
    shard = search._Shard()
    shard.add(pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows]))
    schema = search.index_schema(pa.int64())
    header, *lists = [r for b in shard.rows(0, schema) for r in b.to_pylist()]
    n_docs, n_terms = header["df"], header["most"]

    def norm(lengths):
        return search._lengths(lengths, n_docs, n_terms)

    norms = norm(np.frombuffer(header["payload"], "<i8"))
    asked = {"rare", "w0", "w1", "w2"}
    own = [search._List(r, 1 if r["term"] != b"rare" else 50, norm, norms) for r in lists if r["term"].decode() in asked]
    hits = search.best_of_shard(pa.array(header["ids"]), own, [], 10, np.zeros(len(rows), np.int64))
    full = [search._List(r, x.weight, norm, norms) for r, x in zip([r for r in lists if r["term"].decode() in asked], own, strict=True)]
    for x in full:
        docs, gain = x.whole()
        assert gain.max() <= x.bound
        for i in range(len(x.blocks)):
            assert x.block(i)[1].max() <= x.bounds[i]
    fresh = [search._List(r, x.weight, norm, norms) for r, x in zip([r for r in lists if r["term"].decode() in asked], own, strict=True)]
    # The same shard under other ids: every hit is there twice.
    shifted = [i + 10_000 for i in header["ids"]]
    again = search.best_of_shard(pa.array(shifted), fresh, hits, 10, np.zeros(len(rows), np.int64))
    assert again == sorted(hits + [(score, i + 10_000) for score, i in hits], key=search._rank_key)[:10]
    n_blocks, n_read = sum(len(x.blocks) for x in fresh), sum(len(x._read) for x in fresh)
    assert n_read < n_blocks / 4


def test_nulls_ties_alphabets_and_long_texts(spark, awkward, awkward_rows, docs_of, monkeypatch):
    items = [(1, "Straße 日本語 мир МИР"), (2, None), (3, ""), (4, "one two"), (5, awkward_rows[0][1]), (None, "quoted ‘quoted’ password")]
    got = {tuple(r) for r in search.search(stored(search.build(awkward), "index"), items_of(spark, items)).collect()}
    assert got == set(definitions.ranked_any(awkward_rows, items))
    monkeypatch.setattr(search, "CHUNK_BYTES", 50)
    whole = [(t, [w for owner, terms in search.terms_of(pa.array([t or "", "x y"])) for o, w in zip(owner, terms.to_pylist(), strict=True) if o == 0]) for _, t in awkward_rows]
    assert all([w.decode() for w in found] == definitions.terms(t) for t, found in whole)


def test_rows_that_repeat_or_lack_an_id(spark, docs_of):
    docs = docs_of(["a b", "a b", "a", "b", "a c"], [3, 3, None, None, 1])
    items = [(1, "a"), (2, "c b")]
    rows = list(zip([3, 3, None, None, 1], ["a b", "a b", "a", "b", "a c"], strict=True))
    assert {tuple(r) for r in search.search(stored(search.build(docs), "index"), items_of(spark, items)).collect()} == set(definitions.ranked_any(rows, items))


def test_empty_tables(spark, empty, docs_of):
    none = items_of(spark, [])
    assert search.search(stored(search.build(empty), "index"), items_of(spark, [(1, "a")])).count() == 0
    assert search.search(stored(search.build(docs_of(["", None, "?"])), "index"), items_of(spark, [(1, "a")])).count() == 0
    assert search.search(stored(search.build(docs_of(["a b"])), "index"), none).count() == 0


def test_extra_columns_and_string_ids(spark, docs_of):
    docs = docs_of(["a b", "b c"]).select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "text", F.lit(1).alias("term"), F.lit(2).alias("shard"))
    items = items_of(spark, [(7, "b")]).select(F.lit("x").alias("item_id"), "text", F.lit(3).alias("weight"))
    found = search.search(stored(search.build(docs), "index"), items, top=1).collect()
    assert [(r.item_id, r["rank"], r.doc_id) for r in found] == [("x", 1, "d0")]
