import random

import pytest
from definitions import buckets, candidate_pairs, estimate, shingle_set, signature
from pyspark.sql import functions as F
from test_lsh import clustered, sigs_frame

from nearkin.operators import documents, lookup
from nearkin.operators.copies import copy_groups, with_copy_key
from nearkin.operators.lsh import build_lsh_index
from nearkin.params import LshParams
from nearkin.plans import similar
from nearkin.sources import index_tables
from nearkin.sources.metadata import enrich

SMALL = LshParams(num_hashes=10, bands=2, rows=5)


def stepped():
    """Signatures that leave the first one's values one after the other, from the end."""
    return {f"s{n}": [7] * (10 - n) + [100 + n] * n for n in (0, 0, 2, 4, 6, 10)} | {"twin": [7] * 10}


def search(spark, books, book_id, top_k=10, params=SMALL):
    sigs = sigs_frame(spark, books)
    index = build_lsh_index(sigs, params.bands, params.rows)
    by_id, by_bucket = (lookup.find_similar_books(sigs, index, book_id, top_k, p) for p in (None, params))
    assert by_id.schema.simpleString() == "struct<book_id:string,similarity:float>"
    assert by_id.collect() == by_bucket.collect()
    return [(r.book_id, round(r.similarity, 6)) for r in by_bucket.collect()]


def expected_hits(books, bands, rows, top_k):
    pairs = candidate_pairs(books, bands, rows)
    hits = {}
    for query in books:
        linked = [b for b in books if (min(b, query), max(b, query)) in pairs and b != query]
        scored = sorted((-estimate(books[query], books[b]), b) for b in linked)
        hits[query] = [(b, round(-s, 6)) for s, b in scored[:top_k]]
    return hits


@pytest.mark.parametrize("asked", ["s0", "s4", "s10", "twin"])
@pytest.mark.parametrize("top_k", [1, 3, 100])
def test_similar_to_one_book(spark, asked, top_k):
    assert search(spark, stepped(), asked, top_k) == expected_hits(stepped(), 2, 5, top_k)[asked]


def test_unknown_and_lonely_ids_find_nothing(spark):
    assert search(spark, stepped(), "unknown") == []
    assert search(spark, stepped(), "s10") == []
    assert search(spark, {"only": [1] * 10, "none": []}, "none") == []


def test_buckets_are_pushed_to_the_stored_index(spark, tmp_path):
    sigs = sigs_frame(spark, clustered())
    index_tables.write_search_tables(sigs, str(tmp_path), SMALL)
    signatures, index = index_tables.read_search_tables(spark, str(tmp_path))
    asked = signatures.where(F.col("book_id") == "b007").select("signature")
    found = lookup.in_buckets(index, asked, SMALL)
    (line,) = [x for x in found._jdf.queryExecution().executedPlan().toString().split("\n") if "PushedFilters" in x]
    pushed = line.split("PushedFilters: ")[1]
    assert all(f"EqualTo(bucket_hash,{value})" in pushed for _, value in buckets(clustered()["b007"], 2, 5))


def test_many_bands_are_looked_up_in_one_set(spark, tmp_path):
    wide = LshParams(num_hashes=40, bands=20, rows=2)
    asked = list(range(40))
    moved = [*range(2, 40), 0, 1]  # every pair of values, each in the band beside its own
    shared = [*range(100, 138), 38, 39]
    sigs = sigs_frame(spark, {"asked": asked, "moved": moved, "shared": shared})
    index_tables.write_search_tables(sigs, str(tmp_path), wide)
    _, index = index_tables.read_search_tables(spark, str(tmp_path))
    found = lookup.in_buckets(index, sigs.where("book_id = 'asked'").select("signature"), wide)
    assert sorted(r.book_id for r in found.collect()) == ["asked", "shared"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    condition = next(x for x in plan.split("\n") if "Filter" in x and "INSET" in x)
    # One look into the set comes before the comparisons that the row groups are asked with.
    assert condition.index("INSET") < condition.index(" OR ") and condition.count("band_id") == 1


def test_ids_that_repeat_are_listed_once(spark):
    rows = [("", [1] * 10), ("", [1] * 10), ("pg1", [1] * 10), ("", [1] * 5 + [2] * 5)]
    sigs = spark.createDataFrame(rows, "book_id string, signature array<bigint>")
    pairs = similar.candidate_pairs(sigs, SMALL).collect()
    assert [(r.book_id_1, r.book_id_2) for r in pairs] == [("", "pg1")]
    assert [tuple(r) for r in similar.scored_pairs(sigs, SMALL).collect()] == [("", "pg1", 1.0)]
    got = by_query(lookup.find_similar_to_all(sigs, SMALL))
    assert got == {"": [("pg1", 1.0)], "pg1": [("", 1.0)]}


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_copies_are_grouped_by_a_digest(spark, kind):
    sigs = spark.createDataFrame([(1, [1] * 10)], "book_id int, signature array<int>")
    named = sigs.select(F.col("book_id").cast(kind), "signature")
    groups = copy_groups(with_copy_key(named, "signature"), "signature")
    plan = groups._jdf.queryExecution().executedPlan().toString()
    assert "key=[copy_key" in plan and "key=[signature" not in plan


def test_values_that_look_alike_are_different_groups(spark):
    rows = [("a", ["x\x1fy"]), ("b", ["x", "y"]), ("c", ["x", None, "y"]), ("d", ['x","y']), ("e", ["x", "y"])]
    sets = spark.createDataFrame(rows, "book_id string, shingles array<string>")
    sizes = [r.n_copies for r in copy_groups(with_copy_key(sets, "shingles"), "shingles").collect()]
    assert sorted(sizes) == [1, 1, 1, 2]


def test_ties_go_by_id(spark):
    books = {name: [1] * 10 for name in "edcba"}
    assert search(spark, books, "c", top_k=3) == [("a", 1.0), ("b", 1.0), ("d", 1.0)]


def by_query(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        hits = got.setdefault(r.query_id, [])
        hits.append((r.book_id, round(r.similarity, 6)))
        assert r["rank"] == len(hits)
    return got


@pytest.mark.parametrize("block_rows", [2, 4096])
@pytest.mark.parametrize("top_k", [1, 3, 100])
def test_all_books_at_once_equal_single_searches(spark, top_k, block_rows):
    books = clustered()
    params = LshParams(num_hashes=10, bands=5, rows=2, top_k=top_k)
    got = by_query(lookup.find_similar_to_all(sigs_frame(spark, {**books, "e": []}), params, block_rows))
    expected = expected_hits(books, 5, 2, top_k)
    assert got == {q: hits for q, hits in expected.items() if hits}


@pytest.mark.parametrize("block_rows", [2, 4096])
def test_query_table_finds_what_single_searches_find(spark, block_rows):
    books = clustered()
    rng = random.Random(5)
    queries = {f"q{i}": books[rng.choice(sorted(books))][:9] + [rng.randrange(3)] for i in range(8)}
    queries["far"] = [5000 + i for i in range(10)]
    params = LshParams(num_hashes=10, bands=5, rows=2, top_k=4)
    got = by_query(
        lookup.find_similar_to_texts(sigs_frame(spark, queries), sigs_frame(spark, books), params, block_rows)
    )
    for query, sig in queries.items():
        hits = expected_hits({**books, "?": sig}, 5, 2, 4)["?"]
        assert got.get(query, []) == hits


def made_text(seed, n=40, changed=0):
    """Words drawn by a seed, the last ``changed`` of them drawn anew."""
    rng, other = random.Random(seed), random.Random(seed + 1000)
    words = [f"w{rng.randrange(5000)}" for _ in range(n)]
    return " ".join(words[: n - changed] + [f"v{other.randrange(5000)}" for _ in range(changed)])


TEXTS = {f"pg{10 * seed + c}": made_text(seed, changed=c) for seed in (1, 2) for c in (0, 2, 5)}
LETTERS = {"pg91": "barge quay tide noon rope mast", "pg92": "lamp desk ink pen page seal"}


@pytest.fixture(scope="module")
def raw_corpus(spark):
    books = spark.createDataFrame(list(TEXTS.items()), "book_id string, content string")
    sigs = documents.text_signatures(books, analyzer="raw").persist()
    yield sigs, build_lsh_index(sigs)
    sigs.unpersist()


def text_hits(spark, corpus, text, **options):
    sigs, index = corpus
    found = lookup.find_similar_by_text(sigs, index, text, **options)
    assert found.schema.simpleString() == "struct<book_id:string,similarity:float>"
    return [(r.book_id, round(r.similarity, 6)) for r in found.collect()]


def test_similar_to_text(spark, raw_corpus):
    signed = {k: signature(shingle_set(v.split(), 3), 50) for k, v in TEXTS.items()}
    asked = made_text(1, changed=3)
    signed["?"] = signature(shingle_set(asked.split(), 3), 50)
    hits = text_hits(spark, raw_corpus, asked.upper())
    assert hits == expected_hits(signed, 10, 5, 10)["?"] and hits
    # A text of the corpus finds itself.
    assert text_hits(spark, raw_corpus, TEXTS["pg20"])[0] == ("pg20", 1.0)


@pytest.mark.parametrize("n_words", [0, 1, 2])
def test_text_below_one_shingle_finds_nothing(spark, raw_corpus, n_words):
    assert text_hits(spark, raw_corpus, made_text(1, n=n_words)) == []


def test_analyzer_of_the_index(spark):
    books = spark.createDataFrame(list(LETTERS.items()), "book_id string, content string")
    sigs = documents.text_signatures(books)
    corpus = (sigs, build_lsh_index(sigs))
    asked = "The BARGE, a quay; tide -- noon of rope 12 mast"
    assert text_hits(spark, corpus, asked, analyzer="index") == [("pg91", 1.0)]
    assert text_hits(spark, corpus, asked, analyzer="raw") == []


def test_rank_all_needs_no_index(spark):
    books = stepped()
    sigs = sigs_frame(spark, books)
    ranked = [(r.book_id, round(r.similarity, 6)) for r in lookup.rank_all(sigs, "s2").collect()]
    others = sorted((-estimate(books["s2"], sig), name) for name, sig in books.items() if name != "s2")
    assert ranked == [(name, round(-s, 6)) for s, name in others]
    assert lookup.rank_all(sigs, "s2", top_k=1).first().book_id == ranked[0][0]
    assert lookup.rank_all(sigs, "unknown").count() == 0


def test_metadata_is_added_in_order_or_left_out(spark):
    result = spark.createDataFrame(
        [("pg2", 0.9), ("pg1", 0.9), ("pg3", 1.0)], "book_id string, similarity float"
    )
    titles = spark.createDataFrame(
        [("pg1", "One", "A"), ("pg3", "Three", None), ("pg9", "Nine", "B")],
        "book_id string, Title string, Author string",
    )
    got = [(r.book_id, r.Title, r.Author) for r in enrich(result, titles).collect()]
    assert got == [("pg3", "Three", None), ("pg1", "One", "A"), ("pg2", None, None)]
    assert enrich(result, None) is result


def rows_read(df):
    """Rows that the scan of a plan without a shuffle gives on, after folders and row groups are pruned."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_lookup_reads_the_folders_of_its_candidates(spark, tmp_path):
    """Of 20,000 documents in 64 folders by id, the signatures of k ids come out of at most k folders."""
    n, params = 20_000, LshParams(num_hashes=10, bands=2, rows=5)
    values = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.pmod(F.xxhash64(F.floor(F.col("id") / 4), i), F.lit(1000)).cast("int"))
    near = F.transform(values, lambda v, i: F.when((i > 5) & (F.col("id") % 4 == 3), F.lit(1)).otherwise(v))
    sigs = spark.range(n).select(F.concat(F.lit("d"), "id").alias("book_id"), near.alias("signature"))
    index_tables.write_search_tables(sigs, str(tmp_path), params)
    signatures, index = index_tables.read_search_tables(spark, str(tmp_path))
    ids = spark.createDataFrame([("d17",), ("d18",), ("d4711",), ("none",)], "book_id string")
    found = lookup.signatures_of(signatures, ids)
    assert {r.book_id for r in found.select("book_id").collect()} == {"d17", "d18", "d4711"}
    assert rows_read(lookup.signatures_of(signatures, ids)) <= 1.5 * 4 * n / index_tables.ID_BUCKETS
    assert rows_read(lookup._of_book(signatures, "d17")) <= 1.5 * n / index_tables.ID_BUCKETS
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "id_bucket" in plan.split("PartitionFilters")[1].split("]")[0] and "book_id" in plan.split("PushedFilters")[1]
    want = lookup.find_similar_books(sigs, build_lsh_index(sigs, 2, 5), "d17").collect()
    assert lookup.find_similar_books(signatures, index, "d17", params=params).collect() == want and want


def test_more_candidates_than_are_asked_by_value(spark, tmp_path, monkeypatch):
    sigs = sigs_frame(spark, clustered(), "int")
    index_tables.write_search_tables(sigs, str(tmp_path), SMALL)
    tables = index_tables.read_search_tables(spark, str(tmp_path))
    want = lookup.find_similar_books(*tables, "b007", params=SMALL).collect()
    monkeypatch.setattr(lookup, "ASKED_BY_VALUE", 1)
    assert lookup.find_similar_books(*tables, "b007", params=SMALL).collect() == want and len(want) > 1


def test_comparisons_saved(spark):
    books = clustered()
    sigs = sigs_frame(spark, books)
    index = build_lsh_index(sigs, 2, 5)
    n_found = sum("b007" in pair for pair in candidate_pairs(books, 2, 5))
    for params in (None, SMALL):
        (row,) = lookup.comparisons_saved(sigs, index, "b007", params).collect()
        assert (row.n_others, row.n_candidates, row.n_saved) == (59, n_found, 59 - n_found)
        assert row.saved_pct == pytest.approx((59 - n_found) / 59 * 100)
    assert tuple(lookup.comparisons_saved(sigs, index, "nobody", SMALL).first()) == (0, 0, 0, 0.0)
