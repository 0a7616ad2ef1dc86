import random

import pytest
from definitions import buckets, candidate_pairs
from pyspark.sql import functions as F

from nearkin.operators import copies, lookup, lsh
from nearkin.operators.pairing import join_counted, key_sizes, matches_on_key, pairs_sharing_key
from nearkin.params import LshParams
from nearkin.plans import similar
from nearkin.session import stored


def sigs_frame(spark, books, kind="bigint"):
    return spark.createDataFrame(list(books.items()), f"book_id string, signature array<{kind}>")


def pair_set(df):
    rows = [(r.book_id_1, r.book_id_2) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


LOW, HIGH = list(range(10)), list(range(100, 110))


def clustered(n=60, seed=3, length=10):
    """Signatures with copies, near copies and strangers."""
    rng = random.Random(seed)
    bases = [[rng.randrange(1000) for _ in range(length)] for _ in range(4)]
    books = {}
    for i in range(n):
        sig = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            sig[rng.randrange(length)] = rng.randrange(1000)
        books[f"b{i:03d}"] = sig
    return books


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_one_row_per_band(spark, kind):
    index = lsh.build_lsh_index(sigs_frame(spark, {"a": LOW}, kind), 2, 5)
    assert {(r.band_id, r.bucket_hash) for r in index.collect()} == buckets(LOW, 2, 5)
    assert index.schema.simpleString() == "struct<book_id:string,band_id:int,bucket_hash:int>"


def test_surplus_values_are_ignored_and_empty_signatures_give_no_row(spark):
    index = lsh.build_lsh_index(sigs_frame(spark, {"a": [*LOW, 99], "e": []}), 2, 5)
    assert {(r.band_id, r.bucket_hash) for r in index.collect()} == buckets(LOW, 2, 5)


def test_short_signature_is_an_error(spark):
    with pytest.raises(Exception, match="shorter"):
        lsh.build_lsh_index(sigs_frame(spark, {"a": LOW}), 3, 5).collect()


def test_equal_signatures_share_all_buckets_and_far_ones_none(spark):
    index = lsh.build_lsh_index(sigs_frame(spark, {"a": LOW, "b": LOW, "c": HIGH}), 2, 5)
    shared = lsh.shared_buckets(index).collect()
    assert {(r.band_id, r.book_id, r.n_members) for r in shared} == {
        (band, book, 2) for band in (0, 1) for book in "ab"
    }


def test_pairs_have_no_self_pair_and_no_duplicate(spark):
    index = lsh.build_lsh_index(sigs_frame(spark, {"a": LOW, "b": LOW, "c": HIGH}), 2, 5)
    assert pair_set(lsh.find_candidate_pairs(index)) == {("a", "b")}
    index = lsh.build_lsh_index(sigs_frame(spark, {"a": LOW, "b": LOW, "c": LOW}), 2, 5)
    assert pair_set(lsh.find_candidate_pairs(index)) == {("a", "b"), ("a", "c"), ("b", "c")}


@pytest.mark.parametrize("block_rows", [1, 2, 7, 4096])
def test_blocks_lose_and_double_no_pair(spark, block_rows):
    books = clustered()
    index = lsh.build_lsh_index(sigs_frame(spark, books), 5, 2)
    expected = candidate_pairs(books, 5, 2)
    assert pair_set(lsh.find_candidate_pairs(index, block_rows)) == expected
    keyed = spark.createDataFrame([(i % 2, i) for i in range(11)], "k int, book_id int")
    pairs = pairs_sharing_key(keyed, ["k"], "book_id", block_rows=block_rows)
    assert pair_set(pairs) == {(a, b) for a in range(11) for b in range(a + 1, 11) if (b - a) % 2 == 0}


def test_carried_columns_follow_their_id(spark):
    keyed = spark.createDataFrame([(0, i, i * 10) for i in range(9)], "k int, book_id int, v int")
    for r in pairs_sharing_key(keyed, ["k"], "book_id", ["v"], block_rows=2).collect():
        assert r.book_id_1 < r.book_id_2
        assert (r.v_1, r.v_2) == (r.book_id_1 * 10, r.book_id_2 * 10)


@pytest.mark.parametrize("block_rows", [1, 3, 4096])
def test_blocked_join_is_the_join(spark, block_rows):
    left = spark.createDataFrame([(i % 3, i) for i in range(10)], "k int, l int")
    right = spark.createDataFrame([(i % 4, i) for i in range(13)], "k int, r int")
    got = sorted(tuple(r) for r in matches_on_key(left, right, ["k"], block_rows).collect())
    assert got == sorted(tuple(r) for r in left.join(right, "k").collect())


@pytest.mark.parametrize("block_rows", [1, 7, 4096])
@pytest.mark.parametrize("pairs_of", [lookup.group_pairs, lsh.pairs_of_signatures])
def test_pairs_come_from_their_first_band_and_are_not_held(spark, pairs_of, block_rows):
    books = clustered()
    pairs = pairs_of(sigs_frame(spark, books), LshParams(num_hashes=10, bands=5, rows=2), block_rows)
    got = [(r.book_id_1, r.book_id_2) for r in pairs.collect()]
    assert set(got) == candidate_pairs(books, 5, 2) and len(got) == len(set(got))
    assert "Aggregate" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_ids_that_repeat_are_listed_once(spark):
    rows = [("a", LOW), ("b", LOW), ("b", [*LOW[:5], *HIGH[5:]]), ("b", LOW)]
    sigs = spark.createDataFrame(rows, "book_id string, signature array<int>")
    params = LshParams(num_hashes=10, bands=2, rows=5)
    for pairs in (lsh.pairs_of_signatures(sigs, params), similar.candidate_pairs(sigs, params)):
        assert [tuple(r) for r in pairs.collect()] == [("a", "b")]


def test_earlier_buckets_are_those_of_the_bands_before(spark):
    sigs = sigs_frame(spark, {"a": LOW, "e": [], "c": HIGH})
    rows = lsh.build_lsh_index(sigs, 5, 2, earlier=True).orderBy("book_id", "band_id").collect()
    for book_id in ("a", "c"):
        own = [r for r in rows if r.book_id == book_id]
        assert [r.earlier for r in own] == [[r.bucket_hash for r in own[:band]] for band in range(5)]


@pytest.mark.parametrize("block_rows", [2, 4096])
def test_pairs_by_way_of_copy_groups_are_all_pairs(spark, block_rows):
    books = clustered()
    sigs = sigs_frame(spark, books)
    keyed = copies.with_copy_key(sigs, "signature")
    groups = copies.copy_groups(keyed, "signature")
    assert groups.agg(F.sum("n_copies")).first()[0] == len(books) > groups.count()
    members = copies.copy_members(keyed)
    index = lsh.build_lsh_index(groups.select(F.col("copy_key").alias("book_id"), "signature"), 5, 2)
    leaders = lsh.find_candidate_pairs(index)
    expanded = copies.expand_pairs(leaders, members, block_rows=block_rows)
    assert pair_set(expanded) == candidate_pairs(books, 5, 2)
    assert copies.expand_pairs(leaders, members).columns == ["book_id_1", "book_id_2"]


@pytest.mark.parametrize(
    "b, r, expected",
    [(10, 10, 0.7943), (20, 5, 0.5493), (25, 4, 0.4472), (50, 2, 0.1414), (10, 5, 0.6310), (5, 10, 0.8513)],
)
def test_threshold(spark, b, r, expected):
    assert spark.range(1).select(F.round(lsh.match_threshold(b, r), 4)).first()[0] == expected


def test_s_curve(spark):
    configs = spark.createDataFrame([(20, 5)], "bands int, rows int")
    points = lsh.s_curve(configs).orderBy("similarity").collect()
    assert len(points) == 200
    assert (points[0].similarity, points[0].probability) == (0.0, 0.0)
    assert (points[-1].similarity, points[-1].probability) == (1.0, 1.0)
    middle = points[100]
    assert middle.probability == pytest.approx(1 - (1 - middle.similarity**5) ** 20)


def rows_per_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_a_hot_key_is_dealt_over_tasks_before_the_shuffle(spark):
    """20,000 of 30,000 rows under one key: no task gets more than twice an even share."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(30_000).select(F.when(F.col("id") < 20_000, F.lit(0)).otherwise(F.col("id") % 5_000).alias("k"), F.col("id").alias("v"))
        sizes = stored(key_sizes(rows, ["k"], "n"), "sizes")
        joined = join_counted(rows, sizes, ["k"], "n")
        assert max(rows_per_task(joined)) <= 2 * 30_000 / 4
        assert max(rows_per_task(rows.join(sizes, "k"))) >= 20_000
        want = rows.join(sizes, "k")
        assert joined.select("k", "v", "n").exceptAll(want.select("k", "v", "n")).count() == 0
        assert joined.count() == want.count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_members_of_a_bucket_of_very_many(spark):
    index = spark.range(20_000).select(F.col("id").alias("book_id"), F.lit(0).alias("band_id"), F.when(F.col("id") < 19_000, 7).otherwise(F.col("id").cast("int")).alias("bucket_hash"))
    found = lsh.shared_buckets(index)
    assert found.count() == 19_000 and found.agg(F.min("n_members")).first()[0] == 19_000


def test_keys_that_are_null_meet_nothing(spark):
    rows = spark.createDataFrame([(None, i) for i in range(5)] + [(1, 9), (1, 10)], "k int, book_id int")
    assert pair_set(pairs_sharing_key(rows, ["k"], "book_id")) == {(9, 10)}
