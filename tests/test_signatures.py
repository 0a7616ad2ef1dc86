import hashlib
import random
import struct

import pytest
from definitions import h31, shingle_set, signature
from pyspark.sql import functions as F

from nearkin.functions import text
from nearkin.functions.hashing import band_bucket, hash_family, stable_hash, stable_hashes
from nearkin.functions.minhash import estimate_jaccard
from nearkin.functions.shingles import exact_jaccard
from nearkin.operators import documents as d
from nearkin.params import CLUSTER, DEV, LshParams

WORDS = ["", "a", "quick brown fox", "für élise", "日本語 テキスト", "x" * 500, "\u0000", "é"]


def tokens_frame(spark, **books):
    return spark.createDataFrame(list(books.items()), "book_id string, tokens array<string>")


def sets_frame(spark, **books):
    return spark.createDataFrame(list(books.items()), "book_id string, shingles array<string>")


def by_id(df, value):
    return {r["book_id"]: r[value] for r in df.collect()}


def test_hash_vectors(spark):
    rows = spark.createDataFrame([(w,) for w in WORDS], "w string")
    got = rows.select("w", stable_hash(F.col("w")).alias("h"), stable_hashes(F.array("w"))[0].alias("g"))
    for r in got.collect():
        assert r.h == r.g == int(hashlib.md5(r.w.encode()).hexdigest(), 16) % (2**31 - 1)


def test_hash_family_is_a_prefix():
    assert hash_family(2) == [(1373158607, 239081663), (53710185, 1592467581)]
    assert hash_family(200)[:50] == hash_family(50)
    assert hash_family(3, seed=1) != hash_family(3)


@pytest.mark.parametrize("values", [[1, 2, 3, 4, 5], [-1, 2**31 - 1, 0, -(2**31), 7], [9]])
def test_band_vectors(spark, values):
    expected = h31(struct.pack(f">{len(values)}i", *values))
    for kind in ("array<int>", "array<bigint>"):
        row = spark.createDataFrame([(values,)], f"v {kind}").select(band_bucket(F.col("v"))).first()
        assert row[0] == expected


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_shingles_match_the_definition(spark, k):
    rng = random.Random(k)
    books = {f"n{n}": rng.choices(["barge", "quay", "tide"], k=n) for n in range(9)} | {"null": None}
    found = d.generate_shingles(tokens_frame(spark, **books), k)
    assert found.schema.simpleString() == "struct<book_id:string,shingles:array<string>>"
    got = by_id(found, "shingles")
    want = {name: shingle_set(words, k) for name, words in books.items() if words and len(words) >= k}
    assert {name: sorted(v) for name, v in got.items()} == {name: sorted(v) for name, v in want.items()}


def test_raw_shingles_keep_stop_words_and_marks(spark):
    books = spark.createDataFrame(
        [("a", "The  quick\tbrown fox, the"), ("b", "too short")], "book_id string, content string"
    )
    got = by_id(d.shingle_texts(books, 3), "shingles")
    assert {k: set(v) for k, v in got.items()} == {
        "a": shingle_set(["the", "quick", "brown", "fox,", "the"], 3)
    }


@pytest.mark.parametrize("method", [d.compute_signatures, d.signatures_by_grouping])
def test_signature_vectors(spark, method):
    sets = {"a": ["ab", "bc", "cd"], "b": ["für"], "c": WORDS, "none": [], "null": None}
    got = by_id(method(sets_frame(spark, **sets), 20), "signature")
    assert got == {k: signature(v or [], 20) for k, v in sets.items()}


def test_signature_schema_and_empty_input(spark):
    out = d.compute_signatures(sets_frame(spark, a=["x"]).where("false"), 5)
    assert out.schema["signature"].dataType.simpleString() == "array<int>"
    assert out.count() == 0


def estimate_of(spark, left, right, n=100):
    both = d.compute_signatures(sets_frame(spark, a=left, b=right), n)
    a, b = (both.where(F.col("book_id") == k).agg(F.min("signature").alias("s")) for k in "ab")
    return a.select(F.col("s").alias("a"), b.scalar().alias("b")).select(
        estimate_jaccard(F.col("a"), F.col("b"))
    ).first()[0]


@pytest.mark.parametrize("shared", [0, 25, 60, 100])
def test_estimate_is_near_the_overlap(spark, shared):
    """Sets of 100 with a known number of common members; four deviations of 400 hashes."""
    left = [f"item {i}" for i in range(100)]
    right = [f"item {i}" for i in range(100 - shared, 200 - shared)]
    exact = shared / (200 - shared)
    error = abs(estimate_of(spark, left, right, 400) - exact)
    assert error <= 4 * (exact * (1 - exact) / 400) ** 0.5


@pytest.mark.parametrize("left, right", [([], []), ([1], []), ([1, 2], [1]), (None, [1])])
def test_estimate_of_incomparable_signatures_is_zero(spark, left, right):
    row = spark.createDataFrame([(left, right)], "l array<int>, r array<int>")
    assert row.select(estimate_jaccard(F.col("l"), F.col("r"))).first()[0] == 0.0


def test_exact_jaccard(spark):
    rows = spark.createDataFrame(
        [(["a", "b"], ["b", "c"]), ([], []), (["a"], [])], "l array<string>, r array<string>"
    )
    assert [r[0] for r in rows.select(exact_jaccard(F.col("l"), F.col("r"))).collect()] == [1 / 3, 0.0, 0.0]


def test_one_pass_equals_the_steps(spark):
    books = spark.createDataFrame(
        [("a", "Barge, quay -- tide; barge at noon!"), ("b", "of and to"), ("c", None)],
        "book_id string, content string",
    )
    steps = d.compute_signatures(d.generate_shingles(d.tokenize(books)), DEV.num_hashes)
    assert by_id(d.text_signatures(books), "signature") == by_id(steps, "signature")


def test_text_is_tokenised_once_per_document(spark):
    """A filter on a derived array must not pull the tokeniser into it."""
    books = spark.createDataFrame([("a", "x y z")], "book_id string, content string")
    plan = d.text_signatures(books)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1


def test_parameters_are_checked():
    assert (DEV.num_hashes, DEV.bands, CLUSTER.num_hashes, CLUSTER.bands) == (50, 10, 100, 20)
    with pytest.raises(ValueError):
        LshParams(num_hashes=10, bands=3, rows=5)
    with pytest.raises(ValueError):
        DEV.but(top_k=0)
    with pytest.raises(ValueError):
        d.words_of(F.lit("x"), "other", [])


def test_index_texts_are_signed_in_one_arrow_pass(spark):
    """No digest, split or shingle per element on the JVM; the tokens are those of ``text.index_tokens``."""
    odd = ["Kelvin İstanbul café\x1cone two three", "A\x0bb\x0c THE the\r\nxy zz", "", None, "   ", "aa bb cc aa bb cc"]
    books = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "book_id int, content string")
    for made in (d.text_signatures(books, DEV), d.shingle_texts(books, 3, "index")):
        plan = made._jdf.queryExecution().executedPlan().toString().lower()
        assert "mapinarrow" in plan and "md5" not in plan and "lambda" not in plan
    on_jvm = books.select("book_id", text.index_tokens(F.col("content")).alias("tokens")).where(F.size("tokens") > 0)
    assert sorted(d.tokenize(books).collect()) == sorted(on_jvm.collect())


def test_sets_and_signatures_come_out_of_texts_in_one_pass(spark):
    """Without lists of strings on the way."""
    from nearkin.operators import copies, documents

    odd = [None, "", "ab", "Kelvin İstanbul CAFÉ ǅ straße", "One\x0btwo\x1cthree four\x85five six\tseven", "a b c " * 50]
    texts = [*odd, *[" ".join(f"w{chr(97 + i)}{chr(97 + (i * j) % 26)}" for i in range(26)) for j in range(1, 9)]]
    books = spark.createDataFrame(list(enumerate(texts)), "book_id bigint, content string")
    want = copies.hashed_sets(documents.shingle_texts(books, 3, "index"), 7)
    got = copies.text_sets(books, 3, 7)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert copies.hashed_sets(got) is got


def test_minima_in_parts_are_minima(monkeypatch):
    import numpy as np

    from nearkin.functions import minhash
    from nearkin.functions.hashing import PRIME, hash_family

    rng = np.random.default_rng(3)
    lengths = np.array([0, 1, 5, 0, 40, 3, 0])
    values = np.concatenate([[0, PRIME - 1, PRIME - 1, 1], rng.integers(0, PRIME, lengths.sum() - 4)])
    family = [*hash_family(20), (1, 0), (PRIME - 1, PRIME - 1), (1, 1)]
    sets = np.split(values.tolist(), np.cumsum(lengths)[:-1])
    want = [[min((a * int(v) + b) % PRIME for v in s) for a, b in family] if len(s) else [] for s in sets]
    for at_once in (1, 6, 1 << 15):
        monkeypatch.setattr(minhash, "VALUES_AT_ONCE", at_once)
        assert minhash.minima(lengths, values, family).to_pylist() == want
