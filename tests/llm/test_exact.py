"""Exact duplicates: against grouping in Python, load after load, and with a text that most rows have."""

from pyspark.sql import functions as F

from nearkin.llm import exact
from nearkin.session import scratch_path, stored

from . import definitions


def listed(found):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found.collect()), key=repr)


def test_matches_the_definition(docs_of):
    texts = ["a b", "a  b", "a\t\nb ", " a b", None, "", " ", "\n\n", "c", "c", "c\xa0", "c", "A b", "\x0ba b", "\x1ca b"]
    ids = [9, 3, 5, None, 7, None, 2, 1, 8, None, 4, 8, 6, 11, 12]
    want = definitions.equal_texts(list(zip(ids, texts, strict=True)))
    for loads in (1, 2, 5):
        assert listed(exact.deduplicated(docs_of(texts, ids), loads=loads)) == want


def test_awkward_and_empty_tables(awkward, awkward_rows, empty):
    assert listed(exact.deduplicated(awkward.withColumn("keep_id", F.lit("clash")))) == definitions.equal_texts(awkward_rows)
    found = exact.deduplicated(empty)
    assert found.count() == 0
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_a_text_of_most_rows_is_joined_apart(docs_of, monkeypatch):
    monkeypatch.setattr(exact, "HOT_SHARE", 0.01)
    texts = ["same  text" if i % 3 else f"text {i // 6}" for i in range(300)]
    want = definitions.equal_texts(list(enumerate(texts)))
    assert listed(exact.deduplicated(docs_of(texts))) == want


def test_loads_see_what_earlier_loads_have_brought(spark, docs_of):
    path = scratch_path(spark, "index")
    index = exact.DigestIndex(spark, path, 3)
    first = docs_of(["a", "b", "a "], [5, 6, 7]).withColumn("exact_row", F.lit("clash"))
    assert {r.doc_id for r in exact.new_rows(first, index, "monday").collect()} == {5, 6, 7}
    second = docs_of(["b", "c", "c", "a"], [1, 2, 3, 4])
    assert {r.doc_id for r in exact.new_rows(second, index, "tuesday").collect()} == {2}
    # A load that is given again brings nothing new and returns the same.
    assert {r.doc_id for r in exact.new_rows(second, index, "tuesday").collect()} == {2}
    index.close()
    # Another session opens the folder.
    again = exact.DigestIndex(spark, path, 3)
    assert again.rows().count() == 4
    third = exact.new_rows(docs_of(["d", "a ", "b"], [20, 21, 22]), again, "wednesday")
    assert [(r.doc_id, r.exact_row if "exact_row" in third.columns else None) for r in third.collect()] == [(20, None)]
    again.close()


def test_index_is_bucketed_and_joined_without_moving_it(spark, docs_of):
    index = exact.DigestIndex(spark, scratch_path(spark, "index"), 4)
    exact.new_rows(docs_of([f"t{i}" for i in range(50)]), index, "one")
    rows = stored(exact.with_digests(docs_of([f"t{i}" for i in range(40, 60)])), "rows")
    plan = (
        rows.select("digest").distinct().repartition(4, "digest")
        .join(index.rows().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    )
    index_side = plan[plan.index("SortMergeJoin"):].split("FileScan parquet spark_catalog")[0].splitlines()[-3:]
    assert "SortMergeJoin" in plan and not any("Exchange" in line for line in index_side)
    index.close()
