import random

import numpy as np
import pyarrow as pa
import pytest

from nearkin.llm import jaccard

from . import definitions
from .conftest import prose


def near(text, changes, seed):
    words = text.split(" ")
    rng = random.Random(seed)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus():
    texts = []
    for base in range(6):
        text = prose(90, base).replace("\n", " ")
        texts += [near(text, c, base * 31 + c) for c in (0, 0, 1, 1, 2, 3, 4, 6)]
    passage = prose(40, 77).replace("\n", " ")
    texts += [passage + " " + prose(30, 100 + i).replace("\n", " ") for i in range(12)]
    texts += [passage, passage.upper(), "a b c", "A b\tc", "a b", None, "", " \n"]
    texts += [prose(90, 0).replace("\n", " ") + " tail" * n for n in range(1, 30, 4)]
    return texts


@pytest.mark.parametrize("list_rows, frequent", [(jaccard.LIST_ROWS, jaccard.FREQUENT), (2, 50), (3, 1)])
def test_components_match_the_definition(docs_of, monkeypatch, list_rows, frequent):
    monkeypatch.setattr(jaccard, "LIST_ROWS", list_rows)
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    texts = corpus()
    docs = docs_of(texts).repartition(3)
    groups, links = jaccard.similar_groups(docs)
    want, want_links = definitions.components(list(enumerate(texts)))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in groups.collect()} == want
    assert {(r.a, r.b) for r in links.collect()} <= want_links


def test_large_group_of_near_copies_gives_no_pairs_of_all(docs_of):
    base = prose(120, 3).replace("\n", " ")
    texts = [near(base, 1, s) for s in range(400)] + [base] * 200
    groups, links = jaccard.similar_groups(docs_of(texts))
    assert {r.component_id for r in groups.collect()} == {0}
    assert links.count() < 3 * len(texts)


def test_copies_that_only_the_original_joins(docs_of):
    """Each copy is near the original and not near the other copies: a star, found in its hub."""
    base = prose(150, 3).replace("\n", " ")
    words = base.split(" ")
    texts = [" ".join(f"c{i}x{j}" if j % 60 == i % 60 else w for j, w in enumerate(words)) for i in range(200)]
    docs = docs_of([*texts, base])
    want, links = definitions.components(list(enumerate([*texts, base])))
    assert {c for _, c in want.values()} == {0} and len(links) < 20_000
    groups, found = jaccard.similar_groups(docs)
    assert {r.component_id for r in groups.collect()} == {0}
    assert found.count() <= 2 * len(texts)


def test_awkward_rows(awkward, awkward_rows, docs_of):
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_groups(awkward)[0].collect())
    want, _ = definitions.components([(i, t) for i, t in dict(awkward_rows).items()])
    assert got == sorted((i, *want[i]) for i, _ in awkward_rows)
    rows = jaccard.similar_groups(docs_of([prose(20, 1)] * 3, [None, 7, 9]))[0].collect()
    assert {(r.doc_id, r.component_id) for r in rows} == {(None, None), (7, 7), (9, 7)}


def test_nothing(empty):
    groups, links = jaccard.similar_groups(empty)
    assert groups.count() == 0 and links.count() == 0


def test_prefix_is_as_short_as_it_may_be():
    for size in range(1, 60):
        least = -(-80 * size // 100)
        # Sets that share less than `least` of one of them are never similar.
        assert jaccard.prefix_length(size) == size - least + 1


def test_counts_by_range_bound_what_is_shared():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 60, rng.integers(0, 40))) for _ in range(2))
        one, two = (np.bincount(x // 8, minlength=8)[None] for x in (a, b))
        assert jaccard.shared_at_most(one, two)[0] >= len(np.intersect1d(a, b))


def test_lists_run_on_across_batches():
    rng = np.random.default_rng(2)
    shingle = np.sort(rng.integers(0, 40, 200))
    size = np.repeat(10, 200)
    rows = sorted(zip(shingle.tolist(), [0] * 200, (size << 24).tolist(), range(200), strict=True))
    whole = pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows]), pa.array([-1] * 200, pa.int32()), pa.array([5] * 200, pa.int32()),
            pa.array([r[3] for r in rows]), pa.array([r[2] for r in rows]),
        ],
        names=["shingle", "salt", "place_in_list", "doc_id", "size_place"],
    )
    for step in (1, 2, 7, 200):
        batches = [whole.slice(i, step) for i in range(0, 200, step)]
        got = [r for b in jaccard._lists_of_two(iter(batches)) for r in b.to_pylist()]
        counts = np.bincount(shingle)
        assert [r["doc_id"] for r in got] == [r[3] for r in rows if counts[r[0]] > 1]
        first = {}
        for r in got:
            assert r["hub"] == first.setdefault(r["shingle"], r["doc_id"])


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 200) if i != 90], "a long, b long")
    got = {r.doc_id: r.component_id for r in jaccard.components(spark, edges).collect()}
    assert got == {i: 0 if i <= 90 else 91 for i in range(201)}
