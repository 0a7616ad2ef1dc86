import random
from itertools import combinations

import pytest
from definitions import candidate_pairs, estimate, jaccard, signature
from pyspark.sql import functions as F

from nearkin.operators import similarity
from nearkin.plans import evaluate as ev


def corpus(n=50, seed=1):
    """Sets with copies, near copies, one common element, and strangers."""
    rng = random.Random(seed)
    bases = [[f"s{rng.randrange(400)}" for _ in range(20)] for _ in range(4)]
    books = {}
    for i in range(n):
        items = set(rng.choice(bases)) | {"common"}
        for _ in range(rng.choice([0, 0, 2, 5, 15])):
            items.discard(rng.choice(sorted(items)))
            items.add(f"s{rng.randrange(400)}")
        books[f"b{i:03d}"] = items
    books["one"], books["two"] = {"alone"}, {"alone", "x"}
    return books


@pytest.fixture(scope="module")
def books():
    return corpus()


@pytest.fixture(scope="module")
def shingled(spark, books):
    rows = [(k, sorted(v)) for k, v in books.items()]
    random.Random(2).shuffle(rows[0][1])
    return spark.createDataFrame(rows, "book_id string, shingles array<string>")


def true_pairs(books, t):
    scored = {(a, b): jaccard(books[a], books[b]) for a, b in combinations(sorted(books), 2)}
    return {pair: j for pair, j in scored.items() if j >= t and j > 0}


@pytest.mark.parametrize("t", [0.05, 0.3, 0.5, 0.8, 1.0])
@pytest.mark.parametrize("block_rows", [3, 4096])
def test_similar_sets_are_complete(shingled, books, t, block_rows):
    rows = similarity.similar_sets(shingled, t, block_rows).collect()
    assert {(r.book_id_1, r.book_id_2): r.jaccard for r in rows} == true_pairs(books, t)
    assert len(rows) == len(true_pairs(books, t))


def test_similar_sets_at_every_overlap(spark):
    """All pairs of subsets of five elements, at thresholds that hit exact ratios."""
    subsets = [list(c) for n in range(1, 6) for c in combinations("abcde", n)]
    sets = {f"{i:02d}": set(s) for i, s in enumerate(subsets)}
    frame = spark.createDataFrame(
        [(k, sorted(v)) for k, v in sets.items()], "book_id string, shingles array<string>"
    )
    for t in (1 / 3, 0.4, 0.5, 0.6, 2 / 3, 0.75):
        rows = similarity.similar_sets(frame, t).collect()
        assert {(r.book_id_1, r.book_id_2): r.jaccard for r in rows} == true_pairs(sets, t)


def test_threshold_must_be_positive(shingled):
    with pytest.raises(ValueError):
        similarity.similar_sets(shingled, 0)


class Flags:
    """Of every pair of documents, whether the index finds it and whether it is similar."""

    def __init__(self, books, n, b, r, t=0.5):
        found = candidate_pairs({k: signature(v, n) for k, v in books.items()}, b, r)
        similar = set(true_pairs(books, t))
        self.pairs = [(p in found, p in similar) for p in combinations(sorted(books), 2)]

    def share(self, of, among):
        """The share of pairs that meet ``of`` among those that meet ``among``."""
        chosen = [pair for pair in self.pairs if among(*pair)]
        return sum(of(*pair) for pair in chosen) / len(chosen) if chosen else 0.0

    def check(self, row, digits=12):
        both, either = lambda f, s: f and s, lambda f, s: f or s
        overlap = self.share(both, either)
        want = {
            "n_candidates": sum(f for f, _ in self.pairs),
            "recall": self.share(both, lambda f, s: s),
            "precision": self.share(both, lambda f, s: f),
            # F1 of the two sets of pairs, from their Jaccard similarity.
            "f1": 2 * overlap / (1 + overlap),
            "fpr": self.share(lambda f, s: f, lambda f, s: not s),
        }
        assert {k: row[k] for k in want} == pytest.approx({k: round(v, digits) for k, v in want.items()})


@pytest.fixture(scope="module")
def prepared(spark, shingled):
    return ev.prepare(shingled, 40)


@pytest.mark.parametrize("b, r", [(10, 4), (20, 2), (1, 40)])
def test_metrics_count_document_pairs(prepared, books, b, r):
    (row,) = ev.lsh_metrics(prepared, b, r).collect()
    flags = Flags(books, 40, b, r)
    flags.check(row)
    cells = [(True, True), (True, False), (False, True), (False, False)]
    assert [row.tp, row.fp, row.fn, row.tn] == [flags.pairs.count(cell) for cell in cells]


def test_ratios_of_a_worked_table(spark):
    """Ten similar pairs of which six are found, among eight found and a hundred in all."""
    counts = spark.createDataFrame([(6.0, 2.0, 4.0, 88.0)], "tp double, fp double, fn double, tn double")
    row = ev.with_metrics(counts).first()
    assert (row.recall, row.precision, row.f1, row.fpr) == pytest.approx((0.6, 0.75, 2 / 3, 2 / 90))


def test_sweep_uses_prefixes_of_one_signature(prepared, books):
    rows = ev.sweep(prepared, [(20, 10, 2), (40, 20, 2)]).collect()
    for row in rows:
        Flags(books, row.n, row.b, row.r).check(row, 4)
    best = ev.best_config(ev.sweep(prepared, [(20, 10, 2), (40, 20, 2)])).first()
    assert best.f1 == max(r.f1 for r in rows)
    with pytest.raises(ValueError):
        ev.sweep(prepared, [(20, 10, 3)])


def test_lsh_vs_exact(prepared, books):
    rows = {r.method: r for r in ev.lsh_vs_exact(prepared, 20, 2).collect()}
    total = len(books) * (len(books) - 1) / 2
    n_found = sum(found for found, _ in Flags(books, 40, 20, 2).pairs)
    assert rows["BruteForce"].n_candidates == total
    assert rows["LSH"].selectivity == pytest.approx(round(n_found / total, 4))


def test_ratios_without_denominator_are_zero(spark):
    nothing = spark.createDataFrame([(0.0, 0.0, 0.0, 0.0)], "tp double, fp double, fn double, tn double")
    row = ev.with_metrics(nothing).first()
    assert (row.recall, row.precision, row.f1, row.fpr) == (0.0, 0.0, 0.0, 0.0)


def test_empty_corpus(spark):
    nothing = spark.createDataFrame([], "book_id string, shingles array<string>")
    prepared = ev.prepare(nothing, 10)
    assert ev.lsh_metrics(prepared, 2, 5).first().asDict() == dict.fromkeys(
        ["n_candidates", "tp", "fp", "fn", "tn", "recall", "precision", "f1", "fpr"], 0.0
    )


def test_candidate_stats(prepared, books):
    signed = {k: signature(v, 40) for k, v in books.items()}
    counts = dict.fromkeys(books, 0)
    for a, b in candidate_pairs(signed, 20, 2):
        counts[a] += 1
        counts[b] += 1
    row = ev.candidate_stats(prepared, 20, 2).first()
    average, others = sum(counts.values()) / len(counts), len(counts) - 1
    assert row.n_docs == len(counts)
    assert row.max_candidates == max(counts.values())
    assert row.n_without == sum(c == 0 for c in counts.values())
    assert row.avg_candidates == pytest.approx(average)
    assert row.reduction == pytest.approx(1 - average / others)


def test_estimate_error(spark, shingled, books):
    from nearkin.operators.documents import compute_signatures

    pairs = spark.createDataFrame([("b000", "b001"), ("b002", "one")], "book_id_1 string, book_id_2 string")
    rows = similarity.estimate_error(pairs, shingled, compute_signatures(shingled, 30)).collect()
    for r in rows:
        a, b = books[r.book_id_1], books[r.book_id_2]
        assert r.jaccard == pytest.approx(jaccard(a, b))
        assert r.similarity == pytest.approx(estimate(signature(a, 30), signature(b, 30)))
        assert r.error == pytest.approx(abs(r.jaccard - r.similarity))
    assert len(rows) == 2


@pytest.mark.parametrize("target", [1, 51, 52, 53, 130])
def test_replicate(shingled, books, target):
    rows = ev.replicate(shingled, target).collect()
    ids = {r.book_id for r in rows}
    assert len(rows) == len(ids) == target
    for r in rows:
        assert set(r.shingles) == books[r.book_id.rsplit("_", 1)[0]]


def test_sample_ids(shingled, books):
    first = [r.book_id for r in ev.sample_ids(shingled, 10).collect()]
    again = [r.book_id for r in ev.sample_ids(shingled.repartition(3), 10).collect()]
    assert first == again and len(set(first)) == 10 and set(first) <= set(books)
    assert ev.sample_ids(shingled, 10, seed=7).collect() != first


def test_sets_move_as_integers(spark, shingled, books):
    sets = similarity.ranked_sets(shingled).collect()
    holders = {}
    for name, items in books.items():
        for item in items:
            holders.setdefault(item, set()).add(name)
    for r in sets:
        assert r.n_shingles == len(books[r.book_id])
        assert len(r.ranks) == sum(len(holders[s]) > 1 for s in books[r.book_id]) and r.ranks == sorted(r.ranks)
    plan = similarity.similar_sets(shingled, 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "shingles#" not in plan.replace("n_shingles", "")


def test_empty_and_lonely_sets(spark):
    frame = spark.createDataFrame([("a", []), ("b", []), ("c", ["x"]), ("d", ["y", "z"])], "book_id string, shingles array<string>")
    assert similarity.similar_sets(frame, 0.5).count() == 0
    pairs = spark.createDataFrame([("a", "b"), ("a", "c"), ("c", "d")], "book_id_1 string, book_id_2 string")
    assert {r.jaccard for r in similarity.exact_pairs(pairs, frame).collect()} == {0.0}


def test_replicas_differ_and_are_near(shingled, books):
    rows = {r.book_id: set(r.shingles) for r in ev.perturbed(shingled, 3).collect()}
    assert len(rows) == 3 * len(books)
    big = max(books, key=lambda b: len(books[b]))
    for name, items in books.items():
        assert rows[f"{name}_0"] == items and len(rows[f"{name}_2"]) == len(items)
    assert any(rows[f"{n}_0"] != rows[f"{n}_1"] for n in books)
    assert jaccard(rows[f"{big}_0"], rows[f"{big}_1"]) > 0.3


def test_scalability_counts_pairs_and_probes(shingled, books):
    table = ev.scalability(shingled, (1, 2), 40, 20, 2, probes=3).collect()
    probes = {f"{r.book_id}_0" for r in ev.sample_ids(shingled, 3, 0).collect()}
    for factor, row in zip((1, 2), table, strict=True):
        grown = {r.book_id: set(r.shingles) for r in ev.perturbed(shingled, factor).collect()}
        found = candidate_pairs({k: signature(v, 40) for k, v in grown.items()}, 20, 2)
        alike = set(true_pairs(grown, 0.5))
        of_probes = lambda pairs: sum((a in probes) + (b in probes) for a, b in pairs)
        assert (row.n_docs, row.n_candidates) == (len(grown), len(found))
        assert row.probe_candidates == of_probes(found) and row.probe_similar == of_probes(alike)
        assert row.probe_found == of_probes(found & alike)
        assert row.probe_saved == 3 * (len(grown) - 1) - row.probe_candidates


def test_best_of_several_experiments(spark):
    rows = [("TN2", "a", 100, 20, 0.5), ("TN1", "a", 100, 20, 0.5), ("TN1", "b", 50, 10, 0.4)]
    table = spark.createDataFrame(rows, "experiment string, config string, n int, b int, f1 double")
    assert ev.best_config(table).first().experiment == "TN1"


def test_shingles_that_the_same_documents_hold_meet_once(spark):
    shared = [f"s{i}" for i in range(30)]
    frame = spark.createDataFrame([("a", [*shared, "x"]), ("b", [*shared, "y"])], "book_id string, shingles array<string>")
    assert similarity._prefixes(similarity.ranked_sets(frame), 0.5).count() == 2
    (row,) = similarity.similar_sets(frame, 0.5).collect()
    assert tuple(row) == ("a", "b", 30 / 32)


def test_sizes_are_counted_without_copies_of_the_sets(monkeypatch, shingled):
    grown, replicate = [], ev.replicate
    monkeypatch.setattr(ev, "replicate", lambda books, n: grown.append(books.columns) or replicate(books, n))
    rows = ev.scaling_counts(shingled, (1, 2), 40, 20, 2).collect()
    assert grown == [["book_id", "copy_key"]] * 2 and [r.size_actual for r in rows] == [r.size_target for r in rows]


def test_sets_that_share_little_are_left_out_before_pairs_meet(spark, monkeypatch):
    """Strangers that hold one common shingle met each other on it in a table of pairs."""
    written, stored = {}, similarity.stored
    rows = [(f"s{i}", ["common", f"a{i}", f"b{i}"]) for i in range(30)] + [("x", ["p", "q", "common"]), ("y", ["p", "q", "r"])]
    frame = spark.createDataFrame(rows, "book_id string, shingles array<string>")

    def counted(df, name):
        table = stored(df, name)
        written.setdefault(name, []).append(table.count())
        return table

    monkeypatch.setattr(similarity, "stored", counted)
    assert [tuple(r) for r in similarity.similar_sets(frame, 0.5).collect()] == [("x", "y", 0.5)]
    assert written["able-sets"] == [2, 2] and written["similar-numbers"] == [1]


def test_overlaps_in_parts_are_overlaps(monkeypatch):
    from itertools import product

    import numpy as np

    from nearkin.functions import overlaps

    rng = random.Random(4)
    sides = [[sorted({rng.randrange(60) for _ in range(rng.choice([0, 3, 20, 40]))}) for _ in range(n)] for n in (23, 31)]
    blocks = [
        overlaps.block_of(*(np.array(v, np.int64) for v in ([len(s) for s in side], [len(s) for s in side], sum(side, []))))
        for side in sides
    ]
    for cells, hits in ((1 << 22, 1 << 22), (40, 7), (1, 1), (500, 100000)):
        monkeypatch.setattr(overlaps, "CELLS_AT_ONCE", cells)
        monkeypatch.setattr(overlaps, "HITS_AT_ONCE", hits)
        for a, b in ((0, 1), (1, 0), (1, 1)):
            got = [t for part in overlaps.similar_between(blocks[a], blocks[b], 0.3) for t in zip(*map(list, part))]
            pairs = product(enumerate(sides[a]), enumerate(sides[b]))
            scored = [(i, j, jaccard(set(x), set(y))) for (i, x), (j, y) in pairs if (x or y) and (a != b or i < j)]
            assert sorted(got) == [t for t in scored if t[2] >= 0.3]


def test_configs_of_one_width_share_an_index(prepared, books, monkeypatch):
    built, build = [], ev.build_lsh_index
    monkeypatch.setattr(ev, "build_lsh_index", lambda s, b, r: built.append((b, r)) or build(s, b, r))
    rows = ev.sweep(prepared, [(10, 5, 2), (40, 20, 2), (40, 10, 4)]).collect()
    assert built == [(20, 2), (10, 4)]
    for row in rows:
        Flags(books, row.n, row.b, row.r).check(row, 4)


def kinds_left(spark):
    """Names of the tables that are in the shared folder now, without owners' folders."""
    import os

    folder = spark.conf.get("spark.checkpoint.dir")
    return {name[:-33] for name in os.listdir(folder) if not name.startswith("owned-")}, [
        name for name in os.listdir(folder) if name.startswith("owned-")
    ]


@pytest.mark.parametrize("values", [150])
def test_similar_sets_in_steps_are_complete(shingled, books, monkeypatch, values):
    """All pairs of blocks were shuffled at one time, which grew with the square of the sets."""
    monkeypatch.setattr(similarity, "STEP_VALUES", values)
    written, stored = [], similarity.stored
    monkeypatch.setattr(similarity, "stored", lambda df, name: written.append(name) or stored(df, name))
    rows = similarity.similar_sets(shingled, 0.3, 3).collect()
    assert {(r.book_id_1, r.book_id_2): r.jaccard for r in rows} == true_pairs(books, 0.3)
    assert len(rows) == len(true_pairs(books, 0.3))
    assert written.count("similar-numbers") > 2 and written.count("shingle-counts") > 2


def test_listed_pairs_leave_no_table_of_sets(spark, shingled, books, monkeypatch):
    from nearkin.plans import similar

    monkeypatch.setattr(similarity, "STEP_VALUES", 150)
    before, owned = kinds_left(spark)
    rows = similar.exact_pairs_above(shingled, 0.3).collect()
    assert {(r.book_id_1, r.book_id_2): r.jaccard for r in rows} == true_pairs(books, 0.3)
    after, owned_after = kinds_left(spark)
    assert not (after - before) & {"keyed", "groups", "able-sets", "shingle-counts"} and owned_after == owned


def test_stored_tables_leave_no_shuffle_files(spark):
    import time

    from nearkin.session import FREE_SHUFFLES, stored

    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        found = files.getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    conf, before = spark.conf.get(FREE_SHUFFLES, None), shuffles()
    table = stored(spark.range(1000).withColumn("key", F.xxhash64("id")).groupBy("key").count(), "grouped")
    until = time.time() + 10
    while shuffles() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffles() - before and table.count() == 1000
    assert spark.conf.get(FREE_SHUFFLES, None) == conf


@pytest.mark.parametrize("values", [30, 1 << 27])
def test_candidate_errors_take_sets_of_pairs_only(spark, shingled, books, monkeypatch, values):
    """All shingles of all sets were ranked and moved; the sets of the pairs are enough."""
    from nearkin.params import LshParams
    from nearkin.plans import similar

    monkeypatch.setattr(similarity, "STEP_VALUES", values)
    monkeypatch.setattr(similarity, "ranked_sets", None)
    before, owned = kinds_left(spark)
    rows = similar.candidate_errors(shingled, LshParams(num_hashes=40, bands=10, rows=4)).collect()
    signed = {k: signature(v, 40) for k, v in books.items()}
    assert sorted((r.book_id_1, r.book_id_2) for r in rows) == sorted(candidate_pairs(signed, 10, 4))
    for r in rows:
        assert r.jaccard == pytest.approx(jaccard(books[r.book_id_1], books[r.book_id_2]))
        assert r.similarity == pytest.approx(estimate(signed[r.book_id_1], signed[r.book_id_2]))
        assert r.error == pytest.approx(abs(r.jaccard - r.similarity))
    after, owned_after = kinds_left(spark)
    assert not (after - before) & {"keyed", "groups", "ranked-sets"} and owned_after == owned


@pytest.mark.parametrize("values", [1, 2000])
def test_metrics_by_steps_of_bands(prepared, books, monkeypatch, values):
    """Every meeting of two sets was shuffled; now weights are added up where pairs meet, some bands at a time."""
    monkeypatch.setattr(ev, "INDEX_STEP_VALUES", values)
    steps, weights = [], ev._band_steps
    monkeypatch.setattr(ev, "_band_steps", lambda n, b: steps.append(weights(n, b)) or steps[-1])
    (row,) = ev.lsh_metrics(prepared, 10, 4).collect()
    Flags(books, 40, 10, 4).check(row)
    assert len(steps[0]) > 1 and [b for low, high in steps[0] for b in range(low, high)] == list(range(10))


def test_scalability_stores_no_sets(spark, shingled, monkeypatch):
    """Sets of all replicas were stored to be compared with a few probes."""
    import os

    written, stored_at = {}, ev.stored_at
    monkeypatch.setattr(ev, "stored_at", lambda df, path: written.setdefault(os.path.basename(path)[:-33], df.columns) and stored_at(df, path))
    before, owned = kinds_left(spark)
    ev.scalability(shingled, (1, 2), 40, 20, 2, probes=3).collect()
    assert written["grown"] == ["book_id", "replica", "signature", "similar"]
    assert [name for name, columns in written.items() if "shingles" in columns] == ["probe-sets"]
    after, owned_after = kinds_left(spark)
    assert not (after - before) & {"shingles", "groups", "bucket-lists", "key-blocks"} and owned_after == owned
