import gzip
import os

import pytest
from pyspark.sql import functions as F
from test_lsh import clustered, pair_set, sigs_frame

from nearkin.functions import text
from nearkin.operators import documents, lookup, lsh
from nearkin.params import LshParams
from nearkin.plans import build, explore
from nearkin.session import get_session, intermediate_tables, scratch_path, shared_folder, stored
from nearkin.sources import catalog, corpus, index_tables, metadata, results

FILES = {
    "pg1.txt": "Castle styria people\nmountains castle",
    "pg22.txt": "other words entirely different\r\nlines",
    "notes.txt": "unnumbered file text",
    "pg3.md": "not read",
}


@pytest.fixture
def folder(tmp_path):
    for name, content in FILES.items():
        (tmp_path / name).write_bytes(content.encode())
    return str(tmp_path)


def test_whole_files(spark, folder):
    raw = corpus.load_raw_books(spark, folder + "/")
    got = {r.path.rsplit("/", 1)[1]: r.content for r in raw.collect()}
    assert got == {k: v for k, v in FILES.items() if k.endswith(".txt")}
    ids = {r.book_id for r in documents.preprocess_books(raw).collect()}
    assert ids == {"pg1", "pg22", ""}


def test_file_stats(spark, folder):
    got = {r.book_id: r for r in explore.file_stats(corpus.load_raw_books(spark, folder)).collect()}
    assert set(got) == {"1", "22", "notes"}
    content = FILES["pg22.txt"]
    assert (got["22"].filename, got["22"].num_lines, got["22"].num_words, got["22"].num_chars) == (
        "pg22.txt", len(content.split("\n")), len(content.split()), len(content),
    )


def test_token_table(spark, tmp_path):
    books = spark.createDataFrame([("a", ["x", "y"])], "book_id string, tokens array<string>")
    path = str(tmp_path / "tokens")
    corpus.write_tokens(books, path)
    back = corpus.write_tokens(books, path)  # written anew, not added to
    assert back.collect() == books.collect() and back.schema == books.schema


def test_search_tables(spark, tmp_path):
    books = clustered()
    params = LshParams(num_hashes=10, bands=5, rows=2)
    sigs = sigs_frame(spark, books, "int")
    index_tables.write_search_tables(sigs, str(tmp_path), params)
    read_sigs, index = index_tables.read_search_tables(spark, str(tmp_path))
    assert index.schema.simpleString() == "struct<book_id:string,band_id:int,bucket_hash:int>"
    assert {r.book_id: r.signature for r in read_sigs.collect()} == books
    assert pair_set(lsh.find_candidate_pairs(index)) == pair_set(
        lsh.find_candidate_pairs(lsh.build_lsh_index(sigs, 5, 2))
    )
    book_id = "b007"
    assert (
        lookup.find_similar_books(read_sigs, index, book_id).collect()
        == lookup.find_similar_books(sigs, lsh.build_lsh_index(sigs, 5, 2), book_id).collect()
    )


def test_id_lookup_reaches_the_scan(spark, tmp_path):
    sigs = sigs_frame(spark, clustered(), "int")
    index_tables.write_search_tables(sigs, str(tmp_path), LshParams(num_hashes=10, bands=5, rows=2))
    read_sigs, index = index_tables.read_search_tables(spark, str(tmp_path))
    plan = lookup.signature_of(read_sigs, "b001")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(book_id,b001)" in plan.split("PushedFilters")[1]


METADATA = 'GutenbergID,Title,Author,Bookshelf,Link\n1,"A, ""quoted"" title",Ann,x,y\n22,Second,,x,y\n'


def test_metadata_file_folder_and_missing(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "part.csv").write_text(METADATA)
    (tmp_path / "m" / "readme.txt").write_text("no table")
    for path in (tmp_path / "m", tmp_path / "m" / "part.csv"):
        got = {r.book_id: (r.Title, r.Author) for r in metadata.load_metadata(spark, str(path)).collect()}
        assert got == {"pg1": ('A, "quoted" title', "Ann"), "pg22": ("Second", None)}
    assert metadata.load_metadata(spark, str(tmp_path / "none")) is None


def test_metadata_columns_go_by_name(spark, tmp_path):
    path = tmp_path / "turned.csv"
    path.write_text('Title,Rating,GutenbergID,Author\n"Two\nlines",5,15,Bo\nNone,4,not a number,Cy\n')
    got = [tuple(r) for r in metadata.load_metadata(spark, str(path)).collect()]
    assert got == [("pg15", "Two\nlines", "Bo"), (None, "None", "Cy")]
    path.write_text("Title,Author\na,b\n")
    with pytest.raises(ValueError, match="GutenbergID"):
        metadata.load_metadata(spark, str(path))


def test_intermediate_tables_go_with_their_owner(spark):
    with intermediate_tables(spark) as folder:
        table = stored(spark.range(5), "owned")
        assert table.inputFiles()[0].removeprefix("file://").startswith(folder.removeprefix("file:"))
        assert table.count() == 5 and os.path.isdir(folder)
    assert not os.path.exists(folder)
    assert not stored(spark.range(1), "free").inputFiles()[0].startswith(folder)


def test_a_session_without_a_shared_folder_is_an_error():
    class Conf:
        def get(self, name, default=None):
            return default

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())


CATALOG = [
    ("10", "Text", "Science Fiction; Adventure", "en"),
    ("9", "Text", "SCIENCE FICTION", "en; fr"),
    ("2", "Sound", "Science Fiction", "en"),
    ("3", "Text", "science fiction", "fr"),
    ("4", "Text", "Detective Fiction", "en"),
    ("5", "Text", "", "en"),
    ("6", "Text", "Best of Science Fiction (new)", "EN"),
]


@pytest.fixture
def books_catalog(spark, tmp_path):
    path = tmp_path / "catalog.csv.gz"
    lines = ["Text#,Type,Issued,Title,Language,Authors,Subjects,LoCC,Bookshelves"]
    lines += [f'{n},{kind},,"Line one\nline two",{lang},,,,{shelf}' for n, kind, shelf, lang in CATALOG]
    with gzip.open(path, "wt") as f:
        f.write("\n".join(lines))
    return catalog.load_catalog(spark, str(path))


def test_catalog_selection(spark, books_catalog):
    assert books_catalog.where("Issued = '' and Title = 'Line one\nline two'").count() == len(CATALOG)
    ids = lambda df: [r["Text#"] for r in df.collect()]
    assert ids(catalog.select_bookshelf(books_catalog, "science fiction")) == ["6", "9", "10"]
    assert ids(catalog.select_bookshelf(books_catalog, "Science Fiction", 2)) == ["6", "9"]
    assert ids(catalog.select_bookshelf(books_catalog, "(new)", language="en")) == ["6"]
    assert ids(catalog.select_bookshelf(books_catalog, "detective|adventure", pattern=True)) == ["4", "10"]
    assert ids(catalog.select_bookshelf(books_catalog, "detective|adventure")) == []
    many = catalog.select_bookshelves(books_catalog, ["Science Fiction", "Fiction", "None"], 2)
    got = {(r.shelf, r["Text#"]) for r in many.collect()}
    assert got == {("Science Fiction", "6"), ("Science Fiction", "9"), ("Fiction", "4"), ("Fiction", "6")}


def test_results_table(spark, tmp_path):
    one = spark.createDataFrame([(1, 0.5)], "n int, f1 double")
    two = spark.createDataFrame([("LSH", 0.25)], "method string, f1 double")
    table = results.tagged_union({"TN1": one, "TN4": two})
    assert [tuple(r) for r in table.orderBy("experiment").collect()] == [
        ("TN1", 1, 0.5, None), ("TN4", None, 0.25, "LSH"),
    ]
    results.write_results(table, str(tmp_path / "r"))
    back = results.read_results(spark, str(tmp_path / "r"), table.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, table.collect()))


def test_session_folder(spark):
    assert get_session() is spark
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert scratch_path(spark, "x").startswith(folder) and scratch_path(spark, "x") != scratch_path(spark, "x")
    kept = stored(spark.range(3), "three")
    assert sorted(r.id for r in kept.collect()) == [0, 1, 2]
    assert folder.rstrip("/") in kept.inputFiles()[0]


def stats_frame(spark, *words):
    rows = [(f"b{i}", w, w and w * 5) for i, w in enumerate(words)]
    return spark.createDataFrame(rows, "book_id string, num_words int, num_chars int")


def test_corpus_summary(spark):
    table = stats_frame(spark, 1, 2, 4, None)
    got = {r.measure: tuple(r)[1:] for r in explore.corpus_summary(table, ["num_words", "num_chars"]).collect()}
    assert got == {"num_words": (3, 7, 2.333, 1, 4), "num_chars": (3, 35, 11.667, 5, 20)}


def test_histogram(spark):
    import numpy as np

    for words in ([1, 2, 2, 9, 31, 31], [5, 5], list(range(100)), [0, 7]):
        counts, edges = np.histogram(words, bins=30)
        rows = explore.word_histogram(stats_frame(spark, *words)).orderBy("bin").collect()
        assert [r.n_docs for r in rows] == counts.tolist()
        assert [r.bin_start for r in rows] == pytest.approx(edges[:-1].tolist())
        assert rows[-1].bin_end == pytest.approx(edges[-1])


def test_effects_of_cleaning(spark):
    books = spark.createDataFrame(
        [("a", "The  “castle”\n\n the Castle"), ("b", "")], "book_id string, content string"
    )
    a, b = explore.cleaning_effect(books).orderBy("book_id").collect()
    raw, clean = "The  “castle”\n\n the Castle", "The castle the Castle"
    assert (a.raw_chars, a.cleaned_chars, a.raw_words, a.cleaned_words) == (len(raw), len(clean), 4, 4)
    assert a.reduction_pct == pytest.approx((1 - len(clean) / len(raw)) * 100)
    assert (b.raw_chars, b.cleaned_chars, b.reduction_pct) == (0, 0, 0.0)
    a, b = explore.stop_word_effect(books).orderBy("book_id").collect()
    assert (a.raw_tokens, a.unique_tokens, a.kept_tokens, a.removed_pct) == (4, 2, 2, 50.0)
    assert (b.raw_tokens, b.unique_tokens, b.kept_tokens, b.removed_pct) == (0, 0, 0, 0.0)


def test_top_and_stage_counts(spark):
    stats = stats_frame(spark, 3, 9, 9, 1)
    assert [r.book_id for r in explore.top_by(stats, "num_words", 3).collect()] == ["b1", "b2", "b0"]
    rows = explore.stage_counts({"all": stats, "few": stats.where(F.col("num_words") > 5)}).collect()
    assert {r.stage: r.n_rows for r in rows} == {"all": 4, "few": 2}


def test_both_tables_are_one_version(spark, tmp_path, monkeypatch):
    params, folder = LshParams(num_hashes=10, bands=5, rows=2), str(tmp_path / "tables")
    with pytest.raises(ValueError, match="no search tables"):
        index_tables.read_search_tables(spark, folder)
    sigs = sigs_frame(spark, clustered(), "int")
    assert index_tables.write_search_tables(sigs, folder, params) == 1
    few = sigs.where("book_id < 'b010'")
    assert index_tables.write_search_tables(few, folder, params) == 2
    signatures, index = index_tables.read_search_tables(spark, folder)
    assert signatures.count() == 10 and index.select("book_id").distinct().count() == 10
    old, old_index = index_tables.read_search_tables(spark, folder, version=1)
    assert old.count() == 60 and old_index.select("book_id").distinct().count() == 60

    def broken(index, path):
        raise RuntimeError("lost")

    monkeypatch.setattr(index_tables, "write_index", broken)
    with pytest.raises(RuntimeError):
        index_tables.write_search_tables(sigs.limit(3), folder, params)
    assert index_tables.read_search_tables(spark, folder)[0].count() == 10
    index_tables.drop_versions(spark, folder)
    assert index_tables.read_search_tables(spark, folder)[0].count() == 10
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        index_tables.read_search_tables(spark, folder, version=1)[0].count()


def test_tables_compute_each_row_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    sigs = sigs_frame(spark, clustered(), "int").mapInArrow(counted, "book_id string, signature array<int>")
    index_tables.write_search_tables(sigs, str(tmp_path), LshParams(num_hashes=10, bands=5, rows=2))
    assert seen.value == 60


def test_from_a_folder_of_texts_to_search_tables(spark, tmp_path):
    texts = {f"pg{i}": " ".join(f"word{chr(97 + (i // 2 + j) % 26)}{chr(97 + j % 26)}" for j in range(60)) for i in range(6)}
    (tmp_path / "raw").mkdir()
    for name, content in texts.items():
        (tmp_path / "raw" / f"{name}.txt").write_text(content)
    (tmp_path / "raw" / "other.md").write_text("not a book")
    params = LshParams(num_hashes=20, bands=10, rows=2)
    assert build.build_search_tables(spark, str(tmp_path / "raw"), str(tmp_path / "out"), params) == 1
    tables = index_tables.read_search_tables(spark, str(tmp_path / "out"))
    assert {r.book_id for r in tables[0].select("book_id").collect()} == set(texts)
    assert lookup.find_similar_books(*tables, "pg2", params=params).first().book_id == "pg3"


LONG_FILES = {
    "pg1.txt": "".join(f"front {i}\n" for i in range(120)) + "*** START OF this\nbody\r\nmore\x0bsplit\u2028again\n\nEnd of the Project\nrest\n",
    "pg2.txt": "no marker at all\nsecond line",
    "pg3.txt": "",
    "pg4.txt": "*** start of it\n" + "".join(f"line {i}\r\n" for i in range(300)) + "END OF THE PROJECT GUTENBERG\nx\r",
    "pg5.txt": "one\rtwo\r\nthree\n\n\n",
}


@pytest.mark.parametrize("split_bytes", ["256", "1m"])
def test_files_read_by_lines_equal_whole_files(spark, tmp_path, split_bytes):
    for name, content in LONG_FILES.items():
        (tmp_path / name).write_bytes(content.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        stripped = documents.strip_lines(corpus.load_lines(spark, str(tmp_path)))
        got = {}
        for r in stripped.orderBy("path", "line_no").collect():
            got.setdefault(r.path.rpartition("/")[2], []).append(r.line)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    whole = corpus.load_raw_books(spark, str(tmp_path)).select("path", text.strip_boilerplate(F.col("content")).alias("body"))
    for r in whole.collect():
        assert "\n".join(got.get(r.path.rpartition("/")[2], [])) == r.body, r.path


def test_shelves_out_of_a_table(spark, books_catalog):
    names = ["Science Fiction", "Fiction", "None", "fi", "N", "", "(new)", "science fiction ", "ction; adv", "absent shelf"]
    table = spark.createDataFrame([(n,) for n in [*names, "Fiction", None]], "shelf string")
    for per_shelf in (1, 30):
        many = catalog.select_bookshelves(books_catalog, names, per_shelf)
        want = sorted((r.shelf, r["Text#"]) for r in many.collect())
        got = sorted((r.shelf, r["Text#"]) for r in catalog.select_by_shelf_table(books_catalog, table, per_shelf).collect())
        assert got == want


def test_ten_thousand_shelves(spark):
    shelves = spark.range(10_000).select(F.concat(F.lit("shelf "), "id").alias("shelf"))
    books = spark.range(3_000).select(
        F.col("id").cast("string").alias("Text#"), F.lit("Text").alias("Type"), F.lit("en").alias("Language"),
        F.concat(F.lit("Old Shelf "), F.col("id"), F.lit("; Shelf "), F.col("id") * 7 % 3_000).alias("Bookshelves"),
    )
    got = catalog.select_by_shelf_table(books, shelves, per_shelf=100).groupBy("shelf").count()
    counts = {r.shelf: r["count"] for r in got.collect()}
    of = lambda name: sum(name in f"old shelf {i}; shelf {i * 7 % 3_000}" for i in range(3_000))
    assert len(counts) == 3_000
    assert all(counts[f"shelf {i}"] == min(100, of(f"shelf {i}")) for i in (0, 5, 29, 299, 2_999))
