"""Selecting books from a catalogue table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nearkin.operators.pairing import join_counted
from nearkin.session import stored
from nearkin.sources.csv_columns import read_named

# Fixed value: columns of the catalogue file.
CATALOG_COLUMNS = (
    "Text#", "Type", "Issued", "Title", "Language", "Authors", "Subjects", "LoCC", "Bookshelves",
)


def load_catalog(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings, missing values as ``""``. Compressed CSV is read as it is."""
    return read_named(spark, path, CATALOG_COLUMNS).na.fill("")


def _holds(column: str, wanted: Column, pattern: bool = False) -> Column:
    """Whether a column holds a text, or fits a pattern, in either case."""
    if pattern:
        return F.regexp_like(F.col(column), F.concat(F.lit("(?i)"), wanted))
    return F.lower(F.col(column)).contains(F.lower(wanted))


def _texts(catalog: DataFrame, language: str) -> DataFrame:
    return catalog.where((F.col("Type") == "Text") & _holds("Language", F.lit(language)))


def _by_number() -> list[Column]:
    return [F.expr("try_cast(`Text#` AS bigint)"), F.col("Text#")]


def select_bookshelf(
    catalog: DataFrame, shelf: str, max_books: int = 30, language: str = "en", pattern: bool = False
) -> DataFrame:
    """The first ``max_books`` texts, by number, on a shelf whose name holds ``shelf``.

    With ``pattern``, ``shelf`` is a regular expression: ``"Fiction|Poetry"``.
    """
    return (
        _texts(catalog, language)
        .where(_holds("Bookshelves", F.lit(shelf), pattern))
        .orderBy(*_by_number())
        .limit(max_books)
    )


def select_bookshelves(
    catalog: DataFrame, shelves: list[str], per_shelf: int = 30, language: str = "en"
) -> DataFrame:
    """The first ``per_shelf`` texts of every shelf in one job, with the asked name as ``shelf``.

    A book may stand on several shelves. The rank filter limits each shelf before the shuffle.
    """
    fitting = F.filter(
        F.array(*[F.lit(s) for s in shelves]), lambda shelf: _holds("Bookshelves", shelf)
    )
    first = Window.partitionBy("shelf").orderBy(*_by_number())
    return (
        _texts(catalog, language)
        .withColumn("shelf", F.explode(fitting))
        .withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") <= per_shelf)
        .drop("_rank")
    )


# Characters of the pieces by which shelf names meet what the catalogue says.
GRAM = 3


def _grams(text: Column) -> Column:
    """All distinct runs of GRAM characters, and the shorter runs that names of less can be."""
    def runs(n: int) -> Column:
        places = F.sequence(F.lit(1), F.char_length(text) - n + 1)
        return F.when(F.char_length(text) >= n, F.transform(places, lambda i: F.substring(text, i, F.lit(n)))).otherwise(
            F.array().cast("array<string>")
        )

    return F.array_distinct(F.concat(F.array(F.lit("")), *[runs(n) for n in range(1, GRAM + 1)]))


def _own_grams(name: Column) -> Column:
    """The runs of GRAM characters of a name, or the whole name if it has fewer."""
    places = F.sequence(F.lit(1), F.greatest(F.char_length(name) - GRAM + 1, F.lit(1)))
    return F.array_distinct(F.transform(places, lambda i: F.substring(name, i, F.lit(GRAM))))


def shelf_matches(catalog: DataFrame, shelves: DataFrame) -> DataFrame:
    """``shelf, Bookshelves``: which different entries of the catalogue hold which names of a table.

    ``shelves (shelf)`` may be as long as it likes. Every name is looked up under the one of its
    pieces that the fewest entries have, and what meets there is compared as a whole, in lower
    case. An empty name is held by all.
    """
    entries = stored(catalog.select("Bookshelves").distinct().withColumn("_low", F.lower("Bookshelves")), "entries")
    pieces = entries.select("Bookshelves", "_low", F.explode(_grams(F.col("_low"))).alias("gram"))
    counts = stored(pieces.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "gram-counts")
    names = stored(shelves.select("shelf").where(F.col("shelf").isNotNull()).distinct().withColumn("_name", F.lower("shelf")), "shelves")
    own = names.select("shelf", "_name", F.explode(_own_grams(F.col("_name"))).alias("gram"))
    asked = stored(own.groupBy("gram").agg(F.count(F.lit(1)).alias("n_asked")), "asked-grams")
    known = join_counted(own, asked, ["gram"], "n_asked").drop("n_asked").join(counts, "gram")
    # A name with a piece that no entry has is held by none, but is looked up all the same.
    rarest = known.groupBy("shelf", "_name").agg(F.min(F.struct("n", "gram")).alias("r")).select("shelf", "_name", "r.gram")
    entry_counts = counts.join(rarest.select("gram").distinct(), "gram", "left_semi")
    met = join_counted(pieces, stored(entry_counts, "looked-up-grams"), ["gram"], "n").drop("n").join(rarest, "gram")
    return met.where(F.contains("_low", "_name")).select("shelf", "Bookshelves")


def select_by_shelf_table(
    catalog: DataFrame, shelves: DataFrame, per_shelf: int = 30, language: str = "en"
) -> DataFrame:
    """``select_bookshelves`` for a table of names ``shelves (shelf)``, each name once.

    Only texts in the language are looked at. The rank filter limits each shelf before the shuffle.
    """
    texts = _texts(catalog, language)
    entries = shelf_matches(texts, shelves).groupBy("Bookshelves").agg(F.collect_list("shelf").alias("_shelves"))
    first = Window.partitionBy("shelf").orderBy(*_by_number())
    return (
        texts.join(entries, "Bookshelves")
        .withColumn("shelf", F.explode("_shelves"))
        .withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") <= per_shelf)
        .drop("_rank", "_shelves")
    )
