"""Titles and authors from CSV, and their join to search results."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.session import stored
from nearkin.sources.csv_columns import read_named

# Fixed value: the columns of the metadata file that are used.
METADATA_COLUMNS = ("GutenbergID", "Title", "Author")


def load_metadata(spark: SparkSession, path: str) -> DataFrame | None:
    """``(book_id, Title, Author)`` of one CSV file or of a folder of them; None if missing."""
    try:
        table = read_named(spark, path, METADATA_COLUMNS, pathGlobFilter="*.csv")
    except AnalysisException:
        return None
    number = F.expr("try_cast(GutenbergID AS bigint)")
    return metadata_by_id(table.withColumn("GutenbergID", number))


def metadata_by_id(table: DataFrame) -> DataFrame:
    """Ids as documents carry them: ``17135`` -> ``pg17135``."""
    book_id = F.concat(F.lit("pg"), F.col("GutenbergID").cast("string"))
    return table.select(book_id.alias("book_id"), "Title", "Author")


def enrich(result: DataFrame, metadata: DataFrame | None) -> DataFrame:
    """Add the metadata columns, null where unknown, and keep the best-first order.

    Without metadata the result is returned as it is. Otherwise it is stored, so that the search
    runs once, and its ids cut the metadata down before the outer join, which then moves no more
    rows than the result has.
    """
    if metadata is None:
        return result
    hits = stored(result, "hits")
    wanted = metadata.join(hits.select("book_id"), "book_id", "left_semi")
    return hits.join(wanted, "book_id", "left").orderBy(F.desc("similarity"), "book_id")
