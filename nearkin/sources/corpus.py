"""Raw text files and the token table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nearkin.functions.text import LINE_END
from nearkin.session import stored


def load_raw_books(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """``(path, content)``, one row per file of ``folder`` whose name fits ``pattern``."""
    files = spark.read.text(f"{folder.rstrip('/')}/{pattern}", wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def load_lines(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """``path, line_no, line`` of all files, stored: lines from 0, as ``text_lines`` would part the whole file.

    Files are read in splits, so a text of any size is many rows in many tasks. What is read of a
    split is in order; the line feeds of the splits before give the number of its first line.
    A file that ends without a line feed has no empty line at its end.
    """
    read = spark.read.option("lineSep", "\n").text(f"{folder.rstrip('/')}/{pattern}")
    split = F.struct(F.col("_metadata.file_block_start").alias("start"))
    placed = stored(
        read.select(
            F.col("_metadata.file_path").alias("path"), split["start"].alias("start"),
            F.monotonically_increasing_id().alias("place"), F.col("value"),
        ),
        "split-lines",
    )
    # Other line ends than the line feed stand within what was read; a return may stand before one.
    whole = F.regexp_replace("value", "\\r$", "")
    parts = F.split(whole, LINE_END, -1)
    counted = placed.withColumn("n_parts", F.size(parts))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("path", "start").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    splits = counted.groupBy("path", "start").agg(F.sum("n_parts").alias("n"))
    firsts = splits.select("path", "start", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    numbered = counted.withColumn("in_split", F.coalesce(F.sum("n_parts").over(inside), F.lit(0))).join(firsts, ["path", "start"])
    return stored(
        numbered.select("path", (F.col("first") + F.col("in_split")).alias("at"), F.posexplode(parts).alias("i", "line"))
        .select("path", (F.col("at") + F.col("i")).alias("line_no"), "line"),
        "lines",
    )


def write_tokens(tokens: DataFrame, path: str) -> DataFrame:
    """Write ``(book_id, tokens)`` as Parquet and return the table read back."""
    tokens.write.mode("overwrite").parquet(path)
    return read_table(tokens.sparkSession, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)

