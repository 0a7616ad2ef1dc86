"""CSV columns by their names in the header."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_named(spark: SparkSession, path: str, columns: Sequence[str], **options) -> DataFrame:
    """``columns`` as strings, wherever they stand in the file; quoted fields may hold line ends.

    Other columns are left out; one that the header lacks is an error.
    """
    table = spark.read.csv(path, header=True, multiLine=True, escape='"', **options)
    missing = [c for c in columns if c not in table.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; it has {', '.join(table.columns)}")
    return table.select(*[_named(c) for c in columns])


def _named(column: str) -> Column:
    return F.col(f"`{column}`").cast("string").alias(column)
