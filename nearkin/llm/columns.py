"""Columns that several operators use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_or_empty(name: str) -> Column:
    """The text, empty where there is none."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
