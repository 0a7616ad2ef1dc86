"""Compute an intermediate value once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often ``body`` uses it.

    Catalyst may inline a column into every place that mentions it; a lambda variable
    cannot be inlined, so an expensive value (a tokenised text) stays computed once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def with_computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``value`` as a column that filters further up do not compute a second time.

    A filter on a projected column is pushed below the projection and takes a copy of its
    expression along. It is not pushed below a generator, here one of a single row.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))
