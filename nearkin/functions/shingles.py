"""Word k-shingles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from nearkin.functions.binding import let


def word_shingles(words: Column, k: int) -> Column:
    """Distinct runs of ``k`` consecutive words joined by a space; null below ``k`` words."""

    def windows(tokens: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(tokens) - k)
        joined = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i + 1, k), " "))
        return F.when(F.size(tokens) >= k, F.array_distinct(joined))

    return let(words, windows)


def exact_jaccard(left: Column, right: Column) -> Column:
    """Shared over united elements of two sets; 0 when both are empty."""
    shared = F.size(F.array_intersect(left, right))
    return jaccard_from_counts(shared, F.size(left), F.size(right))


def jaccard_from_counts(shared: Column, size_left: Column, size_right: Column) -> Column:
    union = size_left + size_right - shared
    return F.when(union > 0, shared / union).otherwise(F.lit(0.0))
