"""Logged conversations: snapshots that a longer one begins with are dropped, the rest rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turns that one task adds up before chunks of a conversation are put together.
CHUNK_TURNS = 256
#: Seeds of the lanes of a turn's hash; every lane has 31 bits, so that sums stay exact.
LANES = (11, 23, 37, 53)
KEY = ["n_turns", *[f"lane{i}" for i in range(len(LANES))]]


def _lanes(*columns: Column) -> list[Column]:
    return [
        F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit((1 << 31) - 1)).alias(f"lane{i}") for i, seed in enumerate(LANES)
    ]


def prefix_hashes(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn`` and the count and hash of all turns up to it, by a rolling sum.

    A turn's hash covers its number, role and text, so the sum does not depend on how it was
    added up: chunks of a long conversation are summed apart and then moved by the chunks before.
    Turns of equal number count together.
    """
    turns = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.floor(F.col("turn") / CHUNK_TURNS), F.lit(-1)).alias("chunk"),
        F.lit(1).cast("long").alias("n_turns"),
        *_lanes(
            F.coalesce(F.col("turn").cast("long"), F.lit(-1)),
            F.coalesce(F.col("role").cast("string"), F.lit("")),
            F.col("text").isNull(),
            F.coalesce(F.col("text").cast("string"), F.lit("")),
        ),
    )
    # Equal numbers first meet in one row, which also bounds what a window holds.
    sums = [F.sum(c).alias(c) for c in KEY]
    steps = turns.groupBy("conv_id", "chunk", "turn").agg(*sums)
    inside = Window.partitionBy("conv_id", "chunk").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = steps.groupBy("conv_id", "chunk").agg(*sums)
    before = chunks.select(
        F.col("conv_id").alias("_conv"), F.col("chunk").alias("_chunk"),
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}") for c in KEY],
    )
    rolled = steps.select("conv_id", "chunk", "turn", *[F.sum(c).over(inside).alias(c) for c in KEY])
    same = rolled["conv_id"].eqNullSafe(before["_conv"]) & (rolled["chunk"] == before["_chunk"])
    return rolled.join(before, same).select("conv_id", "turn", *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in KEY])


def maximal(conversations: DataFrame) -> DataFrame:
    """``conv_id, n_turns`` of the conversations that no longer one begins with, one of equal ones."""
    rolling = prefix_hashes(conversations)
    named = F.coalesce(F.col("turn"), F.lit(-1))
    whole = rolling.groupBy("conv_id").agg(F.max_by(F.struct(*KEY), named).alias("key")).select("conv_id", "key.*")
    # A prefix that many conversations share, such as a greeting, is one row.
    is_whole = whole.select(F.col("conv_id").alias("_conv"), F.col("n_turns").alias("_n"))
    proper = (
        rolling.join(is_whole, F.col("conv_id").eqNullSafe(F.col("_conv")))
        .filter("n_turns < _n").select(*KEY).distinct()
    )
    # Equal conversations are one row: the smallest id, nulls last.
    kept = whole.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"))
    return kept.join(proper, KEY, "left_anti").select("conv_id", "n_turns")


def rendered(conversations: DataFrame) -> DataFrame:
    """``conv_id, n_turns, rendered`` of the maximal conversations, turns in order.

    A turn is ``<|role|>``, a line feed, its text, and a line feed. Columns other than
    ``conv_id, turn, role, text`` are left out. Null roles and texts are empty text, null turns
    come first, turns of equal number go by role and text; rows without ``conv_id`` are one
    conversation; an empty table gives an empty one.
    """
    found = maximal(conversations).select(F.col("conv_id").alias("_conv"), "n_turns")
    turns = conversations.join(found, conversations["conv_id"].eqNullSafe(found["_conv"])).select(
        "conv_id",
        "n_turns",
        F.struct(
            F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    line = F.transform(
        F.sort_array(F.collect_list("t")),
        lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit("\n")),
    )
    return turns.groupBy("conv_id", "n_turns").agg(F.array_join(line, "").alias("rendered"))
