"""Self-joins on a key that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.session import stored

# Members of one key that meet the members of another block in one join group. The work of a
# group is at most the square of this, whatever the size of the key.
BLOCK_ROWS = 4096
# A key that more than this share of an even partition's rows have is dealt over several.
HOT_SHARE = 0.25


def key_sizes(rows: DataFrame, keys: Sequence[str], size: str) -> DataFrame:
    """Keys with more than one row, and their row counts. Counted before the shuffle."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(size)).where(F.col(size) > 1)


def join_counted(rows: DataFrame, counted: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    """Inner join of ``rows`` with one row per key, without a hot key's rows meeting in one task.

    ``counted`` is stored and says in ``count`` how many of ``rows`` have each of its keys. A key
    with more than HOT_SHARE of an even partition's rows gets a salt for each such share. That is
    done on the map side, before any shuffle on the key: at most partitions / HOT_SHARE keys can
    be so hot, whatever the data, so they are broadcast to ``rows``, whose other columns choose
    the salt; in ``counted`` a hot key stands once for each salt.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counted.agg(F.sum(count)).first()[0] or 0
    limit = max(1.0, HOT_SHARE * total / partitions)
    salts = F.ceil(F.col(count) / limit).cast("int")
    hot = counted.where(F.col(count) > limit).select(*keys, salts.alias("_salts"))
    others = [c for c in rows.columns if c not in keys]
    chosen = F.pmod(F.xxhash64(*others), F.col("_salts"))
    salted = (
        rows.join(F.broadcast(hot), list(keys), "left")
        .withColumn("_salt", F.coalesce(chosen, F.lit(0)).cast("int"))
        .drop("_salts")
    )
    last = F.when(F.col(count) > limit, salts - 1).otherwise(F.lit(0))
    spread = counted.withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
    return salted.join(spread, [*keys, "_salt"]).drop("_salt")


def pairs_sharing_key(
    rows: DataFrame,
    keys: Sequence[str],
    id_col: str,
    carried: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Pairs of rows with equal ``keys`` and different ids, the smaller id first.

    Gives ``<id>_1, <id>_2`` and ``<carried>_1, <carried>_2`` once per shared key. Rows alone
    under their key leave before the pair join; the others are stored with the size of their
    key. A key with ``c`` rows is cut into ``ceil(c / block_rows)`` blocks by a hash of the id,
    and every two blocks meet in a join group of their own, so that a hot key is spread over
    many tasks. No pair is left out.
    """
    sizes = stored(key_sizes(rows, keys, "_size"), "key-sizes")
    blocked = stored(
        join_counted(rows.select(*keys, id_col, *carried_only(carried, keys, id_col)), sizes, keys, "_size")
        .withColumn("_blocks", F.ceil(F.col("_size") / block_rows).cast("int"))
        .withColumn("_block", F.pmod(F.xxhash64(id_col), F.col("_blocks")).cast("int"))
        .drop("_size"),
        "key-blocks",
    )

    def side(number: int, low, high) -> DataFrame:
        return blocked.select(
            *keys,
            *[F.col(c).alias(f"{c}_{number}") for c in (id_col, *carried)],
            low.alias("_low"),
            high.alias("_high"),
        )

    block, last = F.col("_block"), F.col("_blocks") - 1
    first = side(1, block, F.explode(F.sequence(block, last)))
    second = side(2, F.explode(F.sequence(F.lit(0), block)), block)
    one, two = F.col(f"{id_col}_1"), F.col(f"{id_col}_2")
    met = first.join(second, [*keys, "_low", "_high"]).where(
        # Within a block both orders meet, across blocks only one does.
        ((F.col("_low") == F.col("_high")) & (one < two))
        | ((F.col("_low") < F.col("_high")) & (one != two))
    )
    ordered = [
        F.when(one < two, F.col(f"{c}_{a}")).otherwise(F.col(f"{c}_{b}")).alias(f"{c}_{a}")
        for a, b in ((1, 2), (2, 1))
        for c in (id_col, *carried)
    ]
    return met.select(*ordered)


def carried_only(carried: Sequence[str], keys: Sequence[str], id_col: str) -> list[str]:
    """The carried columns that are neither a key nor the id."""
    return [c for c in carried if c not in keys and c != id_col]


def matches_on_key(
    left: DataFrame, right: DataFrame, keys: Sequence[str], block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Inner equi-join of two frames whose keys may both be hot.

    ``left`` and ``right`` share no column but the keys. A key with ``m`` and ``n`` rows is cut
    into a grid of blocks; each block of one side meets each block of the other.
    """
    counts = [
        side.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
        for side, name in ((left, "_nl"), (right, "_nr"))
    ]
    grid = stored(
        counts[0].join(counts[1], list(keys)).select(
            *keys,
            "_nl",
            "_nr",
            F.ceil(F.col("_nl") / block_rows).cast("int").alias("_bl"),
            F.ceil(F.col("_nr") / block_rows).cast("int").alias("_br"),
        ),
        "key-grid",
    )

    def blocks(side: DataFrame, count: str, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        spread = F.pmod(F.xxhash64(*[c for c in side.columns if c not in keys]), F.col(own))
        return join_counted(side, grid, keys, count).select(
            *side.columns,
            spread.cast("int").alias(mine),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(theirs),
        )

    return (
        blocks(left, "_nl", "_bl", "_br", "_i", "_j")
        .join(blocks(right, "_nr", "_br", "_bl", "_j", "_i"), [*keys, "_i", "_j"])
        .drop("_i", "_j")
    )
