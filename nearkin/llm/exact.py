"""Exact duplicates against a persistent index of text digests, load after load.

The index is a Parquet folder of one row per different text, bucketed and sorted by the SHA-256 of
the text after white space is made even. A load brings its own digests into the same buckets, so
that the anti-join with the index moves only the load, and appends what the index does not have.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.llm.columns import free_name, text_or_empty
from nearkin.session import scratch_path, stored

WHITE_RUN = r"[\x20\x09-\x0D]+"
#: Loads that ``deduplicated`` feeds one table in, in order of the ids.
LOADS = 3
#: A text with more than this share of a partition's rows is joined by a broadcast of such texts.
HOT_SHARE = 0.25


def normalised(text: Column) -> Column:
    """The text with every run of white space as one space."""
    return F.regexp_replace(text, WHITE_RUN, " ")


def with_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, digest`` of every row; a null text is empty. Digests have 32 bytes."""
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.unhex(F.sha2(normalised(text_or_empty(text_col)), 256)).alias("digest")
    )


def _earlier_first(*order: str) -> Column:
    """Smaller values first and nulls last, as one value to take the minimum of."""
    return F.struct(*[c for name in order for c in (F.col(name).isNull().alias(f"{name}_null"), F.col(name))])


def _firsts(rows: DataFrame) -> DataFrame:
    """``digest, keep_id, keep_row``: of the equal texts the smallest id, then the smallest row, null ids last.

    A map-side combine comes before the shuffle, so a text that most rows have is one row a task.
    """
    first = F.min(_earlier_first("doc_id", "row")).alias("first")
    return rows.groupBy("digest").agg(first).select(
        "digest", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row")
    )


class DigestIndex:
    """``digest, keep_id, keep_row, load`` of every different text, bucketed and sorted by digest.

    The folder is all there is to keep: opening it registers a table over it under a name of its
    own. ``buckets`` must be the number that the folder was made with.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int, id_type: str = "bigint"):
        self.spark, self.path, self.buckets, self.id_type = spark, path, buckets, id_type
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id {id_type}, keep_row BIGINT, `load` STRING) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def rows(self) -> DataFrame:
        """The index as it is now."""
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def add(self, rows: DataFrame, load: str) -> None:
        """Append the texts of a load that the index does not have.

        ``rows`` is stored and has ``doc_id, row, digest``; ``row`` tells rows apart. Only one row
        a text is shuffled, into the index's buckets. A load that broke off may be given again
        under its name: what it had entered stays as it is.
        """
        firsts = _firsts(rows).repartition(self.buckets, "digest")
        known = self.rows().select("digest").hint("merge")
        fresh = firsts.join(known, "digest", "left_anti").withColumn("load", F.lit(load))
        (
            fresh.select("digest", "keep_id", "keep_row", "load")
            .write.format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
            .option("path", self.path).mode("append").saveAsTable(self.table)
        )

    def close(self) -> None:
        """Forget the table's name; the folder stays."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def verdicts(rows: DataFrame, index: DigestIndex, load: str | None = None) -> DataFrame:
    """``rows`` with ``keep_id, keep_load, group_size, kept``: which row of the index each one equals.

    ``rows`` is stored and has ``doc_id, row, digest`` and, unless one ``load`` is named for all,
    ``load``; all have been added. ``group_size`` counts the equal texts among ``rows``. Texts that
    more than HOT_SHARE of a partition's rows have number at most partitions / HOT_SHARE, whatever
    the table, and are joined by broadcast; the others meet their group in a sort-merge join.
    """
    spark = rows.sparkSession
    own = rows if load is None else rows.withColumn("load", F.lit(load))
    sizes = rows.groupBy("digest").agg(F.count("*").alias("group_size")).repartition(index.buckets, "digest")
    named = index.rows().select("digest", "keep_id", "keep_row", F.col("load").alias("keep_load"))
    groups = stored(sizes.join(named.hint("merge"), "digest"), "exact-groups")
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = F.col("group_size") > max(1.0, HOT_SHARE * total / partitions)
    often = F.broadcast(groups.filter(hot))
    usual = groups.filter(~hot)
    joined = own.join(often, "digest").unionByName(
        own.join(F.broadcast(groups.filter(hot).select("digest")), "digest", "left_anti").join(usual, "digest")
    )
    return joined.withColumn("kept", (F.col("row") == F.col("keep_row")) & (F.col("load") == F.col("keep_load"))).drop("keep_row")


def _bounds(rows: DataFrame, loads: int) -> list[int]:
    """Ids that part the rows into ``loads`` ranges of about equal counts."""
    if loads < 2 or dict(rows.dtypes)["doc_id"] not in ("tinyint", "smallint", "int", "bigint"):
        return []
    shares = [i / loads for i in range(1, loads)]
    found = rows.agg(F.percentile_approx("doc_id", shares, F.lit(1000))).first()[0]
    return sorted(set(found or []))


def deduplicated(
    docs: DataFrame, path: str | None = None, loads: int = LOADS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row, by loads into one index.

    The rows go into a new index in ``loads`` ranges of ids, the smallest first, so that of equal
    texts the row of the smallest id stays; of rows that repeat an id and a text exactly one
    stays. ``keep_id`` is the id of the row that stays. Null ids come last, null texts are empty,
    long texts count as a whole, an empty table gives an empty one, other columns are left out.
    """
    spark = docs.sparkSession
    rows = stored(
        with_digests(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "exact-digests"
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    # One bucket a shuffle partition, so that neither side of the joins moves again.
    index = DigestIndex(
        spark, path or scratch_path(spark, "exact-index"), int(spark.conf.get("spark.sql.shuffle.partitions")), kind
    )
    bounds = _bounds(rows, loads)
    number = F.lit(0)
    for bound in bounds:
        number = number + F.when(F.col("doc_id") > bound, 1).otherwise(0)
    load = F.when(F.col("doc_id").isNull(), len(bounds)).otherwise(number).cast("string")
    parted = rows.withColumn("load", load)
    for i in range(len(bounds) + 1):
        index.add(parted.filter(F.col("load") == str(i)), str(i))
    found = verdicts(parted, index)
    index.close()
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def new_rows(
    docs: DataFrame, index: DigestIndex, load: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose text no earlier load and no row before has, entered into the index.

    All columns of ``docs`` stay. The rows are stored with their digests first; given again under
    the same name, a load returns what it returned before.
    """
    row, digest = free_name(docs, "exact_row"), free_name(docs, "exact_digest")
    kept = stored(
        docs.withColumn(digest, F.unhex(F.sha2(normalised(text_or_empty(text_col)), 256)))
        .withColumn(row, F.monotonically_increasing_id()),
        "exact-load",
    )
    named = kept.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(row).alias("row"), F.col(digest).alias("digest"))
    index.add(named, load)
    own = index.rows().filter(F.col("load") == load).select("digest")
    entered = _firsts(named).repartition(index.buckets, "digest").join(own.hint("merge"), "digest", "left_semi")
    rows = stored(entered.select(F.col("keep_row").alias(row)), "exact-entered")
    return kept.join(rows, row, "left_semi").select(*[f"`{c}`" for c in docs.columns])
