"""The two tables a search reads, laid out for looking up single keys and replaced together."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.operators.lsh import BUCKET, index_of
from nearkin.params import LshParams
from nearkin.session import delete_folder, stored
from nearkin.sources.corpus import read_table

# Folders that signatures are dealt to by a hash of their id.
ID_BUCKETS = 64
ID_BUCKET = "id_bucket"
_MANIFEST = "version bigint, signatures string, lsh_index string, id_buckets int"


def id_bucket(book_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(book_id), F.lit(buckets)).cast("int")


def write_signatures(signatures: DataFrame, path: str, buckets: int = ID_BUCKETS) -> None:
    """One folder per bucket of ids, sorted by id: a lookup by id reads few row groups of one folder.

    Files without a number in their name share the id ``""``; the digest parts them. The range
    partitioner samples its input, so ``signatures`` should be a stored table.
    """
    bucketed = signatures.withColumn(ID_BUCKET, id_bucket(F.col("book_id"), buckets))
    order = [F.col(ID_BUCKET), F.col("book_id"), F.xxhash64("signature")]
    ranged = bucketed.repartitionByRange(*order).sortWithinPartitions(ID_BUCKET, "book_id")
    ranged.write.mode("overwrite").partitionBy(ID_BUCKET).parquet(path)


def write_index(index: DataFrame, path: str) -> None:
    """One folder per band, sorted by bucket: a lookup reads few row groups of its bands.

    The id is part of the range, so that a hot bucket is spread over several files. ``index``
    should be a stored table, as above.
    """
    order = [*BUCKET, "book_id"]
    ranged = index.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.write.mode("overwrite").partitionBy("band_id").parquet(path)


def _versions(spark: SparkSession, folder: str) -> list:
    """Rows of the manifest, the newest first; of one number the last name counts."""
    try:
        found = spark.read.schema(_MANIFEST).json(f"{folder.rstrip('/')}/manifest")
        return found.orderBy(F.desc("version"), F.desc("signatures")).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def write_search_tables(
    signatures: DataFrame, folder: str, params: LshParams, buckets: int = ID_BUCKETS
) -> int:
    """Write both tables as a new version under ``folder`` and return its number.

    Every row is computed once and stored before it is sorted into place. A version has folders
    of its own, and it counts once a line in ``manifest`` names both, which is written last: a
    reader sees the tables of one version, and a write that breaks off leaves the version before
    as it was. Earlier versions stay until ``drop_versions``.
    """
    spark, folder = signatures.sparkSession, folder.rstrip("/")
    place = f"{folder}/tables/{uuid.uuid4().hex}"
    kept = stored(signatures, "signed")
    write_signatures(kept, f"{place}/signatures", buckets)
    write_index(stored(index_of(kept, params), "index"), f"{place}/lsh_index")
    version = max((row.version for row in _versions(spark, folder)), default=0) + 1
    line = (version, f"{place}/signatures", f"{place}/lsh_index", buckets)
    spark.createDataFrame([line], _MANIFEST).coalesce(1).write.mode("append").json(f"{folder}/manifest")
    return version


def read_search_tables(
    spark: SparkSession, folder: str, version: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """``signatures`` and ``lsh_index`` of the newest version, or of the one asked for.

    The signatures' ``id_bucket`` tells lookups which folder an id is in.
    """
    found = [row for row in _versions(spark, folder) if version in (None, row.version)]
    if not found:
        raise ValueError(f"no search tables under {folder}" + (f" in version {version}" if version else ""))
    bucket = F.col(ID_BUCKET).alias(ID_BUCKET, metadata={"buckets": found[0].id_buckets})
    signatures = read_table(spark, found[0].signatures).select("book_id", "signature", bucket)
    return signatures, read_table(spark, found[0].lsh_index).select("book_id", *BUCKET)


def drop_versions(spark: SparkSession, folder: str, keep: int = 1) -> None:
    """Delete the tables of all but the ``keep`` newest versions; nobody may be reading them."""
    for row in _versions(spark, folder)[keep:]:
        delete_folder(spark, row.signatures.rpartition("/")[0])
