"""Exact dedup against a persistent index of digests.

The index is a table of one row per distinct text, bucketed and sorted by digest.
New documents are reduced to one per digest, anti-joined with the index by a
sort-merge join that does not move the index, and appended. Only digests move;
texts never do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keybrook.llm.common import look_up, lower_ascii, remove_at_exit, written
from keybrook.session import shared_folder

_COLUMNS = "digest binary, keep_id bigint"


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with A to Z lower-cased; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(lower_ascii(text), F.lit("")), 256))


class DigestIndex:
    """An index in a folder that all executors reach.

    The folder is all there is to it: another session opens the same index by the same
    folder. The number of buckets lies beside the rows, and an index is opened with no other.
    ``append`` is one Spark write, so a task that runs again leaves no second row. Each
    append adds a sorted file to a bucket. ``close`` takes the index out of the session's
    catalog and leaves the folder.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None):
        stored = _stored_buckets(spark, folder, buckets)
        if buckets is not None and buckets != stored:
            raise ValueError(f"the index in {folder} has {stored} buckets, not {buckets}")
        buckets = stored
        self.spark, self.folder, self.buckets = spark, folder, buckets
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} ({_COLUMNS}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
            f"LOCATION '{folder}'"
        )

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def unseen(self, digests: DataFrame) -> DataFrame:
        """One row per digest that the index lacks, with the largest ``doc_id``.

        Copies are reduced in each task before the shuffle, and the reduced batch is written:
        the optimizer would push the join below the reduction, and all copies of a text
        would meet in one bucket. The hint keeps the join a merge join, in which the index
        stays where it is.
        """
        batch = written(
            digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id")), "digest-batch"
        )
        return batch.join(self.rows().hint("merge"), "digest", "left_anti")

    def append(self, digests: DataFrame) -> None:
        """Add what is new of (``doc_id``, ``digest``)."""
        (
            self.unseen(digests)
            .repartition(self.buckets, "digest")
            .write.insertInto(self.table)
        )


    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def _stored_buckets(spark: SparkSession, folder: str, buckets: int | None) -> int:
    """The number of buckets that the index in ``folder`` was made with, which is now if it is new."""
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/_buckets")
    files = beside.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(beside):
        stream = files.open(beside)
        stored = int(bytes(stream.readAllBytes()))
        stream.close()
        return stored
    if buckets is None:
        raise ValueError(f"no index in {folder}, and no number of buckets to make it with")
    stream = files.create(beside, False)
    stream.writeBytes(str(buckets))
    stream.close()
    return buckets


def digests_of(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``digest`` of each row, in one pass over the texts."""
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_digest(F.col("text")).alias("digest")
    )


def keep_largest(documents: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """Each document with the one of its equal texts that stays.

    Returns ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.
    Documents go into the index in two batches, the larger ids first, so what the
    index already holds is always the text with the largest ``doc_id``; where the
    ids are cut has no bearing on the result. An index that already has rows from
    earlier runs keeps those.

    Null text is the empty text. Rows with the same ``doc_id`` and text are one
    document and are flagged alike. A null ``doc_id`` is smaller than any other;
    if a group has no other, its ``keep_id`` is null and its rows are kept. Other
    columns are ignored, and an empty table gives an empty result.
    """
    spark = documents.sparkSession
    digests = written(digests_of(documents), "digests")
    own = index is None
    if own:
        folder = shared_folder(spark, "digest-index")
        remove_at_exit(spark, folder)
        index = DigestIndex(
            spark, folder, int(spark.conf.get("spark.sql.shuffle.partitions"))
        )
    middle = digests.agg(F.avg("doc_id")).first()[0]
    # Null ids come last, being the smallest.
    first = F.coalesce(F.col("doc_id") > F.lit(middle or 0), F.lit(False))
    index.append(digests.where(first))
    index.append(digests.where(~first))

    sizes = digests.groupBy("digest").agg(
        F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("_last")
    )
    # A text that occurs once and is not in the index stays; only the others are looked up.
    groups = written(
        sizes.join(index.rows().hint("merge"), "digest")
        .where((F.col("group_size") > 1) | ~F.col("_last").eqNullSafe(F.col("keep_id")))
        .select("digest", "keep_id", "group_size"),
        "digest-groups",
    )
    if own:
        index.close()
    # Few groups are sent to the digests; for many, the copies of a text are spread.
    found = look_up(digests, groups, "digest", F.col("doc_id"), how="left")
    keep_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


ORACLE_SQL = """
WITH digests AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, text_sha256
FROM digests WINDOW same AS (PARTITION BY text_sha256)
"""
