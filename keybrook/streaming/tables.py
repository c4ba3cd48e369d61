"""Tables kept up to date by a stream, in Spark's own state store.

Reading a table costs its present size, however long its history is; what a
micro-batch touches is all that it rewrites.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from keybrook.operators.joins import StoredTable, stored_and_measured
from keybrook.operators.tables import newest_per_key
from keybrook.session import exists, remove, work_folder
from keybrook.streaming.sinks import start


def maintain(
    upserts: DataFrame, name: str, checkpoint: str, once: bool = False, order: str = "offset"
) -> StreamingQuery:
    """Follow a stream of upserts (``key``, ``value``, ``order``) into a table.

    The table is the state below ``checkpoint``. Deletes stay in it, or an older
    value that arrives late would come back.
    """
    writer = newest_per_key(upserts, order).writeStream.format("noop").outputMode("update")
    return start(writer, upserts.sparkSession, name, checkpoint, once)


def present_rows(
    spark: SparkSession,
    checkpoint: str,
    key_type: str,
    value_type: str,
    version: int | None = None,
) -> DataFrame:
    """``key`` and ``value`` of the table that ``maintain`` keeps, without deleted keys.

    A table whose stream has not yet finished a batch is empty. ``version`` is that of
    ``table_version``; without it the newest is read.
    """
    schema = f"key {key_type}, value {value_type}"
    reader = spark.read.format("statestore")
    if version is not None and version >= 0:
        reader = reader.option("batchId", version)
    try:
        state = reader.load(checkpoint)
    except PySparkException as missing:
        if not _has_no_state(missing):
            raise
        return spark.createDataFrame([], schema)
    # The state of the aggregate: the newest value comes first, whatever it is called.
    newest = state.schema["value"].dataType[0].name
    return state.select(
        F.col("key.key").alias("key"), F.col("value")[newest].alias("value")
    ).where(F.col("value").isNotNull())


def _has_no_state(missing: PySparkException) -> bool:
    condition = missing.getCondition() or ""
    return condition.startswith("STDS_") or condition == "PATH_NOT_FOUND"


def table_version(spark: SparkSession, checkpoint: str) -> int:
    """The last batch that the stream of a table has finished; -1 before the first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/commits")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return -1
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return max((int(name) for name in names if name.isdigit()), default=-1)


class KeptTable:
    """A table that is read, written and measured once for each of its versions.

    ``present`` gives it as it is now. Micro-batches between two changes share one copy, in
    which nothing moves. The copy before the present one stays for readers that began with it;
    older ones are removed.
    """

    def __init__(
        self,
        spark: SparkSession,
        version: Callable[[], int],
        read: Callable[[int], DataFrame],
        name: str = "kept-table",
    ):
        self.spark, self.version, self.read = spark, version, read
        self.folder = work_folder(spark, name)
        self.kept: dict[int, StoredTable] = {}
        self.paths: list[str] = []

    @classmethod
    def maintained(
        cls, spark: SparkSession, checkpoint: str, key_type: str, value_type: str
    ) -> KeptTable:
        """The table that ``maintain`` keeps below ``checkpoint``."""
        return cls(
            spark,
            lambda: table_version(spark, checkpoint),
            lambda version: present_rows(spark, checkpoint, key_type, value_type, version),
        )

    def present(self) -> StoredTable:
        now = self.version()
        if now not in self.kept:
            path = f"{self.folder}/{uuid.uuid4().hex}"
            self.kept = {now: stored_and_measured(self.read(now), path)}
            self.paths.append(path)
            for old in self.paths[:-2]:
                remove(self.spark, old)
            del self.paths[:-2]
        return self.kept[now]


def totals_after(
    spark: SparkSession, root: str, batch_id: int, counts: DataFrame, name: str
) -> DataFrame:
    """(key, count) over all batches up to ``batch_id``, of the keys in its ``counts`` only.

    The totals are the state of a streaming sum below ``root``, to which each batch is one
    file source's batch. The store looks up the keys of the batch, and what it gives out
    for them is kept for the batch, so one that runs again gets the same and adds
    nothing. What earlier batches left behind is removed.
    """
    given, found = f"{root}/in/batch_id={batch_id}", f"{root}/after/batch_id={batch_id}"
    if not exists(spark, f"{given}/_SUCCESS"):
        counts.write.mode("overwrite").parquet(given)
    schema = T.StructType([counts.schema["key"], T.StructField("count", T.LongType())])
    changes = spark.readStream.schema(schema).parquet(f"{root}/in")
    totals = changes.groupBy("key").agg(F.sum("count").alias("count"))

    def keep(changed: DataFrame, _: int) -> None:
        changed.write.mode("overwrite").parquet(found)

    writer = totals.writeStream.foreachBatch(keep).outputMode("update")
    start(writer, spark, f"{name}-totals", f"{root}/state", once=True).awaitTermination()
    if batch_id > 1:
        remove(spark, f"{root}/in/batch_id={batch_id - 2}")
        remove(spark, f"{root}/after/batch_id={batch_id - 2}")
    return spark.read.schema(schema).parquet(found)


def counts_of_batch(
    spark: SparkSession, root: str, batch_id: int, counts: DataFrame
) -> DataFrame:
    """The counts of a batch as ``totals_after`` was given them, read from what it kept."""
    schema = T.StructType([counts.schema["key"], T.StructField("count", T.LongType())])
    return spark.read.schema(schema).parquet(f"{root}/in/batch_id={batch_id}")
