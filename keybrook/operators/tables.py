"""Tables derived from keyed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keybrook.session import exists, remove


def newest_per_key(upserts: DataFrame, order: str = "offset") -> DataFrame:
    """One record per key, the one with the highest ``order``; deletes stay in.

    Each task first reduces its own rows to one per key, so a key with a large
    part of all rows costs one row per task in the shuffle.
    """
    return (
        upserts.where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.max_by("value", order).alias("value"), F.max(order).alias(order))
    )


def latest_by_key(upserts: DataFrame, order: str = "offset") -> DataFrame:
    """The table that a topic of upserts stands for: newest value per key.

    A null value deletes its key. The newest record is found first and tested
    for null after, so that a delete hides the values before it.
    """
    return (
        newest_per_key(upserts, order).where(F.col("value").isNotNull()).select("key", "value")
    )


def count_by_key(records: DataFrame, key: str | Column = "key") -> DataFrame:
    """How many records each key has. Records without a key are not counted."""
    name = F.col(key) if isinstance(key, str) else key
    return (
        records.select(name.alias("key"))
        .where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def named_table(table: DataFrame, name: str) -> DataFrame:
    """Make a table readable by name in its session, and return that reading.

    Store names may hold dashes; quote them in SQL with backticks.
    """
    quoted = f"`{name}`"
    table.createOrReplaceTempView(quoted)
    return table.sparkSession.table(quoted)


def stored_table(table: DataFrame, name: str, folder: str) -> DataFrame:
    """Write a table under a shared folder as its next version, and make that readable by name.

    A reader of the version before goes on undisturbed. The versions before that one are
    removed. Another session reads the newest by ``open_stored_table``.
    """
    spark = table.sparkSession
    versions = _versions(spark, name, folder)
    path = _version_folder(name, folder, max(versions, default=0) + 1)
    table.write.parquet(path)
    for old in sorted(versions)[:-1]:
        remove(spark, _version_folder(name, folder, old))
    return named_table(spark.read.schema(table.schema).parquet(path), name)


def open_stored_table(spark: SparkSession, name: str, folder: str) -> DataFrame:
    """The newest version of a stored table that was written to its end, readable by name."""
    whole = [
        version for version in _versions(spark, name, folder)
        if exists(spark, f"{_version_folder(name, folder, version)}/_SUCCESS")
    ]
    if not whole:
        raise ValueError(f"no table {name} in {folder}")
    return named_table(spark.read.parquet(_version_folder(name, folder, max(whole))), name)


def _version_folder(name: str, folder: str, version: int) -> str:
    return f"{folder.rstrip('/')}/{name}/version={version}"


def _versions(spark: SparkSession, name: str, folder: str) -> list[int]:
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return [int(one.partition("=")[2]) for one in names if one.startswith("version=")]
