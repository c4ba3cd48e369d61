"""Lines of text files as records without a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One record per line: null ``key``, the line as ``value``."""
    return _as_records(spark.read.text(path))


def stream_lines(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The lines of the files in a folder, and of files that arrive there."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _as_records(reader.text(path))


def spread_over_cores(lines: DataFrame) -> DataFrame:
    """Spread an input of a few splits over all cores, before costly work on its text.

    A file has a split for each ``spark.sql.files.maxPartitionBytes`` of it. Only inputs with
    fewer splits than half of the cores are moved, so all large ones stay as they are,
    in however few files. Files are looked at until they have enough splits; nothing is run.
    """
    spark = lines.sparkSession
    cores = spark.sparkContext.defaultParallelism
    jvm = spark._jvm
    most = jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )
    splits = 0
    for file in lines.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(file)
        size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
        splits += -(-size // most)
        if splits * 2 > cores:
            return lines
    return lines.repartition(cores)


def spread_batch_over_cores(batch: DataFrame) -> DataFrame:
    """The same for a micro-batch, which does not tell its files: by the splits it has."""
    splits = batch._jdf.queryExecution().toRdd().getNumPartitions()
    cores = batch.sparkSession.sparkContext.defaultParallelism
    return batch if splits * 2 > cores else batch.repartition(cores)


def _as_records(lines: DataFrame) -> DataFrame:
    return lines.select(F.lit(None).cast("string").alias("key"), F.col("value"))
