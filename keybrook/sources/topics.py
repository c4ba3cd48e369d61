"""Topics: keyed records in the envelope that Spark's Kafka source also has.

A topic is a Kafka topic, where the Kafka connector is on the class path, or a
folder ``<root>/topic=<name>/application=<name>/run=<id>/batch_id=<number>/span=<offsets>`` of
Parquet files, so that several writers can share it. Readers return the envelope;
``from_envelope`` types it. Offsets rise within each partition of a topic, over all
writes; the ledger of ``offsets.py`` deals them out. The span of a batch is its lowest and
highest offset and its number of records, so a reader of some offsets leaves the others
unread.

Between Spark jobs, ``write_records`` and its readers keep the records typed:
nothing is encoded, and a reader fetches only the fields it uses.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from keybrook.functions.codecs import (
    Codec,
    decode,
    decode_or_null,
    encode,
    is_malformed,
)
from keybrook.operators.checks import keeps_contract, missing_fields, unknown_symbols
from keybrook.schemas import ENVELOPE
from keybrook.sources.offsets import Ledger


def to_envelope(
    records: DataFrame,
    topic: str | Column,
    key_codec: Codec,
    value_codec: Codec,
    partition: Column | int | None = None,
) -> DataFrame:
    """Encode ``key`` and ``value`` and add the rest of the envelope.

    ``partition``, ``offset`` and ``timestamp`` are taken from the records where they have
    them; a ``partition`` given here comes first. The offset only orders the records
    of one write: a folder topic shifts it behind what it holds already, and Kafka
    gives its own.
    """
    if partition is None:
        partition = F.col("partition") if "partition" in records.columns else F.lit(0)
    partition = F.lit(partition) if isinstance(partition, int) else partition
    offset = F.col("offset") if "offset" in records.columns else F.lit(None)
    written_at = F.col("timestamp") if "timestamp" in records.columns else F.current_timestamp()
    return records.select(
        encode(F.col("key"), key_codec).alias("key"),
        encode(F.col("value"), value_codec).alias("value"),
        (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        written_at.alias("timestamp"),
    )


def rejected_record(contract: T.StructType) -> T.StructType:
    """What ``to_checked_envelope`` writes of a record that it rejects."""
    names = T.ArrayType(T.StringType())
    return T.StructType([
        T.StructField("value", contract),
        T.StructField("missing", names),
        T.StructField("unknown", names),
    ])


def to_checked_envelope(
    records: DataFrame,
    topic: str,
    rejected_topic: str,
    key_codec: Codec,
    contract: T.StructType,
    partition: Column | int | None = None,
) -> DataFrame:
    """Envelope of records that keep their contract, and of the others for a topic of their own.

    The check and the split are part of the pass that writes, in a batch or a stream.
    A rejected record travels with the names of the fields it lacks and of those
    that hold an unknown symbol (``rejected_record``). A null value is a delete, and kept.
    """
    value = F.col("value")
    kept = value.isNull() | keeps_contract(contract, "value")
    refused = F.to_json(
        F.struct(
            value.alias("value"),
            missing_fields(contract, "value").alias("missing"),
            unknown_symbols(contract, "value").alias("unknown"),
        )
    ).cast("binary")
    data = records.select(
        *[name for name in records.columns if name != "value"],
        F.when(kept, encode(value, contract)).otherwise(refused).alias("value"),
        F.when(kept, F.lit(topic)).otherwise(F.lit(rejected_topic)).alias(_TOPIC),
    )
    return to_envelope(data, F.col(_TOPIC), key_codec, "bytes", partition)


_TOPIC = "_topic"


def split_malformed(
    envelope: DataFrame, key_codec: Codec, value_codec: Codec, complete: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Typed records, and the rows of the envelope whose key or value cannot be decoded.

    ``from_envelope`` fails on the latter; a program that must go on writes them to a
    topic of their own. With ``complete``, records that lack a required field or hold an
    unknown symbol are among the latter too, though they can be decoded.
    """
    bad = is_malformed(F.col("key"), key_codec) | is_malformed(F.col("value"), value_codec)
    if complete and isinstance(value_codec, T.StructType):
        decoded = envelope.withColumn(_TYPED, decode_or_null(F.col("value"), value_codec))
        broken = F.col(_TYPED).isNotNull() & ~keeps_contract(value_codec, _TYPED)
        flagged = decoded.withColumn(_BAD, bad | broken).drop(_TYPED)
        good, rest = _split(flagged, F.col(_BAD), key_codec, value_codec)
        return good, rest.drop(_BAD)
    return _split(envelope, bad, key_codec, value_codec)


_TYPED, _BAD = "_typed", "_bad"


def _split(
    envelope: DataFrame, bad: Column, key_codec: Codec, value_codec: Codec
) -> tuple[DataFrame, DataFrame]:
    good = envelope.where(~bad).select(
        decode_or_null(F.col("key"), key_codec).alias("key"),
        decode_or_null(F.col("value"), value_codec).alias("value"),
        "partition",
        "offset",
        "timestamp",
    )
    return good, envelope.where(bad)


def in_one_order(records: DataFrame, position: str = "pos") -> DataFrame:
    """Records whose ``offset`` also holds their ``position`` in the record they come from.

    The changelog of a line's words has the line's offset on each word. The new offset
    orders by both; it is no rank, so nothing is sorted.
    """
    width = records.agg(F.coalesce(F.max(position), F.lit(0)) + 1).first()[0]
    return records.withColumn("offset", F.col("offset") * width + F.col(position)).drop(position)


def from_envelope(
    envelope: DataFrame, key_codec: Codec = "string", value_codec: Codec = "string"
) -> DataFrame:
    """Typed ``key`` and ``value`` with the record's place in the topic."""
    return envelope.select(
        decode(F.col("key"), key_codec).alias("key"),
        decode(F.col("value"), value_codec).alias("value"),
        "partition",
        "offset",
        "timestamp",
    )


def write_topic(envelope: DataFrame, root: str, application: str | None = None) -> None:
    """Append records to the folders of the topics they name, behind what is there."""
    _write(envelope, root, application or f"write-{uuid.uuid4().hex}", None, 0)


def write_batch(
    envelope: DataFrame,
    root: str,
    application: str,
    batch_id: int,
    run: str = "0",
    replace_earlier_runs: bool = False,
) -> None:
    """Write one batch of an application to the topics it names, in one pass.

    A batch that is written again, after its commit was lost, replaces itself, at the same
    offsets. Other batches and applications are left alone. ``run`` names what the batches are
    numbered by, such as a checkpoint. A new run of an application adds to what earlier
    runs wrote, or replaces all of it; either way an earlier run can write no more.
    """
    retired = _write(envelope, root, application, run, batch_id)
    if replace_earlier_runs and retired:
        _remove_runs(envelope.sparkSession, root, application, retired)


def _write(
    envelope: DataFrame, root: str, application: str, run: str | None, batch_id: int
) -> list[str]:
    spark = envelope.sparkSession
    place = ["topic", "partition"]
    offset = F.coalesce("offset", F.monotonically_increasing_id())
    numbered = envelope.withColumn("offset", offset)
    # One row per topic and partition.
    found = numbered.groupBy(*place).agg(
        F.min("offset").alias("low"), F.max("offset").alias("high"),
        F.count(F.lit(1)).alias("records"),
    ).collect()
    if not found:
        return []
    spans = {(row.topic, row.partition): (row.low, row.high) for row in found}
    reserved = Ledger(spark, root).reserve(application, run, batch_id, spans)
    of_topic: dict[str, list[int]] = {}
    for row in found:
        shift = reserved.shifts[row.topic, row.partition]
        low, high, records = of_topic.get(row.topic, (row.low + shift, 0, 0))
        of_topic[row.topic] = [
            min(low, row.low + shift), max(high, row.high + shift), records + row.records
        ]
    folders = {"application": F.lit(application), "run": F.lit(run or "once"),
               "batch_id": F.lit(batch_id)}
    spans_of = {topic: "-".join(map(str, span)) for topic, span in of_topic.items()}
    [(topic, partition), *others] = spans
    if others or topic is None or partition is None:
        shifts = spark.createDataFrame(
            [
                (topic, partition, shift, spans_of[topic])
                for (topic, partition), shift in reserved.shifts.items()
            ],
            "topic string, partition int, _shift bigint, span string",
        )
        shifted = numbered.join(F.broadcast(shifts), place)
    else:
        # All go to one folder, whose name is a constant: no record looks it up, and none
        # is sorted by it.
        shifted = numbered.withColumns({
            "topic": F.lit(topic), "_shift": F.lit(reserved.shifts[topic, partition]),
            "span": F.lit(spans_of[topic]),
        })
    (
        shifted.withColumn("offset", F.col("offset") + F.col("_shift"))
        .withColumns(folders)
        .select(*envelope.columns, *_FOLDERS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**COMPACT)
        .partitionBy("topic", *_FOLDERS)
        .parquet(root)
    )
    return reserved.retired


# For folders that only this library reads: sorted numbers are kept as their differences.
COMPACT = {"compression": "zstd", "parquet.writer.version": "v2"}
_FOLDERS = ("application", "run", "batch_id", "span")


def _remove_runs(spark: SparkSession, root: str, application: str, runs: list[str]) -> None:
    jvm = spark._jvm
    for run in runs:
        pattern = jvm.org.apache.hadoop.fs.Path(
            f"{root.rstrip('/')}/topic=*/application={application}/run={run}"
        )
        files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in files.globStatus(pattern):
            files.delete(status.getPath(), True)


def read_topic(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """All records of a folder topic, from the start."""
    return _with_topic(spark.read.schema(_stored()).parquet(_folder(root, topic)), topic)


def stream_topic(
    spark: SparkSession, root: str, topic: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A folder topic as a stream: first what is there, then what arrives."""
    reader = spark.readStream.schema(_stored())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _with_topic(reader.parquet(_folder(root, topic)), topic)


def write_records(records: DataFrame, root: str, topic: str) -> None:
    """Append typed records to a folder, with whatever columns they have."""
    records.write.mode("append").parquet(_folder(root, topic))


def stored_files(spark: SparkSession, root: str, topic: str) -> list[str]:
    """The files of a topic, as they are listed; none is read."""
    return spark.read.schema(_stored()).parquet(_folder(root, topic)).inputFiles()


def stream_records(
    spark: SparkSession,
    root: str,
    topic: str,
    schema: str,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(_folder(root, topic))


def read_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """All records of a Kafka topic, from the start to its present end."""
    return spark.read.format("kafka").options(**_kafka(servers, topic), **options).load()


def stream_kafka(spark: SparkSession, servers: str, topic: str, **options: str | int) -> DataFrame:
    """A Kafka topic as a stream, from the start."""
    return spark.readStream.format("kafka").options(**_kafka(servers, topic), **options).load()


def write_kafka(envelope: DataFrame, servers: str) -> None:
    """Append records to the Kafka topics they name."""
    (
        envelope.select("key", "value", "topic")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .save()
    )


def drain(topic: DataFrame, count: int) -> DataFrame:
    """The first ``count`` records of a topic, in order.

    Each task keeps only its own first ``count`` records, so nothing is sorted
    as a whole.
    """
    order = [name for name in ("offset", "partition", "timestamp") if name in topic.columns]
    return topic.orderBy(*order).limit(count)


def drain_topic(spark: SparkSession, root: str, topic: str, count: int) -> DataFrame:
    """The first ``count`` records of a folder topic, in order, from the batches that hold them.

    Batches are chosen by the spans in their names: those that end below the others until
    they hold enough, and all that begin no later than these end.
    """
    return drain(read_folders(spark, root, topic, first_folders(spark, root, topic, count)), count)


def first_folders(spark: SparkSession, root: str, topic: str, count: int) -> list[str]:
    """The folders of the batches that hold the first ``count`` records of a topic."""
    files = spark.read.schema(_stored()).parquet(_folder(root, topic)).inputFiles()
    spans = {}
    for file in files:
        path = file.rsplit("/", 1)[0]
        spans[path] = tuple(int(part) for part in path.rsplit("span=", 1)[1].split("-"))
    held, end = 0, -1
    for _, high, records in sorted(spans.values(), key=lambda span: span[1]):
        if held >= count:
            break
        held, end = held + records, high
    return sorted(path for path, (low, _, _) in spans.items() if low <= end)


def read_folders(spark: SparkSession, root: str, topic: str, folders: list[str]) -> DataFrame:
    """The records of some batches of a topic."""
    if not folders:
        return spark.createDataFrame([], ENVELOPE)
    stored = spark.read.schema(_stored()).option("basePath", _folder(root, topic))
    return _with_topic(stored.parquet(*folders), topic)


def _stored() -> T.StructType:
    return T.StructType([field for field in ENVELOPE if field.name != "topic"])


def _folder(root: str, topic: str) -> str:
    return f"{root.rstrip('/')}/topic={topic}"


def _with_topic(stored: DataFrame, topic: str) -> DataFrame:
    return stored.withColumn("topic", F.lit(topic)).select(*ENVELOPE.names)


def _kafka(servers: str, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
