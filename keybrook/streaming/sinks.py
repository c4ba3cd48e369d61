"""Starting streaming queries: topic folders, per-batch folders, console."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from keybrook.functions.codecs import Codec
from keybrook.session import STATE_STORE_CONF, exists, remove, session_conf
from keybrook.sources.topics import (
    COMPACT,
    drain,
    in_one_order,
    to_envelope,
    write_batch,
    write_kafka,
)

# Takes the rows of a micro-batch and its number.
Sink = Callable[[DataFrame, int], None]

BATCH = "batch_id"
COMMIT_INTERVAL = "10 seconds"


def start(
    writer: DataStreamWriter, spark: SparkSession, name: str, checkpoint: str, once: bool
) -> StreamingQuery:
    """Start a query under its own name and checkpoint.

    Name and checkpoint identify a pipeline: started again with the same
    checkpoint, it goes on where it stopped, with its state. ``once`` processes
    all that is there now and stops.
    """
    trigger = {"availableNow": True} if once else {"processingTime": COMMIT_INTERVAL}
    with session_conf(spark, STATE_STORE_CONF):
        return (
            writer.queryName(name)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )


def run_of(batch: DataFrame) -> str:
    """The identity of the running query, which its checkpoint keeps over restarts."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "0"


def append_to_topics(
    envelope: DataFrame,
    root: str,
    name: str,
    checkpoint: str,
    once: bool = False,
    replace_earlier_runs: bool = False,
) -> StreamingQuery:
    """Append a stream to the topic folders it names, each record exactly once.

    Each micro-batch is one write of the application ``name``; one that runs again
    replaces what it wrote. Applications with different names share the topics. The same name
    with a new checkpoint is a new run: it adds its records, or replaces those of earlier
    runs, which can write no more.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            write_batch(kept, root, name, batch_id, run_of(batch), replace_earlier_runs)
        finally:
            kept.unpersist()

    return write_each_batch(envelope, write, name, checkpoint, once)


def append_to_kafka(
    envelope: DataFrame, servers: str, name: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Append a stream to the Kafka topics it names, each record at least once."""
    writer = (
        envelope.select("key", "value", "topic")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
    )
    return start(writer.outputMode("append"), envelope.sparkSession, name, checkpoint, once)


def show_records(
    records: DataFrame, name: str, checkpoint: str, once: bool = False, rows: int = 20
) -> StreamingQuery:
    """Print the first keys and values of each micro-batch."""

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        batch.show(rows, truncate=False)

    return write_each_batch(records.select("key", "value"), show, name, checkpoint, once)


def drain_stream(
    envelope: DataFrame,
    count: int,
    root: str,
    checkpoint: str,
    name: str = "drain",
    timeout: float | None = None,
) -> DataFrame:
    """Wait until a stream has brought ``count`` records, stop it, and return the first of them.

    What arrives is kept below ``root``, one folder per micro-batch, until there is enough;
    then the query ends, however much more there is. After ``timeout`` seconds it ends with what
    has come. Started again with the same checkpoint it goes on where it stopped.
    """
    spark = envelope.sparkSession
    enough = threading.Event()
    keep = to_folders(root)

    def write(batch: DataFrame, batch_id: int) -> None:
        if not enough.is_set():
            keep(batch, batch_id)
        # The numbers of rows in the files' footers.
        if spark.read.schema(envelope.schema).parquet(root).count() >= count:
            enough.set()

    query = write_each_batch(envelope, write, name, checkpoint)
    deadline = None if timeout is None else time.monotonic() + timeout
    try:
        while query.isActive and not enough.wait(0.2):
            if deadline is not None and time.monotonic() > deadline:
                break
    finally:
        query.stop()
    failed = query.exception()
    if failed is not None:
        raise failed
    if not exists(spark, root):
        return spark.createDataFrame([], envelope.schema)
    return drain(spark.read.schema(envelope.schema).parquet(root), count)


def write_each_batch(
    stream: DataFrame,
    sink: Sink,
    name: str,
    checkpoint: str,
    once: bool = False,
    output_mode: str = "append",
) -> StreamingQuery:
    """Hand each micro-batch to a sink."""
    writer = stream.writeStream.foreachBatch(sink).outputMode(output_mode)
    return start(writer, stream.sparkSession, name, checkpoint, once)


def to_folders(root: str) -> Sink:
    """Write each micro-batch, as it is, to a folder named by its number.

    A batch that is run again after a failure replaces its folder, so its
    records appear once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").options(**COMPACT).parquet(batch_folder(root, batch_id))

    return write


def to_topic_folder(
    root: str,
    topic: str,
    application: str,
    key_codec: Codec,
    value_codec: Codec,
    replace_earlier_runs: bool = False,
) -> Sink:
    """Write each micro-batch to a folder topic that several applications may share.

    Runs are told apart as by ``append_to_topics``.

    Records keep their partition and order; those with a ``pos`` are ordered by it
    where their offset is the same.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # Read three times: for the width of the offsets, for their span and for the topic. A
        # cached copy would be several times as large as these files.
        spark = batch.sparkSession
        staged = f"{root.rstrip('/')}/_staged-{uuid.uuid4().hex}"
        try:
            batch.write.options(**COMPACT).parquet(staged)
            kept = spark.read.schema(batch.schema).parquet(staged)
            records = in_one_order(kept) if "pos" in kept.columns else kept
            envelope = to_envelope(records, topic, key_codec, value_codec)
            write_batch(
                envelope, root, application, batch_id, run_of(batch), replace_earlier_runs
            )
        finally:
            remove(spark, staged)

    return write


def to_kafka_topic(servers: str, topic: str, key_codec: Codec, value_codec: Codec) -> Sink:
    """Append each micro-batch to a Kafka topic, each record at least once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_kafka(to_envelope(batch, topic, key_codec, value_codec), servers)

    return write


def batch_folder(root: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/{BATCH}={batch_id}"


def read_batches(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All that the sink ``to_folders`` wrote, with its ``batch_id``."""
    return spark.read.schema(f"{schema}, {BATCH} bigint").parquet(root)
