"""Run a pipeline: ``spark-submit`` this file, or ``python -m keybrook``.

Topics are folders below ``--root``, or Kafka topics at ``--servers`` where the
Kafka connector is on the class path. Checkpoints and tables of counts are kept
below ``--work``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from keybrook import schemas
from keybrook.functions.codecs import Codec
from keybrook.plans.enriched_orders import start_enriched_orders
from keybrook.plans.mail_rewrite import both_topics
from keybrook.plans.word_count import start_word_changelog, start_word_counts
from keybrook.session import build_session
from keybrook.sources.topics import (
    drain,
    drain_topic,
    from_envelope,
    read_kafka,
    read_topic,
    stream_kafka,
    stream_topic,
)
from keybrook.streaming.sinks import (
    Sink,
    append_to_kafka,
    append_to_topics,
    to_kafka_topic,
    to_topic_folder,
)
from keybrook.streaming.tables import KeptTable, maintain

# Key and value codecs of the topics.
CODECS: dict[str, tuple[Codec, Codec]] = {
    schemas.ORDER_TOPIC: ("long", schemas.ORDER),
    schemas.CUSTOMER_TOPIC: ("long", schemas.CUSTOMER),
    schemas.PRODUCT_TOPIC: ("long", schemas.PRODUCT),
    schemas.ENRICHED_ORDER_TOPIC: ("long", schemas.ENRICHED_ORDER),
    schemas.LINES_TOPIC: ("string", "string"),
    schemas.WORD_COUNTS_TOPIC: ("string", "long"),
    schemas.MAIL_TOPIC: ("bytes", "string"),
    schemas.NEW_MAIL_TOPIC: ("bytes", "string"),
    schemas.ORIGINAL_AND_NEW_MAIL_TOPIC: ("string", "string"),
}


def parser() -> argparse.ArgumentParser:
    arguments = argparse.ArgumentParser(prog="keybrook", description=__doc__)
    place = arguments.add_mutually_exclusive_group(required=True)
    place.add_argument("--root", help="folder of the topics")
    place.add_argument("--servers", help="Kafka bootstrap servers")
    arguments.add_argument("--work", help="shared folder for checkpoints and tables")
    arguments.add_argument("--application", help="name of the pipeline and its checkpoint")
    arguments.add_argument(
        "--once", action="store_true", help="process what is there, then stop"
    )
    arguments.add_argument(
        "--max-files", type=int, default=1_000, help="files of a topic folder per micro-batch"
    )
    arguments.add_argument(
        "--max-offsets", type=int, default=10_000_000, help="Kafka records per micro-batch"
    )
    pipelines = arguments.add_subparsers(dest="pipeline", required=True)
    pipelines.add_parser("enrich", help="orders with their customers and products")
    pipelines.add_parser("word-count", help="new count of each word, per micro-batch")
    pipelines.add_parser("word-changelog", help="count of its word, per word read")
    pipelines.add_parser("mail", help="rewritten mail addresses, to two topics")
    show = pipelines.add_parser("drain", help="print the first records of a topic")
    show.add_argument("--topic", choices=sorted(CODECS), default=schemas.ENRICHED_ORDER_TOPIC)
    show.add_argument("--count", type=int, default=100)
    return arguments


def records(spark: SparkSession, given: argparse.Namespace, topic: str, stream: bool) -> DataFrame:
    if given.servers and stream:
        envelope = stream_kafka(
            spark, given.servers, topic, maxOffsetsPerTrigger=given.max_offsets
        )
    elif given.servers:
        envelope = read_kafka(spark, given.servers, topic)
    elif stream:
        envelope = stream_topic(spark, given.root, topic, given.max_files)
    else:
        envelope = read_topic(spark, given.root, topic)
    return from_envelope(envelope, *CODECS[topic])


def table(spark: SparkSession, given: argparse.Namespace, topic: str, name: str):
    """Follow a topic of upserts, and give a function that reads the table as it is."""
    checkpoint = f"{given.work}/checkpoints/{name}-{topic}"
    upserts = records(spark, given, topic, stream=True)
    query = maintain(upserts, f"{name}-{topic}", checkpoint, given.once)
    if given.once:
        query.awaitTermination()
    value = CODECS[topic][1].simpleString()
    return KeptTable.maintained(spark, checkpoint, "bigint", value).present


def sink(given: argparse.Namespace, topic: str, application: str) -> Sink:
    if given.servers:
        return to_kafka_topic(given.servers, topic, *CODECS[topic])
    return to_topic_folder(given.root, topic, application, *CODECS[topic])


def run(spark: SparkSession, given: argparse.Namespace) -> None:
    if given.pipeline == "drain":
        if given.servers:
            first = drain(records(spark, given, given.topic, stream=False), given.count)
        else:
            envelope = drain_topic(spark, given.root, given.topic, given.count)
            first = from_envelope(envelope, *CODECS[given.topic]).orderBy("offset", "partition")
        first.select("key", "value").show(given.count, truncate=False)
        return

    if not given.work:
        raise SystemExit("--work is needed by a streaming pipeline")
    name = given.application or given.pipeline
    checkpoint = f"{given.work}/checkpoints/{name}"
    if given.pipeline == "enrich":
        orders = records(spark, given, schemas.ORDER_TOPIC, stream=True)
        query = start_enriched_orders(
            orders.select("key", "value", "partition", "offset"),
            table(spark, given, schemas.CUSTOMER_TOPIC, name),
            table(spark, given, schemas.PRODUCT_TOPIC, name),
            sink(given, schemas.ENRICHED_ORDER_TOPIC, name),
            checkpoint,
            name,
            given.once,
        )
    elif given.pipeline == "mail":
        both = both_topics(records(spark, given, schemas.MAIL_TOPIC, stream=True))
        query = (
            append_to_kafka(both, given.servers, name, checkpoint, given.once)
            if given.servers
            else append_to_topics(both, given.root, name, checkpoint, given.once)
        )
    else:
        lines = records(spark, given, schemas.LINES_TOPIC, stream=True)
        topic = sink(given, schemas.WORD_COUNTS_TOPIC, name)

        def write_counts(batch: DataFrame, batch_id: int) -> None:
            topic(batch.withColumnRenamed("count", "value"), batch_id)

        if given.pipeline == "word-count":
            query = start_word_counts(lines, write_counts, checkpoint, name, given.once)
        else:
            query = start_word_changelog(
                lines,
                f"{given.work}/tables/{name}",
                checkpoint,
                name,
                given.once,
                order_by=["partition", "offset"],
                sink=write_counts,
            )
    query.awaitTermination()


def main(arguments: list[str] | None = None) -> None:
    given = parser().parse_args(arguments)
    run(build_session(f"keybrook-{given.application or given.pipeline}"), given)


if __name__ == "__main__":
    main()
