"""Running count per key of a stream, one record out per record in."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from keybrook.operators.changelog import HOT_ROWS, ROWS_PER_BLOCK, Packing, running_count
from keybrook.operators.tables import count_by_key
from keybrook.session import SHUFFLE_CLEANUP_CONF, session_conf
from keybrook.sources.lines import spread_batch_over_cores
from keybrook.streaming.sinks import Sink, read_batches, to_folders, write_each_batch
from keybrook.streaming.tables import counts_of_batch, totals_after


def start_running_count(
    records: DataFrame,
    order_by: Sequence[str],
    root: str,
    checkpoint: str,
    name: str,
    once: bool = False,
    split: Callable[[DataFrame], DataFrame] | None = None,
    split_order: Sequence[str] = (),
    rows_per_block: int = ROWS_PER_BLOCK,
    hot_rows: int = HOT_ROWS,
    sink: Sink | None = None,
    packing: Packing | None = None,
) -> StreamingQuery:
    """Emit each record with the count of its key so far.

    Inside a micro-batch this is ``running_count``, which spreads a hot key over
    many tasks; a stateful processor would get all records of a key in one. The
    totals are Spark's own state below ``root``, which gets one row per key of a batch and gives
    out its new total; so is the output unless a ``sink`` is given. ``order_by`` orders the records
    of a micro-batch; batches follow each other.
    """
    spark = records.sparkSession
    sink = sink or to_folders(f"{root}/changelog")
    totals = f"{root}/totals"

    def write(batch: DataFrame, batch_id: int) -> None:
        # A small batch is spread once. A large one is read again where its rows are needed
        # again; a copy would be larger than what it is read from.
        spread = spread_batch_over_cores(batch)
        kept = spread.persist() if spread is not batch else None
        batch = spread
        try:
            # What has been shuffled for a step is removed with its end.
            with session_conf(batch.sparkSession, SHUFFLE_CLEANUP_CONF):
                counts = count_by_key(split(batch) if split else batch)
                after = totals_after(spark, totals, batch_id, counts, name)
                # Counted once: for what came before, and for what comes after.
                counts = counts_of_batch(spark, totals, batch_id, counts)
                total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
                before = after.join(counts.withColumnRenamed("count", "_own"), "key").select(
                    "key", (F.col("count") - F.col("_own")).alias("count")
                ).where("count > 0")
                log = running_count(
                    batch,
                    order_by,
                    split=split,
                    split_order=split_order,
                    packing=packing,
                    before=before,
                    total=total,
                    rows_per_block=rows_per_block,
                    hot_rows=hot_rows,
                )
                sink(log, batch_id)
        finally:
            if kept is not None:
                kept.unpersist()

    return write_each_batch(records, write, name, checkpoint, once)


def read_changelog(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All records emitted by ``start_running_count``, with their batch."""
    return read_batches(spark, f"{root}/changelog", schema)
