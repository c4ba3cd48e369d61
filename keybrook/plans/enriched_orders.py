"""Orders with their customer and product: a star of two lookup joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from keybrook.operators.joins import MAX_BROADCAST_BYTES, StoredTable, star_join
from keybrook.schemas import ENRICHED_ORDER
from keybrook.streaming.sinks import Sink, read_batches, write_each_batch


def enrich_orders(
    orders: DataFrame,
    customers: DataFrame | StoredTable,
    products: DataFrame | StoredTable,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Key of the order; value of (product, customer, order).

    ``customers`` and ``products`` are tables with one row per key, as
    ``latest_by_key`` gives.
    """
    return star_join(
        orders,
        [
            (customers, lambda key, order: order["customer_id"]),
            (products, lambda key, order: order["product_id"]),
        ],
        lambda order, customer, product: F.struct(
            product.alias("product"), customer.alias("customer"), order.alias("order")
        ),
        max_broadcast_bytes,
    )


def flatten(enriched: DataFrame) -> DataFrame:
    """One column per field, prefixed by its record."""
    return enriched.select(
        F.col("key").alias("order_id"),
        *[
            F.col(f"value.{record}.{field.name}").alias(f"{record}_{field.name}")
            for record in ("product", "customer", "order")
            for field in enriched.schema["value"].dataType[record].dataType
        ],
    )


def start_enriched_orders(
    orders: DataFrame,
    customers: Callable[[], DataFrame | StoredTable],
    products: Callable[[], DataFrame | StoredTable],
    sink: Sink,
    checkpoint: str,
    name: str = "enriched-orders",
    once: bool = False,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> StreamingQuery:
    """Enrich a stream of orders, each micro-batch with the tables as they are then.

    A static frame would keep the list of files it had at the start, so the
    tables are given as functions and read once per micro-batch. A later change
    of a table does not emit earlier orders again. For a table with a history of
    upserts give ``KeptTable.maintained(...).present`` of what ``maintain`` keeps: it is read once
    for each of its versions, however many micro-batches meet it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        tables = customers(), products()
        large = any(
            isinstance(table, StoredTable) and table.size > max_broadcast_bytes for table in tables
        )
        # For large tables the orders are read twice: for hot keys, and to be joined.
        kept = batch.persist() if large else batch
        try:
            sink(enrich_orders(kept, *tables, max_broadcast_bytes), batch_id)
        finally:
            if large:
                kept.unpersist()

    return write_each_batch(orders, write, name, checkpoint, once)


def read_enriched_orders(spark: SparkSession, root: str) -> DataFrame:
    """All that ``start_enriched_orders`` wrote to the sink ``to_folders``."""
    schema = f"key bigint, value {ENRICHED_ORDER.simpleString()}"
    return read_batches(spark, root, schema).select("key", "value")
