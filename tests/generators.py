"""Seeded test records for the enrichment.

Each generator takes a frame with an ``id`` column, such as ``spark.range(n)``,
and makes one keyed record per id. The value is a hash of the seed and the id,
so the same call always gives the same records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from seeded import seeded_below, seeded_choice, seeded_long, seeded_text
from keybrook.schemas import GENDERS


def generate_customers(ids: DataFrame, seed: int = 1) -> DataFrame:
    record_id = _record_id()
    return _records(
        ids,
        name=seeded_text(seed, "name", record_id, 10),
        gender=seeded_choice(seed, "gender", record_id, GENDERS),
        region=seeded_text(seed, "region", record_id, 20),
    )


def generate_products(ids: DataFrame, seed: int = 2) -> DataFrame:
    record_id = _record_id()
    return _records(
        ids,
        name=seeded_text(seed, "name", record_id, 10),
        description=seeded_text(seed, "description", record_id, 100),
        supplier_name=seeded_text(seed, "supplier_name", record_id, 20),
    )


def generate_orders(ids: DataFrame, customers: int, products: int, seed: int = 3) -> DataFrame:
    """Orders of customers ``0..customers-1`` for products ``0..products-1``."""
    record_id = _record_id()
    return _records(
        ids,
        customer_id=seeded_below(seed, "customer_id", record_id, customers),
        product_id=seeded_below(seed, "product_id", record_id, products),
        time_order_placed_at=seeded_long(seed, "time_order_placed_at", record_id),
    )


def _records(ids: DataFrame, **fields: Column) -> DataFrame:
    value = F.struct(*[column.alias(name) for name, column in fields.items()])
    record_id = _record_id()
    return ids.select(record_id.alias("key"), value.alias("value"), record_id.alias("offset"))


def _record_id() -> Column:
    return F.col("id").cast("bigint")
