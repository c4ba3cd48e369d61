"""The sample tables as record feeds, each a frame of ``key``, ``value`` and offset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_MICROS_PER_DAY = 86_400_000_000

# The columns of the sample tables that are read, so that no reader has to open
# files to find them out.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int",
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A sample table as a stream. File streams take a pattern, not one file."""
    return spark.readStream.schema(SCHEMAS[name]).parquet(f"{folder}/{name}*.parquet")


def order_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Orders: one record per order line, under the order's key."""
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    placed_at = F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint") * _MICROS_PER_DAY
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("l_orderkey").alias("key"),
        F.struct(
            F.col("o_custkey").alias("customer_id"),
            F.col("l_partkey").alias("product_id"),
            placed_at.alias("time_order_placed_at"),
        ).alias("value"),
    )


def customer_feed(spark: SparkSession, folder: str, deleted: Column | None = None) -> DataFrame:
    """Customers as upserts, in the order of their keys.

    ``deleted`` is a condition over the customer table; such a customer has a
    second record, later and without a value.
    """
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    customers = (
        table(spark, folder, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    value = F.struct(
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("gender"),
        F.col("r_name").alias("region"),
    )
    inserted = F.struct((F.col("c_custkey") * 2).alias("offset"), value.alias("value"))
    if deleted is None:
        return customers.select(F.col("c_custkey").alias("key"), inserted.alias("record")).select(
            "key", "record.*"
        )
    removed = F.struct(
        (F.col("c_custkey") * 2 + 1).alias("offset"),
        F.when(F.lit(False), value).alias("value"),
    )
    records = F.when(deleted, F.array(inserted, removed)).otherwise(F.array(inserted))
    return customers.select(
        F.col("c_custkey").alias("key"), F.explode(records).alias("record")
    ).select("key", "record.*")


def product_feed(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("key"),
        F.struct(
            F.col("p_name").alias("name"),
            F.col("p_type").alias("description"),
            F.col("p_brand").alias("supplier_name"),
        ).alias("value"),
        F.col("p_partkey").alias("offset"),
    )


def document_lines(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").alias("offset"), F.col("text").alias("value"))


def mail_feed(pages: DataFrame) -> DataFrame:
    """Page addresses in the place of mail addresses."""
    return pages.select(
        F.col("page_id").alias("key"),
        F.col("url").alias("value"),
        F.col("page_id").alias("offset"),
    )


def user_upserts(events: DataFrame) -> DataFrame:
    """The newest event of each user; an event of type ``error`` deletes the user."""
    value = F.struct(F.col("event_type"), F.col("value").alias("amount"))
    return events.select(
        F.col("user_id").alias("key"),
        F.when(F.col("event_type") != "error", value).alias("value"),
        F.col("event_id").alias("offset"),
    )
