from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from keybrook.operators.joins import (
    choose_distributions,
    frequent_keys,
    lookup_join,
    measured_bytes,
    unmatched,
)
from keybrook.operators.tables import latest_by_key
from keybrook.plans.enriched_orders import enrich_orders, flatten
from keybrook.schemas import CUSTOMER, ENRICHED_ORDER, ORDER, PRODUCT

BOTH_WAYS = pytest.mark.parametrize("max_broadcast_bytes", [1 << 20, 0])


def upserts(spark, rows, record):
    schema = f"key bigint, value {record.simpleString()}, offset bigint"
    return spark.createDataFrame([(*row, n) for n, row in enumerate(rows)], schema)


@pytest.fixture
def customers(spark):
    return latest_by_key(upserts(spark, [
        (1, ("Ann", "female", "north")),
        (2, ("Bo", "male", "south")),
        (1, ("Ann2", "female", "east")),
        (2, None),
        (3, ("Cy", "unknown", "west")),
    ], CUSTOMER))


@pytest.fixture
def products(spark):
    return latest_by_key(upserts(spark, [
        (10, ("pen", "blue", "acme")),
        (11, ("ink", "black", "acme")),
    ], PRODUCT))


@pytest.fixture
def orders(spark):
    rows = [
        (100, (1, 10, 5)),
        (101, (2, 10, 6)),
        (102, (3, 99, 7)),
        (103, (3, 11, -(2**63))),
        (None, (1, 10, 8)),
        (104, None),
        (105, (None, 10, 9)),
    ]
    return spark.createDataFrame(rows, f"key bigint, value {ORDER.simpleString()}")


@BOTH_WAYS
def test_hand_case(orders, customers, products, max_broadcast_bytes):
    enriched = enrich_orders(orders, customers, products, max_broadcast_bytes)
    assert enriched.schema["value"].dataType.simpleString() == ENRICHED_ORDER.simpleString()
    assert {
        (row.order_id, row.product_name, row.customer_name, row.order_time_order_placed_at)
        for row in flatten(enriched).collect()
    } == {(100, "pen", "Ann2", 5), (103, "ink", "Cy", -(2**63))}


@BOTH_WAYS
def test_star_equals_one_join_after_another(orders, customers, products, max_broadcast_bytes):
    with_customer = lookup_join(
        orders,
        customers,
        lambda key, order: order["customer_id"],
        lambda order, customer: F.struct(customer.alias("customer"), order.alias("order")),
        max_broadcast_bytes,
    )
    chained = lookup_join(
        with_customer,
        products,
        lambda key, value: value["order"]["product_id"],
        lambda value, product: F.struct(product.alias("product"), value["customer"], value["order"]),
        max_broadcast_bytes,
    )
    star = enrich_orders(orders, customers, products, max_broadcast_bytes)
    assert sorted(chained.collect()) == sorted(star.collect())


@BOTH_WAYS
def test_unmatched(orders, customers, max_broadcast_bytes):
    missing = unmatched(
        orders,
        customers,
        lambda key, order: order["customer_id"],
        max_broadcast_bytes=max_broadcast_bytes,
    )
    assert {row.key for row in missing.collect()} == {101, 105}


@BOTH_WAYS
def test_a_key_with_most_of_the_stream(spark, max_broadcast_bytes):
    stream = spark.range(4000).select(
        F.col("id").alias("key"),
        F.when(F.col("id") % 3 < 2, F.lit(7)).otherwise(F.col("id")).alias("value"),
    ).unionByName(
        # copies of one record, and records that look up nothing
        spark.range(500).select(F.lit(-1).alias("key"), F.lit(7).alias("value"))
    )
    table = spark.range(2000).select(
        F.col("id").alias("key"), (F.col("id") * 10).cast("string").alias("value")
    )
    joined = lookup_join(
        stream,
        table,
        lambda key, value: value,
        lambda value, row: F.struct(value.alias("id"), row.alias("row")),
        max_broadcast_bytes=max_broadcast_bytes,
    )
    found = sorted((row.key, row.value.id, row.value.row) for row in joined.collect())
    looked_up = [(n, 7 if n % 3 < 2 else n) for n in range(4000)] + [(-1, 7)] * 500
    assert found == sorted((key, id, str(id * 10)) for key, id in looked_up if id < 2000)
    missing = unmatched(
        stream, table, lambda key, value: value, max_broadcast_bytes=max_broadcast_bytes
    )
    assert sorted(row.key for row in missing.collect()) == sorted(
        key for key, id in looked_up if id >= 2000
    )


def test_small_tables_do_not_shuffle_the_stream(spark, products, plan_of, tmp_path):
    path = str(tmp_path / "orders")
    spark.range(10).selectExpr(
        "id AS key", "named_struct('customer_id', id, 'product_id', 10L, 'extra', 'x') AS value"
    ).write.parquet(path)
    joined = lookup_join(
        spark.read.parquet(path),
        products,
        lambda key, order: order["product_id"],
        lambda order, product: product["name"],
    )
    plan = plan_of(joined)
    assert plan.count("BroadcastHashJoin") == 1
    stream_side = plan[: plan.index("BroadcastExchange")]
    assert "hashpartitioning" not in stream_side
    assert "product_id:bigint" in stream_side and "extra" not in stream_side.split("ReadSchema")[1]


def test_large_tables_are_salted_and_not_broadcast(spark, plan_of):
    stream = spark.range(1000).select(F.col("id").alias("key"), F.lit(7).alias("value"))
    table = spark.range(100).select(F.col("id").alias("key"), F.col("id").alias("value"))
    [distribution] = choose_distributions(stream, [(table, lambda key, value: value)], 0)
    assert distribution.hot_keys == [7] and not distribution.replicate
    plan = plan_of(
        lookup_join(
            stream, table, lambda key, value: value, lambda value, row: row, max_broadcast_bytes=0
        )
    )
    assert "Broadcast" not in plan and "_salt" in plan
    # one pass over the stream
    assert plan.count("Range (0, 1000") == 1


def test_hot_records_reach_several_tasks(spark):
    stream = spark.range(1000).select(F.col("id").alias("key"), F.lit(7).alias("value"))
    table = spark.range(100).select(F.col("id").alias("key"), F.col("id").alias("value"))
    joined = lookup_join(
        stream, table, lambda key, value: value, lambda value, row: row, max_broadcast_bytes=0
    )
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = joined.select(F.spark_partition_id().alias("task")).groupBy("task").count()
        assert sum(row["count"] for row in tasks.collect()) == 1000
        assert tasks.count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_frequent_keys_finds_all_hot_ones(spark):
    keys = spark.range(10_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("a"),
        F.when(F.col("id") % 50 == 0, F.lit(-2)).otherwise(F.col("id")).alias("b"),
    )
    found = frequent_keys(keys.repartition(5), share=0.01)
    assert -1 in found["a"] and -2 in found["b"]
    assert len(found["a"]) <= 100 and len(found["b"]) <= 100


def test_measured_bytes_covers_the_data(spark, products):
    table = spark.createDataFrame([("x" * 1000, [1, 2], {"a": "b"})], "a string, b array<int>, c map<string, string>")
    sizes = measured_bytes([table, table.limit(0), products])
    assert 1000 < sizes[0] < 1200 and sizes[1] == 0 and sizes[2] > 0


def test_records_with_a_map_join_both_ways(spark):
    stream = spark.createDataFrame(
        [(n, {"to": "x"}) for n in range(20)], "key bigint, value map<string, string>"
    )
    table = spark.createDataFrame([("x", 7)], "key string, value int")
    for limit in (1 << 20, 0):
        joined = lookup_join(
            stream, table, lambda key, value: value["to"], lambda value, row: row, limit
        )
        assert [row.value for row in joined.collect()] == [7] * 20


def test_small_files_need_no_job(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(50).select(F.col("id").alias("key"), F.col("id").alias("value")).write.parquet(path)
    stored = spark.read.schema("key bigint, value bigint").parquet(path)
    stream = spark.range(20).select(F.col("id").alias("key"), F.col("id").alias("value"))
    context = spark.sparkContext
    context.setJobGroup("choice", "no job may run")
    try:
        table = latest_by_key(stored.withColumn("offset", F.col("key")))
        joined = lookup_join(stream, table, lambda key, value: value, lambda value, row: row)
        assert context.statusTracker().getJobIdsForGroup("choice") == []
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert joined.count() == 20


def test_a_table_that_is_not_from_small_files_is_made_once_and_measured(spark):
    table = spark.range(50).select(F.col("id").alias("key"), F.col("id").alias("value"))
    stream = spark.range(20).select(F.col("id").alias("key"), F.col("id").alias("value"))
    [chosen] = choose_distributions(stream, [(table, lambda key, value: value)])
    assert chosen.replicate and chosen.table.inputFiles()
