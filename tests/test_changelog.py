from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from keybrook.operators.changelog import _dealt_evenly, in_order_blocks, running_count
from keybrook.plans.word_count import (
    keyed_words,
    pack_words,
    unpack_words,
    word_changelog,
    word_counts,
)

LINE = "Fir Oak Elm Fir Fir Fir Fir Fir Oak Oak Oak"


def by_hand(records, before=()):
    seen, out = Counter(dict(before)), []
    for order, key in sorted(records, key=lambda record: record[0]):
        seen[key] += 1
        out.append((order, key, seen[key]))
    return sorted(out)


def test_sample_line(spark):
    lines = spark.createDataFrame([(0, LINE)], "offset bigint, value string")
    log = word_changelog(lines).orderBy("offset", "pos").collect()
    assert [(row.key, row["count"]) for row in log] == [
        ("fir", 1), ("oak", 1), ("elm", 1), ("fir", 2), ("fir", 3), ("fir", 4),
        ("fir", 5), ("fir", 6), ("oak", 2), ("oak", 3), ("oak", 4),
    ]
    final = {row.key: row["count"] for row in word_counts(lines).collect()}
    assert final == {"fir": 6, "oak": 4, "elm": 1}


@pytest.mark.parametrize(
    "rows_per_block, hot_rows", [(1, 1), (7, 100), (50, 10), (10_000, 100), (50, 10_000)]
)
def test_hot_key_against_counting_by_hand(spark, rows_per_block, hot_rows):
    chance = random.Random(5)
    records = [
        (order, "hot" if chance.random() < 0.4 else f"k{chance.randrange(40)}")
        for order in range(600)
    ]
    shuffled = records[:]
    chance.shuffle(shuffled)
    frame = spark.createDataFrame(shuffled, "offset bigint, key string").repartition(3)
    log = running_count(frame, ["offset"], rows_per_block=rows_per_block, hot_rows=hot_rows)
    assert sorted(tuple(row) for row in log.select("offset", "key", "count").collect()) == by_hand(
        records
    )


def test_order_of_several_columns_where_the_first_hardly_varies(spark):
    records = [((f"source{n % 2}", n), "k" if n % 3 else "other") for n in range(300)]
    frame = spark.createDataFrame(
        [(source, turn, key) for (source, turn), key in records],
        "source string, turn bigint, key string",
    )
    blocked = in_order_blocks(frame, ["source", "turn"], 300, 20)
    assert blocked.select("order_block").distinct().count() > 5
    assert max(row["count"] for row in blocked.groupBy("order_block").count().collect()) < 100
    log = running_count(frame, ["source", "turn"], rows_per_block=20, hot_rows=50)
    found = sorted(((row.source, row.turn), row.key, row["count"]) for row in log.collect())
    assert found == by_hand(records)


def test_blocks_follow_the_order(spark):
    frame = spark.range(1000).select(F.pmod(F.col("id") * 7919, F.lit(1000)).alias("at"))
    blocked = in_order_blocks(frame, ["at"], 1000, 100)
    spans = (
        blocked.groupBy("order_block")
        .agg(F.min("at").alias("low"), F.max("at").alias("high"))
        .orderBy("order_block")
        .collect()
    )
    assert 9 <= len(spans) <= 12
    assert all(one.high < two.low for one, two in zip(spans, spans[1:]))


def test_timestamps_finer_than_the_cuts(spark):
    frame = spark.range(400).select(
        F.expr("timestamp_micros(1700000000000000 + id * 137)").alias("at"),
        F.lit("k").alias("key"),
    )
    log = running_count(frame, ["at"], rows_per_block=30, hot_rows=10).orderBy("at").collect()
    assert [row["count"] for row in log] == list(range(1, 401))


@pytest.mark.parametrize("hot_rows", [5, 12, 10_000])
def test_counts_go_on_from_earlier_ones(spark, hot_rows):
    records = [(n, f"k{min(n % 4, 2)}") for n in range(40)]
    frame = spark.createDataFrame(records, "offset bigint, key string")
    before = spark.createDataFrame([("k0", 10), ("k2", 7), ("unseen", 4)], "key string, count bigint")
    log = running_count(frame, ["offset"], before=before, rows_per_block=5, hot_rows=hot_rows)
    found = sorted((row.offset, row.key, row["count"]) for row in log.collect())
    assert found == by_hand(records, {"k0": 10, "k2": 7})


def test_records_without_key_are_dropped(spark):
    frame = spark.createDataFrame([(0, "a"), (1, None), (2, "a")], "offset bigint, key string")
    assert sorted(row["count"] for row in running_count(frame, ["offset"]).collect()) == [1, 2]


def test_empty_input(spark):
    frame = spark.createDataFrame([], "offset bigint, key string")
    assert running_count(frame, ["offset"]).collect() == []


def test_no_task_gets_all_records_of_a_key(spark, plan_of):
    frame = spark.range(1000).select(F.col("id").alias("offset"), F.lit("k").alias("key"))
    plan = plan_of(running_count(frame, ["offset"], rows_per_block=100, hot_rows=200))
    assert "SortMergeJoin" in plan
    # Below the rank there is one shuffle of the records, by key and block.
    records_side = plan[plan.index("row_number") :]
    first_exchange = records_side[records_side.index("hashpartitioning") :].split("\n")[0]
    assert "order_block" in first_exchange


def test_few_long_lines_are_cut_by_their_words(spark, plan_of):
    lines = spark.createDataFrame(
        [(n, "hot word " * 500) for n in range(40)], "offset bigint, value string"
    )
    log = word_changelog(lines, rows_per_block=5_000, hot_rows=10_000)
    assert "order_block" in plan_of(log)
    ranks = log.where("key = 'hot'").select("count").collect()
    assert sorted(row["count"] for row in ranks) == list(range(1, 20_001))
    blocks = in_order_blocks(lines, ["offset"], 40_000, 5_000)
    assert blocks.select("order_block").distinct().count() == 8


def test_the_records_are_read_and_shuffled_once(spark, tmp_path, plan_of):
    """With and without columns that the count does not need."""
    path = str(tmp_path / "lines")
    lines = [(n, "a b hot " * 20, n % 3, "x") for n in range(200)]
    spark.createDataFrame(lines, "offset bigint, value string, partition int, more string").write.parquet(path)
    stored = spark.read.parquet(path)
    for columns in (["offset"], ["offset", "more"]):
        log = running_count(
            stored.select("value", *columns), ["offset"],
            split=keyed_words, split_order=["pos"], total=12_000,
            rows_per_block=1000, hot_rows=100,
        )
        assert log.count() == 12_000
        log.collect()
        plan = plan_of(log)
        final = plan[: plan.index("== Initial Plan ==")]
        assert final.count("FileScan") == 1 and "ReusedExchange" in final
        assert final.count("Generate posexplode") == 1


def test_a_total_of_the_caller_is_used(spark):
    frame = spark.createDataFrame([(n, "k") for n in range(50)], "offset bigint, key string")
    log = running_count(frame, ["offset"], total=50, rows_per_block=10, hot_rows=20)
    assert sorted(row["count"] for row in log.collect()) == list(range(1, 51))


def test_without_hot_keys_there_is_one_shuffle(spark, plan_of):
    frame = spark.range(1000).select(F.col("id").alias("offset"), F.lit("k").alias("key"))
    plan = plan_of(running_count(frame, ["offset"], rows_per_block=100))
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_the_records_of_blocks_are_sorted_once(spark, plan_of):
    """The numbers of earlier records come of a count, not of a second ranking."""
    frame = spark.range(1000).select(F.col("id").alias("offset"), F.lit("k").alias("key"))
    plan = plan_of(running_count(frame, ["offset"], rows_per_block=100, hot_rows=200))
    assert sum("Window [row_number" in line for line in plan.split("\n")) == 1


def test_the_search_for_a_block_is_compiled(spark, plan_of):
    frame = spark.range(1000).select(F.col("id").alias("offset"))
    assert "lambda" not in plan_of(in_order_blocks(frame, ["offset"], 1000, 10))


def test_thousands_of_blocks_fit_into_the_plan(spark, plan_of):
    """Each cut is in the plan once, and no join puts the steps of the search into each other."""
    lines = spark.range(8000).select(
        F.col("id").alias("offset"), F.concat_ws(" ", F.lit("hot"), F.col("id") % 7).alias("value")
    )
    for packing in (None, (pack_words, unpack_words)):
        log = running_count(
            lines, ["offset"], split=keyed_words, split_order=["pos"], packing=packing,
            total=16_000, rows_per_block=4, hot_rows=10,
        )
        plan = plan_of(log)
        final = plan[plan.index("== Initial Plan ==") :] if "== Initial Plan ==" in plan else plan
        assert "Generate explode(array(" in final
        assert len(final) < 2 * 8 * 4000 + 50_000
        assert log.where("key = 'hot'").agg(F.max("count"), F.sum("count")).first()[:] == (
            8000, 8000 * 8001 // 2,
        )


@pytest.mark.parametrize("rows_per_block", [3, 40, 100_000])
def test_packed_lines_give_the_records_of_lines(spark, rows_per_block):
    texts = [
        "Fir oak, FIR", "", "...", None, " lead", "trail ", "a", "É ß İ x_1", "a b c", "0 0",
    ]
    lines = spark.createDataFrame(
        [(n // 2, text, n) for n, text in enumerate(texts * 9)],
        "offset bigint, value string, source int",
    )
    unpacked = unpack_words(pack_words(lines))
    assert sorted(map(tuple, unpacked.collect())) == sorted(map(tuple, keyed_words(lines).collect()))
    order = ["offset", "source"]
    logs = [
        running_count(
            lines, order, split=keyed_words, split_order=["pos"], packing=packing,
            rows_per_block=rows_per_block, hot_rows=hot_rows,
        ).select("offset", "source", "pos", "key", "count")
        for packing, hot_rows in ((None, 1000), (None, 10), ((pack_words, unpack_words), 10))
    ]
    plain, by_key, packed = (sorted(map(tuple, log.collect())) for log in logs)
    assert plain == by_key == packed


def test_packed_lines_are_shuffled_as_lines(spark, tmp_path, plan_of):
    """The words of a line are shuffled in one row, once, and stay where they are counted."""
    path = str(tmp_path / "lines")
    spark.createDataFrame(
        [(n, "a b hot " * 20) for n in range(200)], "offset bigint, value string"
    ).write.parquet(path)
    log = word_changelog(spark.read.parquet(path), rows_per_block=1000, hot_rows=100)
    log.collect()
    plan = plan_of(log)
    final = plan[: plan.index("== Initial Plan ==")]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
    assert "Join" not in final and final.count("row_number") == 0
    # Of the lines, of the counts to their keys, and of the starts to their blocks.
    assert plan[plan.index("== Initial Plan ==") :].count("Exchange hashpartitioning") == 4


def test_blocks_are_dealt_evenly(spark):
    blocked = spark.range(3000).select(F.col("id").alias("order_block"))
    dealt = _dealt_evenly(blocked, 3000, 100)
    held = dealt.groupBy(F.pmod(F.hash("order_block"), F.lit(100))).count().collect()
    assert len(held) == 100 and max(row["count"] for row in held) <= 31
    numbers = [row.order_block for row in dealt.collect()]
    assert len(set(numbers)) == 3000 and sorted(numbers) == numbers


@pytest.mark.parametrize("rows", [1010, 1100, 1590])
def test_no_block_is_left_with_what_the_others_do_not_take(spark, rows):
    """The sample is no multiple of the number of blocks."""
    frame = spark.range(rows).select(F.col("id").alias("at"))
    held = [row["count"] for row in in_order_blocks(frame, ["at"], 100, 1).groupBy("order_block").count().collect()]
    assert len(held) == 100 and max(held) <= -(-rows // 100)
