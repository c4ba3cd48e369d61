from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from keybrook.functions.text import words, words_of_batch
from keybrook.operators.records import (
    complete_records,
    fan_out,
    flat_map_arrays,
    flat_map_values,
    map_records,
    map_values,
    observe_skipped,
    rekey,
)


def records(spark):
    return spark.createDataFrame(
        [("k1", "a b", 0), ("k2", "c", 1), (None, "d", 2), ("k4", None, 3)],
        "key string, value string, offset bigint",
    )


def rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=str)


def test_map_values_keeps_keys(spark):
    changed = map_values(records(spark), F.upper).select("key", "value")
    assert rows(changed) == rows(
        spark.createDataFrame([("k1", "A B"), ("k2", "C"), (None, "D"), ("k4", None)], "k string, v string")
    )


def test_a_function_that_no_column_expresses(spark):
    @F.pandas_udf("string")
    def backwards(values: pd.Series) -> pd.Series:
        return values.str[::-1]

    changed = map_values(records(spark), backwards)
    assert {row.value for row in changed.collect()} == {"b a", "c", "d", None}


def test_map_records_reads_the_old_pair(spark):
    swapped = map_records(records(spark), lambda key, value: (value, key)).select("key", "value")
    assert ("a b", "k1") in rows(swapped) and ("d", None) in rows(swapped)


def test_flat_map_values(spark):
    split = flat_map_values(records(spark), lambda value: F.split(value, " "))
    assert rows(split.select("key", "offset", "pos", "value")) == rows(
        spark.createDataFrame(
            [("k1", 0, 0, "a"), ("k1", 0, 1, "b"), ("k2", 1, 0, "c"), (None, 2, 0, "d")],
            "k string, o bigint, p int, v string",
        )
    )


def test_rekey(spark):
    assert {row.key for row in rekey(records(spark), lambda key, value: value).collect()} == {
        "a b", "c", "d", None,
    }


def test_null_keys_and_values_are_skipped_and_counted(spark):
    observed, seen = observe_skipped(records(spark), "skipped")
    assert complete_records(observed).count() == 2
    assert seen.get == {"records": 4, "null_keys": 1, "null_values": 1}


def test_fan_out_is_one_scan(spark, plan_of, tmp_path):
    path = str(tmp_path / "records")
    records(spark).write.parquet(path)
    both = fan_out(
        spark.read.parquet(path),
        {
            "same": lambda key, value: (key, value),
            "swapped": lambda key, value: (value, key),
        },
    )
    assert {(row.topic, row.key, row.value) for row in both.where("offset = 0").collect()} == {
        ("same", "k1", "a b"),
        ("swapped", "a b", "k1"),
    }
    plan = plan_of(both)
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_a_function_of_arrow_arrays_spreads_values(spark):
    odd = ["a b", "", " lead", "trail! ", "...", "Größe, naïve_x é", None, "x  y"]
    texts = spark.createDataFrame(
        [(f"k{n}", text, n) for n, text in enumerate(odd)], "key string, value string, offset bigint"
    ).repartition(3)
    spread = flat_map_arrays(texts, words_of_batch, "string")
    assert spread.columns == ["key", "offset", "pos", "value"]
    assert rows(spread) == rows(flat_map_values(texts, words).select(*spread.columns))
    assert flat_map_arrays(texts.limit(0), words_of_batch, "string").collect() == []
