from __future__ import annotations

import struct

import pytest
from pyspark.sql import functions as F

from keybrook.functions.codecs import decode, encode
from keybrook.schemas import ENRICHED_ORDER

LONGS = [0, 1, -1, 255, 256, 2**63 - 1, -(2**63), None]


def test_long_is_eight_big_endian_bytes(spark):
    rows = spark.createDataFrame([(number,) for number in LONGS], "number bigint")
    encoded = rows.withColumn("data", encode(F.col("number"), "long"))
    for row in encoded.withColumn("back", decode(F.col("data"), "long")).collect():
        expected = None if row.number is None else struct.pack(">q", row.number)
        assert (None if row.data is None else bytes(row.data)) == expected
        assert row.back == row.number


def test_long_of_other_length_is_refused(spark):
    short = spark.createDataFrame([(bytearray(b"\x01\x02"),)], "data binary")
    with pytest.raises(Exception, match="8 bytes"):
        short.select(decode(F.col("data"), "long")).collect()


def test_string_and_bytes(spark):
    rows = spark.createDataFrame([("né",), ("",), (None,)], "text string")
    coded = rows.select("text", encode(F.col("text"), "string").alias("data"))
    back = coded.select(
        "text",
        decode(F.col("data"), "string").alias("back"),
        decode(F.col("data"), "bytes").alias("same"),
    ).collect()
    assert [row.back for row in back] == ["né", "", None]
    assert bytes(back[0].same) == "né".encode()


def test_malformed_text_gets_replacement_characters(spark):
    rows = spark.createDataFrame([(bytearray(b"a\xffb"),)], "data binary")
    assert rows.select(decode(F.col("data"), "string").alias("text")).first().text == "a�b"


def test_nested_record(spark):
    value = (("pen", "blue", "acme"), ("Ann", "female", "north"), (1, 2, -(2**63)))
    rows = spark.createDataFrame([(value,)], f"value {ENRICHED_ORDER.simpleString()}")
    back = rows.select(decode(encode(F.col("value"), ENRICHED_ORDER), ENRICHED_ORDER).alias("v"))
    assert tuple(tuple(part) for part in back.first().v) == value
