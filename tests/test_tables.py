from __future__ import annotations

import random

import pytest

from keybrook.operators.tables import (
    count_by_key,
    latest_by_key,
    named_table,
    open_stored_table,
    stored_table,
)
from keybrook.schemas import CUSTOMER_STORE

UPSERTS = [
    (1, "a", 0),
    (2, "b", 1),
    (1, "a2", 2),
    (2, None, 3),  # delete
    (3, None, 4),  # delete of what was never there
    (4, "d", 5),
    (4, None, 6),
    (4, "d2", 7),  # back after a delete
    (None, "x", 8),  # no key
]
TABLE = {1: "a2", 4: "d2"}


def upserts(spark, rows):
    return spark.createDataFrame(rows, "key bigint, value string, offset bigint")


def as_dict(table):
    return {row.key: row.value for row in table.collect()}


def test_newest_wins_in_any_order_of_rows(spark):
    for seed in range(3):
        rows = UPSERTS[:]
        random.Random(seed).shuffle(rows)
        assert as_dict(latest_by_key(upserts(spark, rows).repartition(3))) == TABLE


def test_hot_key_is_reduced_before_the_shuffle(spark, plan_of):
    rows = [(1, f"v{n}", n) for n in range(1000)] + [(n, "x", n) for n in range(2, 500)]
    table = latest_by_key(upserts(spark, rows))
    plan = plan_of(table)
    assert plan.index("partial_max_by") > plan.index("Exchange")  # below it in the tree
    assert plan.count("Exchange") == 1
    assert as_dict(table)[1] == "v999"


def test_named_table(spark):
    named = named_table(latest_by_key(upserts(spark, UPSERTS)), CUSTOMER_STORE)
    assert as_dict(named) == TABLE
    assert as_dict(spark.sql(f"SELECT * FROM `{CUSTOMER_STORE}`")) == TABLE


def test_stored_table(spark, tmp_path):
    stored_table(latest_by_key(upserts(spark, UPSERTS)), "stored", str(tmp_path))
    assert as_dict(spark.table("stored")) == TABLE


def test_a_reader_of_a_stored_table_outlives_its_swap(spark, tmp_path):
    folder = str(tmp_path)
    with pytest.raises(ValueError, match="no table"):
        open_stored_table(spark, "swapped", folder)
    first = stored_table(upserts(spark, [(1, "a", 0)]), "swapped", folder)
    second = stored_table(upserts(spark, [(1, "b", 0)]), "swapped", folder)
    # The reader that began with the first version finishes; the name means the second.
    assert as_dict(first) == {1: "a"}
    assert as_dict(spark.table("swapped")) == as_dict(second) == {1: "b"}
    for number in range(3):
        stored_table(upserts(spark, [(1, f"c{number}", 0)]), "swapped", folder)
    assert len(list((tmp_path / "swapped").glob("version=*"))) == 2
    # A version that was not written to its end is not opened.
    (tmp_path / "swapped" / "version=99").mkdir()
    assert as_dict(open_stored_table(spark, "swapped", folder)) == {1: "c2"}


def test_count_by_key(spark, plan_of):
    counts = count_by_key(upserts(spark, UPSERTS))
    assert {row.key: row["count"] for row in counts.collect()} == {1: 2, 2: 2, 3: 1, 4: 3}
    assert "partial_count" in plan_of(counts)
