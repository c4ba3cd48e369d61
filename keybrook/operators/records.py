"""Per-record operators on frames with a ``key`` and a ``value`` column.

The functions a caller passes in take and return Columns, so they stay inside
the JVM. Columns other than ``key`` and ``value`` (offset, timestamp) are kept.
None of these operators shuffles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, functions as F


def map_values(records: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    """Change each value and keep its key."""
    return records.withColumn("value", change(F.col("value")))


def map_records(
    records: DataFrame, change: Callable[[Column, Column], tuple[Column, Column]]
) -> DataFrame:
    """Give each record a new key and a new value, both made from the old pair."""
    key, value = change(F.col("key"), F.col("value"))
    return records.withColumns({"key": key, "value": value})


def flat_map_values(
    records: DataFrame, change: Callable[[Column], Column], position: str = "pos"
) -> DataFrame:
    """Replace each value by the 0..n elements of an array, under the same key.

    ``position`` names the column that tells where in the array an element
    stood; together with the offset it is the total order of the new records.
    """
    kept = [name for name in records.columns if name != "value"]
    return records.select(*kept, F.posexplode(change(F.col("value"))).alias(position, "value"))


def flat_map_arrays(
    records: DataFrame,
    change: Callable[[pa.Array], pa.Array],
    element_type: str,
    position: str = "pos",
) -> DataFrame:
    """``flat_map_values`` by a function of the user, over Arrow arrays of many values at once.

    ``change`` takes the values of a batch and returns as many lists of ``element_type``; a null
    or empty list gives no record. It is a table-valued function over the records, and the
    way for what Columns cannot say. Columns are faster where they can.
    """
    kept = [field for field in records.schema if field.name != "value"]
    columns = [f"`{field.name}` {field.dataType.simpleString()}" for field in kept]
    names = [field.name for field in kept]

    class Spread:
        def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:
            lists = change(rows.column("value"))
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            parents = np.repeat(np.arange(len(sizes)), sizes)
            begins = np.cumsum(sizes) - sizes
            places = np.arange(len(parents)) - np.repeat(begins, sizes)
            yield pa.Table.from_arrays(
                [rows.column(name).take(pa.array(parents)) for name in names]
                + [pa.array(places.astype(np.int32)), pc.list_flatten(lists)],
                [*names, position, "value"],
            )

    schema = ", ".join([*columns, f"`{position}` int", f"value {element_type}"])
    spread = F.arrow_udtf(Spread, returnType=schema)
    return spread(records.asTable())


def rekey(records: DataFrame, select_key: Callable[[Column, Column], Column]) -> DataFrame:
    """Give each record a new key; whatever groups by it next will shuffle."""
    return records.withColumn("key", select_key(F.col("key"), F.col("value")))


def complete_records(records: DataFrame) -> DataFrame:
    """Records whose key and value are both present."""
    return records.where(F.col("key").isNotNull() & F.col("value").isNotNull())


def observe_skipped(records: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count null keys and values in the pass that reads the records anyway.

    Operators skip such records without a word; the counts in the returned
    ``Observation`` are there after the first action.
    """
    seen = Observation(name)
    observed = records.observe(
        seen,
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("key").isNull()).alias("null_keys"),
        F.count_if(F.col("value").isNull()).alias("null_values"),
    )
    return observed, seen


def fan_out(
    records: DataFrame,
    branches: Mapping[str, Callable[[Column, Column], tuple[Column, Column]]],
) -> DataFrame:
    """Send each record to several topics in one pass over the source.

    ``branches`` maps a topic to the function that makes that topic's pair.
    Every record becomes one row per branch, tagged by ``topic``, so one scan
    and one write serve all topics; no micro-batch has to be cached. The pairs
    of all branches must have the same types (encode them to bytes if not).
    """
    outputs = []
    for topic, change in branches.items():
        key, value = change(F.col("key"), F.col("value"))
        outputs.append(
            F.struct(F.lit(topic).alias("topic"), key.alias("key"), value.alias("value"))
        )
    kept = [name for name in records.columns if name not in ("key", "value", "topic")]
    return records.select(*kept, F.explode(F.array(*outputs)).alias("record")).select(
        *kept, "record.*"
    )
