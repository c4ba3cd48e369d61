"""Inner join of a record stream with a table, on a key taken from the record.

A table that is small enough is replicated to every executor, and the stream is not
shuffled. Small input files settle that without a job; otherwise the table is made
once, written, and measured. A larger table is joined by a shuffle in which
keys that hold a large part of the stream are salted: their records spread over
many tasks, and their table rows (at most one per key) are repeated for each
salt. Both ways give the same rows, in one pass over the stream.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from keybrook.operators.records import complete_records
from keybrook.session import work_folder

MAX_BROADCAST_BYTES = 256 * 1024 * 1024
# A key with more than this share of the stream is salted. It also bounds how
# many keys are: 200. What is left of skew, adaptive execution splits.
HOT_SHARE = 0.005

SelectKey = Callable[[Column, Column], Column]

_LOOKUP_KEY, _TABLE_KEY, _TABLE_VALUE = "_lookup_key", "_table_key", "_table_value"
_SALT, _TABLE_SALT = "_salt", "_table_salt"


# Rows in memory may be this many times as large as the files they come from.
FILE_MULTIPLE = 256


@dataclass(frozen=True)
class StoredTable:
    """A table that lies in a folder, and the size of its rows in bytes.

    A join takes it as it is: it is neither computed nor measured again.
    """

    rows: DataFrame
    size: int


@dataclass(frozen=True)
class Distribution:
    """How a table meets the stream."""

    table: DataFrame
    replicate: bool
    hot_keys: list = field(default_factory=list)


def choose_distributions(
    stream: DataFrame,
    lookups: Sequence[tuple[DataFrame | StoredTable, SelectKey]],
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> list[Distribution]:
    """Decide for several tables at once, from their sizes.

    Tables whose files are small need no job. The others are computed once, into the
    shared folder, and measured there; the join reads them from it. If some are too
    large, one more pass over their keys in the stream finds the hot ones of each. So every
    ``select_key`` here takes its key from a record of ``stream`` itself.
    """
    tables = [table for table, _ in lookups]
    known = {
        index: table.size for index, table in enumerate(tables) if isinstance(table, StoredTable)
    }
    tables = [table.rows if index in known else table for index, table in enumerate(tables)]
    unsure = [
        index for index, table in enumerate(tables)
        if index not in known and not surely_below(table, max_broadcast_bytes)
    ]
    # With no limit at all there is nothing to measure.
    if max_broadcast_bytes > 0 and unsure:
        for index in unsure:
            tables[index] = _written(tables[index], work_folder(stream.sparkSession, "lookup-table"))
        sizes = measured_bytes([tables[index] for index in unsure])
        unsure = [n for n, size in zip(unsure, sizes) if size > max_broadcast_bytes]
    unsure += [index for index, size in known.items() if size > max_broadcast_bytes]
    keys = {
        f"{_LOOKUP_KEY}{index}": lookups[index][1](F.col("key"), F.col("value"))
        for index in unsure
    }
    hot = {}
    if unsure:
        hot = frequent_keys(
            complete_records(stream).select(*[key.alias(name) for name, key in keys.items()])
        )
    return [
        Distribution(table, index not in unsure, hot.get(f"{_LOOKUP_KEY}{index}", []))
        for index, table in enumerate(tables)
    ]


def surely_below(table: DataFrame, most_bytes: int) -> bool:
    """Whether the table's files are so small that its rows cannot reach ``most_bytes``.

    The files are listed; nothing is run. A table that also has rows from elsewhere, or
    whose files are not at hand, is not sure to be small.
    """
    if most_bytes <= 0:
        return False
    if _has_other_sources(table):
        return False
    spark = table.sparkSession
    total = 0
    for file in table.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        total += system.getFileStatus(path).getLen()
        if total * FILE_MULTIPLE > most_bytes:
            return False
    return True


def _has_other_sources(table: DataFrame) -> bool:
    leaves = table._jdf.queryExecution().optimizedPlan().collectLeaves()
    return any(
        not leaves.apply(n).nodeName().startswith(("LogicalRelation", "Relation"))
        for n in range(leaves.size())
    )


def _written(table: DataFrame, path: str) -> DataFrame:
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def stored_and_measured(table: DataFrame, path: str) -> StoredTable:
    """Compute a table into a new folder, for the joins of many streams or micro-batches."""
    rows = _written(table, path)
    return StoredTable(rows, measured_bytes([rows])[0])


def lookup_join(
    stream: DataFrame,
    table: DataFrame | StoredTable,
    select_key: SelectKey,
    join_values: Callable[[Column, Column], Column],
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Look up a table row for each record and join the two values.

    ``table`` has one row per ``key``, so no record is multiplied. Records with
    a null key or value, a null looked-up key or no match are dropped. The
    output keeps the key of the stream.
    """
    return star_join(stream, [(table, select_key)], join_values, max_broadcast_bytes)


def star_join(
    stream: DataFrame,
    lookups: Sequence[tuple[DataFrame | StoredTable, SelectKey]],
    join_values: Callable[..., Column],
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Look up each record in several tables, as by one ``lookup_join`` after another.

    ``join_values`` takes the value of the record and of each table. The new
    value is built once, after the last join.
    """
    distributions = choose_distributions(stream, lookups, max_broadcast_bytes)
    value = F.col("value")
    keys = [select_key(F.col("key"), value) for _, select_key in lookups]
    joined = complete_records(stream).select(
        *stream.columns, *[key.alias(f"{_LOOKUP_KEY}{n}") for n, key in enumerate(keys)]
    )
    for n in range(len(lookups)):
        joined = joined.where(F.col(f"{_LOOKUP_KEY}{n}").isNotNull())
    for n, distribution in enumerate(distributions):
        right = distribution.table.select(
            F.col("key").alias(_TABLE_KEY), F.col("value").alias(f"{_TABLE_VALUE}{n}")
        )
        joined = _join(
            joined, right, f"{_LOOKUP_KEY}{n}", "inner", distribution, stream.columns
        ).drop(_TABLE_KEY)
    new_value = join_values(value, *[F.col(f"{_TABLE_VALUE}{n}") for n in range(len(lookups))])
    return joined.select(
        *[new_value.alias(name) if name == "value" else name for name in stream.columns]
    )


def unmatched(
    stream: DataFrame,
    table: DataFrame,
    select_key: SelectKey,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """The complete records that ``lookup_join`` drops for want of a table row."""
    keys_only = table.select("key")
    [distribution] = choose_distributions(
        stream, [(keys_only, select_key)], max_broadcast_bytes
    )
    left = complete_records(stream).withColumn(
        _LOOKUP_KEY, select_key(F.col("key"), F.col("value"))
    )
    right = distribution.table.select(F.col("key").alias(_TABLE_KEY))
    return _join(left, right, _LOOKUP_KEY, "left_anti", distribution, stream.columns).select(
        *stream.columns
    )


def _join(
    left: DataFrame,
    right: DataFrame,
    lookup_key: str,
    how: str,
    distribution: Distribution,
    record_columns: Sequence[str],
) -> DataFrame:
    same_key = F.col(lookup_key) == F.col(_TABLE_KEY)
    if distribution.replicate:
        return left.join(F.broadcast(right), same_key, how)

    salts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A hash of the whole record, so that a task that runs again gives it the
    # same salt. Records without a looked-up key would also meet in one task.
    # With the coalesce the salt is known to be not null, and is not tested.
    hashed = F.pmod(F.xxhash64(*_hashable(left, record_columns)), F.lit(salts)).cast("int")
    is_hot = F.col(lookup_key).isNull() | F.col(lookup_key).isin(distribution.hot_keys)
    salted_left = left.withColumn(
        _SALT, F.when(is_hot, F.coalesce(hashed, F.lit(0))).otherwise(0)
    )
    all_salts = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_right = right.withColumn(
        _TABLE_SALT,
        F.explode(
            F.when(F.col(_TABLE_KEY).isin(distribution.hot_keys), all_salts).otherwise(
                F.array(F.lit(0))
            )
        ),
    )
    same_salt = F.col(_SALT) == F.col(_TABLE_SALT)
    joined = salted_left.join(salted_right.hint("merge"), same_key & same_salt, how)
    return joined.drop(_SALT, _TABLE_SALT)


def _hashable(records: DataFrame, columns: Sequence[str]) -> list[Column]:
    """The columns, as JSON where they hold a map, which has no hash."""
    return [
        F.to_json(F.struct(name)) if "map<" in records.schema[name].dataType.simpleString()
        else F.col(name)
        for name in columns
    ]


def frequent_keys(keys: DataFrame, share: float = HOT_SHARE) -> dict[str, list]:
    """For each column a list that holds every key with more than ``share`` of the rows.

    It may hold some keys that are less frequent, but never more than
    ``1 / share`` entries in all. One pass, no shuffle by key.
    """
    found = keys.freqItems(keys.columns, share).first()
    return {
        name: [key for key in items if key is not None]
        for name, items in zip(keys.columns, found)
    }


def measured_bytes(tables: Sequence[DataFrame]) -> list[int]:
    """The sizes of the tables' rows, by reading them all in one job."""
    sizes = [
        table.agg(F.coalesce(F.sum(_row_bytes(table.schema)), F.lit(0)).alias("size")).select(
            F.lit(index).alias("table"), "size"
        )
        for index, table in enumerate(tables)
    ]
    measured = dict(reduce(DataFrame.union, sizes).collect())
    return [measured[index] for index in range(len(tables))]


def _row_bytes(schema: T.StructType) -> Column:
    return sum(
        (_bytes_of(F.col(f"`{field.name}`"), field.dataType) for field in schema),
        start=F.lit(0).cast("bigint"),
    )


def _bytes_of(value: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StructType):
        return sum(
            (_bytes_of(value[field.name], field.dataType) for field in data_type),
            start=F.lit(8),
        )
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 8
    if isinstance(data_type, (T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(value)), F.lit(0)) + 8
    return F.lit(8)
