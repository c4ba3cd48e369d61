"""Running count per key: the changelog of a count table.

A plain window over the key sorts all records of one key in one task, which fails for a
key that holds a third of all rows. So beyond a number of records the total order is cut
into blocks, and the count is a prefix sum over them: each record's rank inside (key,
block) is a window over at most one block; the numbers of records of the key in earlier
blocks are added. A hot key is spread over as many tasks as there are blocks. The records
are read, split and shuffled once, and sorted once: the ranks and the numbers are two
readings of the same shuffle, and the second only counts. Rows that can be packed are shuffled
whole, by their block, and taken apart behind the shuffle, which is then no larger than they.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DataType

BLOCK = "order_block"

# Rewrites rows so that they are small and split at little cost, and splits rows so rewritten.
Packing = tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame]]

# A task sorts this many records of a key without trouble.
HOT_ROWS = 20_000_000
# Records, after the split if there is one, that a block should have.
ROWS_PER_BLOCK = 1_000_000
# The cuts between blocks are constants of the plan. More records make larger blocks.
MOST_BLOCKS = 16_384
# Records of packed rows that a task should have; it sorts them in memory.
ROWS_PER_TASK = 1_000_000
_SAMPLES_PER_BLOCK = 16
_CHOICES = 16
_SAMPLED_RECORDS = 5_000_000


def running_count(
    records: DataFrame,
    order_by: Sequence[str],
    key: str = "key",
    name: str = "count",
    split: Callable[[DataFrame], DataFrame] | None = None,
    split_order: Sequence[str] = (),
    packing: Packing | None = None,
    before: DataFrame | None = None,
    total: int | None = None,
    most_per_row: Column | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Each record with the number of records of its key up to and with itself.

    ``order_by``, and ``split_order`` after it, must order the records of a key
    totally. ``split`` turns the given records into those to count, such as
    lines into words. It must keep the other columns of a record; the columns
    of ``split_order`` are its own. Blocks are made before the split, where
    there are fewer rows, and sized by the records that come of it. More than ``hot_rows``
    records are counted by blocks, as they may be of one key. ``before`` holds (key, count) of
    records that came earlier, and its counts are continued. Records without a
    key are dropped.

    ``total`` is the number of records to count, where the caller knows it, and
    ``most_per_row`` says how many at most come of a row. Without either the records are
    split and counted for it.
    """

    def to_count(rows: DataFrame) -> DataFrame:
        return (split(rows) if split else rows).where(F.col(key).isNotNull())

    order = [*order_by, *split_order]
    bound = total
    if total is None:
        if most_per_row is None and split is not None:
            bound = total = to_count(records).count()
        else:
            most = F.lit(1) if most_per_row is None else most_per_row
            bound = total = _sum(records, most)
            if split is not None and bound > hot_rows:
                total = _likely_total(records, bound, most, to_count)
    if bound <= hot_rows:
        ranked = _rank(to_count(records), [key], order, name)
        if before is None:
            return ranked
        starts = before.select(F.col("key").alias(key), F.col("count").alias("_start"))
        return _add_starts(ranked, starts, [key], name)

    blocked = in_order_blocks(records, order_by, total, rows_per_block)
    group = [key, BLOCK]
    if packing is None:
        spread = to_count(blocked).repartition(*group)
        seen = [own for own in spread.columns if own not in group]
        ranked = _rank(spread, group, order, name)
        starts = _starts(_ends(spread, group, seen), group, before)
        return _add_starts(ranked, starts, group, name).drop(BLOCK)

    pack, unpack = packing
    blocks = _blocks(total, rows_per_block)
    tasks = _tasks(records.sparkSession, total, blocks)
    rows = pack(_dealt_evenly(blocked, blocks, tasks)).repartition(tasks, BLOCK)
    spread = unpack(rows).where(F.col(key).isNotNull())
    seen = [own for own in spread.columns if own in rows.columns and own not in group]
    starts = _starts(_ends(spread, group, seen), group, before)
    # Sent to where the rows of their block are, which stay there.
    return _rank_behind(spread, starts.repartition(tasks, BLOCK), group, order, name).drop(BLOCK)


def _tasks(spark: SparkSession, total: int, blocks: int) -> int:
    """How many tasks share the blocks, so that each sorts what it has in memory."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(max(usual, math.ceil(total / ROWS_PER_TASK)), blocks)


def _dealt_evenly(blocked: DataFrame, blocks: int, tasks: int) -> DataFrame:
    """Renumber the blocks, in their order, so that the tasks get about equally many.

    A shuffle deals out blocks by a hash of their number. Each block has a few numbers to
    choose from and takes the one of the task with the fewest blocks so far.
    """
    choices = np.arange(blocks * _CHOICES, dtype=np.int64)
    task_of = (_hash_of_long(choices).astype(np.int64) % tasks).reshape(blocks, _CHOICES)
    held = np.zeros(tasks, dtype=np.int64)
    numbers = []
    for block, found in enumerate(task_of):
        choice = int(held[found].argmin())
        held[found[choice]] += 1
        numbers.append(block * _CHOICES + choice)
    chosen = F.from_json(F.lit(f"[{','.join(map(str, numbers))}]"), "array<bigint>")
    return blocked.withColumn(BLOCK, F.coalesce(F.get(chosen, F.col(BLOCK).cast("int")), F.lit(0)))


def _hash_of_long(values: np.ndarray) -> np.ndarray:
    """Spark's hash of bigints, Murmur3 with seed 42. Only the balance hangs on it."""

    def rotated(x: np.ndarray, by: int) -> np.ndarray:
        return (x << np.uint32(by)) | (x >> np.uint32(32 - by))

    found = np.full(len(values), 42, dtype=np.uint32)
    for half in (values & 0xFFFFFFFF, values >> 32):
        mixed = rotated(half.astype(np.uint32) * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
        found = rotated(found ^ mixed, 13) * np.uint32(5) + np.uint32(0xE6546B64)
    found ^= np.uint32(8)
    for by, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        found = (found ^ (found >> np.uint32(by))) * np.uint32(factor)
    return (found ^ (found >> np.uint32(16))).astype(np.int32)


def _blocks(total: int, rows_per_block: int) -> int:
    return max(1, min(MOST_BLOCKS, math.ceil(total / rows_per_block)))


def _sum(records: DataFrame, values: Column) -> int:
    return records.agg(F.coalesce(F.sum(values), F.lit(0))).first()[0]


def _likely_total(
    records: DataFrame, bound: int, most: Column, to_count: Callable[[DataFrame], DataFrame]
) -> int:
    """About how many records come of all rows, which are ``bound`` at most, by a sample.

    It shapes the blocks only; all records are counted, however many there are.
    """
    some = records.sample(min(1.0, _SAMPLED_RECORDS / bound), seed=1).persist()
    try:
        return math.ceil(bound * to_count(some).count() / max(_sum(some, most), 1)) or bound
    finally:
        some.unpersist()


def _rank(records: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    in_group = Window.partitionBy(*group).orderBy(*order)
    return records.withColumn(name, F.row_number().over(in_group).cast("bigint"))


def _rank_behind(
    records: DataFrame, starts: DataFrame, group: list[str], order: Sequence[str], name: str
) -> DataFrame:
    """The ranks of ``_rank``, each with the start of its group added.

    The start goes before the records of its group in one sort. A join by the group would move
    the records to other tasks; a union of inputs that were dealt out alike leaves them.
    """
    lacking = [
        F.lit(None).cast(field.dataType).alias(field.name)
        for field in records.schema if field.name not in group
    ]
    first = starts.select(*group, *lacking, "_start")
    others = [field.name for field in records.schema if field.name not in group]
    after = records.select(*group, *others, F.lit(None).cast("bigint").alias("_start"))
    in_group = (
        Window.partitionBy(*group)
        .orderBy(F.col("_start").desc_nulls_last(), *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    counted = after.union(first).withColumn(
        name, F.sum(F.coalesce("_start", F.lit(1).cast("bigint"))).over(in_group)
    )
    return counted.where(F.col("_start").isNull()).select(*records.columns, name)


def _ends(spread: DataFrame, group: list[str], seen: list[str]) -> DataFrame:
    """How many records of a key each block has.

    ``spread`` is partitioned by block, or by key and block, already, so only one row of each
    goes on. ``seen`` names what else was shuffled.
    """
    counts = F.count(F.lit(1)).alias("_count")
    if seen:
        # All columns are looked at, or what is read here would be another shuffle than
        # that of the records, without these columns.
        ends = spread.groupBy(*group).agg(counts, F.max(F.xxhash64(*seen)).alias("_seen"))
        ends = ends.where(F.col("_seen").isNotNull())
    else:
        ends = spread.groupBy(*group).agg(counts)
    return ends.select(*group, "_count")


def _starts(ends: DataFrame, group: list[str], before: DataFrame | None) -> DataFrame:
    """How many records of a key come before each of its blocks."""
    key, block = group
    if before is not None:
        earlier = before.select(
            F.col("key").alias(key), F.lit(-1).cast("bigint").alias(block),
            F.col("count").alias("_count"),
        )
        ends = ends.unionByName(earlier)
    up_to = Window.partitionBy(key).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ends.withColumn("_start", F.sum("_count").over(up_to))
        .where(F.col("_start").isNotNull() & (F.col(block) >= 0))
        .select(*group, "_start")
    )


def _add_starts(
    ranked: DataFrame, starts: DataFrame, group: Sequence[str], name: str
) -> DataFrame:
    # The ranked records are already partitioned and sorted by the group, so a
    # merge join moves only the starts. They may be too many to replicate.
    return (
        ranked.join(starts.hint("merge"), list(group), "left")
        .withColumn(name, F.col(name) + F.coalesce(F.col("_start"), F.lit(0)))
        .select(*ranked.columns)
    )


def in_order_blocks(
    records: DataFrame, order_by: Sequence[str], total: int, rows_per_block: int
) -> DataFrame:
    """Add the number of the block that each record is in, by the order of ``order_by``.

    ``total`` records, after any split, are to be ``rows_per_block`` in each. The cuts
    between blocks come from a sample of the ordering columns. They shape the balance
    only: each record falls in exactly one block whatever the cuts are. In the plan they
    are constants, so a task that runs again puts its records into the same blocks.
    """
    blocks = _blocks(total, rows_per_block)
    points = _sampled_cuts(records, order_by, blocks) if blocks > 1 else []
    kind = records.select(F.struct(*order_by).alias("point")).schema["point"].dataType
    if not points:
        return records.withColumn(BLOCK, F.lit(0).cast("bigint"))
    return _count_not_after(records, points, kind, order_by)


def _fraction(records: DataFrame, blocks: int) -> float:
    rows = records.count()
    return min(1.0, _SAMPLES_PER_BLOCK * blocks / max(rows, 1))


def _sampled_cuts(records: DataFrame, order_by: Sequence[str], blocks: int) -> list[str]:
    """Cuts between ``blocks`` blocks: every so many-th of a sorted sample."""
    point = F.to_json(F.struct(*order_by)).alias("point")
    sample = (
        records.select(*order_by)
        .sample(_fraction(records, blocks), seed=1)
        .orderBy(*order_by)
        .select(point)
        .collect()
    )
    cuts = min(blocks, len(sample))
    return [sample[cut * len(sample) // cuts].point for cut in range(1, cuts)]


def _count_not_after(
    records: DataFrame, points: list[str], kind: DataType, order_by: Sequence[str]
) -> DataFrame:
    """Add how many of the sorted ``points`` are not after that of a record, by halving.

    Each step is a projection of its own, which Spark compiles; a function over an array of
    steps would be interpreted for each record. A step has as constants only the points that
    it may compare, so the plan holds each point once.
    """
    columns = [F.col(f"`{name}`") for name in records.columns if name != BLOCK]
    point = F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by)
    at = F.lit(0)
    for power in reversed(range(len(points).bit_length())):
        size = 1 << power
        # One JSON constant: the optimizer parses it once into an array constant.
        cuts = F.from_json(
            F.lit("[" + ",".join(points[size - 1 :: 2 * size]) + "]"),
            f"array<{kind.simpleString()}>",
        )
        if len(order_by) == 1:
            cuts = cuts[order_by[0]]
        # Until here ``at`` is a multiple of twice the size. Beyond the last cut ``get`` gives
        # null, which is not after anything.
        cut = F.get(cuts, F.shiftright(at, power + 1))
        step = F.when(cut <= point, at + F.lit(size)).otherwise(at)
        # Known to be not null, or a join by it would compute it again for a test.
        records = records.select(*columns, F.coalesce(step, F.lit(0)).alias(BLOCK))
        at = F.col(BLOCK)
    # Of a generator, not of a projection: the optimizer follows the key of a join down through
    # projections and puts each step into the next, several times, so that the expression would
    # double with every step until the driver's memory is full.
    return records.select(*columns, F.explode(F.array(at.cast("bigint"))).alias(BLOCK))
