"""Sharding along a Hilbert curve.

Some metadata of a document are quantised to a few bits each; the place of that cell
on a Hilbert curve orders the documents; runs of that order become shards. Documents
of a shard then lie close in every dimension at once, so the ranges of its columns are
narrow and a reader can skip shards by any of them.

Nothing is sorted as a whole. A cell with many rows is cut into runs by a hash, the
rows of a run are ranked by themselves, and the rank at which each run starts is a
sum over the counts of the runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from keybrook.llm.common import let, look_up, written

SHARDS = 8
BITS = 4
ROWS_PER_RUN = 1_000_000
_POINT_BITS = 40
DIMENSIONS = ("source", "lang", "size", "doc_id")


def leading_bytes(value: Column) -> Column:
    """A number that orders strings by their first six bytes; null is 0."""
    digits = F.rpad(F.hex(F.substring(value.cast("binary"), 1, 6)), 12, "0")
    return F.coalesce(F.conv(digits, 16, 10).cast("bigint"), F.lit(0))


def bit_length(size: Column) -> Column:
    return F.char_length(F.bin(size)).cast("bigint")


def level(value: Column, low: int, high: int, bits: int) -> Column:
    """Where ``value`` lies between ``low`` and ``high``, as a number of ``bits`` bits."""
    steps = 1 << bits
    part = (value.cast("double") - float(low)) / (float(high) - float(low) + 1.0)
    return F.least(F.floor(part * steps), F.lit(steps - 1)).cast("int")


def curve_index(levels: list[Column], bits: int) -> Column:
    """The place of a cell on the Hilbert curve through all cells.

    The levels go from the highest bit to the lowest; at each bit and dimension the
    lower bits are reflected or exchanged with those of the first dimension, which
    turns the curve inside each part so that the parts join. Gray code and
    interleaving of the bits give the index.
    """
    axes = F.array(*levels)
    last = len(levels) - 1
    turns = [(1 << bit, axis) for bit in range(bits - 1, 0, -1) for axis in range(last + 1)]
    steps = F.array(*[
        F.struct(F.lit(bit).alias("bit"), F.lit(axis).alias("axis")) for bit, axis in turns
    ])

    def turn(x: Column, step: Column) -> Column:
        low = step["bit"] - 1
        moved = F.get(x, step["axis"])
        reflect = moved.bitwiseAND(step["bit"]) != 0
        change = F.when(reflect, low).otherwise(
            F.get(x, F.lit(0)).bitwiseXOR(moved).bitwiseAND(low)
        )
        return F.transform(
            x,
            lambda value, at: F.when(
                (at == 0) | (~reflect & (at == step["axis"])), value.bitwiseXOR(change)
            ).otherwise(value),
        )

    # For the first axis, exchanging it with itself leaves it as it is.
    def turned(x: Column, step: Column) -> Column:
        same = (step["axis"] == 0) & (F.get(x, F.lit(0)).bitwiseAND(step["bit"]) == 0)
        return F.when(same, x).otherwise(turn(x, step))

    def gray(x: Column) -> Column:
        coded = []
        for axis in range(last + 1):
            value = F.get(x, F.lit(0))
            for other in range(1, axis + 1):
                value = value.bitwiseXOR(F.get(x, F.lit(other)))
            coded.append(value)
        return F.array(*coded)

    def finish(x: Column) -> Column:
        flips = F.lit(0)
        for bit in range(bits - 1, 0, -1):
            flips = flips.bitwiseXOR(
                F.when(
                    F.get(x, F.lit(last)).bitwiseAND(F.lit(1 << bit)) != 0, F.lit((1 << bit) - 1)
                ).otherwise(0)
            )
        return F.transform(x, lambda value: value.bitwiseXOR(flips))

    def interleave(x: Column) -> Column:
        index = F.lit(0)
        for bit in range(bits - 1, -1, -1):
            for axis in range(last + 1):
                one = F.shiftright(F.get(x, F.lit(axis)), bit).bitwiseAND(F.lit(1))
                index = F.shiftleft(index, 1).bitwiseOR(one)
        return index

    placed = F.aggregate(steps, axes, turned) if turns else axes
    return let(let(let(placed, gray), finish), interleave)


def hilbert_shards(
    documents: DataFrame,
    shards: int = SHARDS,
    law: str = "rows",
    bits: int = BITS,
    rows_per_run: int = ROWS_PER_RUN,
) -> DataFrame:
    """Put every document into a shard and give it a place there.

    Returns ``doc_id``, ``size`` (UTF-8 bytes and one more), ``text_crc32``, ``law``, ``shard``,
    ``slot``, ``grown_shard`` (null: these laws deal anew when shards are added) and
    ``cell``, the place on the curve. Under the law ``rows`` the numbers of documents differ by one at most; under
    ``bytes`` shards are cut where the running size passes an equal part.

    Null texts count as empty, null metadata as the lowest level; rows without a
    ``doc_id`` are ordered by their text. Repeated rows get slots of their own. Other columns
    are ignored; an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    size = (F.octet_length(text) + 1).cast("bigint")
    point = F.conv(
        F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), text)), 1, _POINT_BITS // 4),
        16, 10,
    ).cast("bigint")
    rows = written(
        documents.select(
            "doc_id",
            size.alias("size"),
            F.crc32(text).alias("text_crc32"),
            leading_bytes(F.col("source")).alias("v0"),
            leading_bytes(F.col("lang")).alias("v1"),
            bit_length(size).alias("v2"),
            F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("v3"),
            point.alias("point"),
        ),
        "hilbert-rows",
    )
    ends = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("size").alias("bytes"),
        *[f(f"v{n}").alias(f"{f.__name__}{n}") for n in range(4) for f in (F.min, F.max)],
    ).first()
    levels = [
        level(F.col(f"v{n}"), ends[f"min{n}"] or 0, ends[f"max{n}"] or 0, bits) for n in range(4)
    ]
    in_cells = written(
        rows.select("doc_id", "size", "text_crc32", "point",
                    curve_index(levels, bits).alias("cell")),
        "hilbert-cells",
    )
    # At most 2 ** (4 * bits) cells, whatever the number of documents.
    cells = in_cells.groupBy("cell").agg(
        F.ceil(F.count(F.lit(1)) / rows_per_run).alias("runs")
    )
    run = F.shiftright(F.col("point") * F.col("runs"), _POINT_BITS)
    in_runs = in_cells.join(F.broadcast(cells), "cell").withColumn("run", run).drop("runs")
    counts = in_runs.groupBy("cell", "run").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")
    )
    # One row per cell and one more per million documents.
    before = Window.orderBy("cell", "run").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(
        counts.select(
            "cell", "run",
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        ),
        "hilbert-starts",
    )
    order = Window.partitionBy("cell", "run").orderBy("point", "doc_id", "size", "text_crc32")
    sums = order.rowsBetween(Window.unboundedPreceding, 0)
    ranked = look_up(
        in_runs.withColumns(
            {"rank": F.row_number().over(order), "passed": F.sum("size").over(sums)}
        ),
        starts, ["cell", "run"], F.col("point"),
    ).withColumns(
        {
            "rank": F.col("rows_before") + F.col("rank") - 1,
            "passed": F.col("bytes_before") + F.col("passed") - F.col("size"),
        }
    )
    if law == "rows":
        total = ends["n"]
        # Integer arithmetic: a quotient in floating point may fall on the wrong side.
        shard = F.expr(f"(rank * {shards}) div {max(total, 1)}")
        dealt = ranked.withColumn("shard", shard.cast("int")).withColumn(
            "slot",
            F.col("rank") - F.expr(f"(cast(shard as bigint) * {total} + {shards - 1}) div {shards}"),
        )
    elif law == "bytes":
        shard = F.expr(f"(passed * {shards}) div {max(ends['bytes'] or 0, 1)}").cast("int")
        dealt = ranked.withColumn("shard", shard)
        firsts = dealt.groupBy("shard").agg(F.min("rank").alias("first"))
        # At most one row per shard.
        dealt = dealt.join(F.broadcast(firsts), "shard").withColumn(
            "slot", F.col("rank") - F.col("first")
        )
    else:
        raise ValueError(f"no law {law!r}: rows or bytes")
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "cell",
    )


def write_shards(documents: DataFrame, folder: str, **parameters) -> None:
    """Write the documents to one folder per shard, in slot order.

    Each document needs a ``doc_id`` of its own; the shard is joined to it by that.
    """
    placed = hilbert_shards(documents, **parameters).select("doc_id", "shard", "slot")
    shards = parameters.get("shards", SHARDS)
    (
        documents.join(placed, "doc_id")
        .repartitionByRange(4 * shards, "shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(folder)
    )
