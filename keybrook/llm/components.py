"""Connected components of links between numbered nodes, and grouped streams of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from keybrook.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``component``) for each node of the links (``a``, ``b``).

    The component is the smallest node that can be reached. In each round every node takes
    its smallest neighbour, if that is smaller, for its parent, which is one row per node; the
    trees that makes are followed to their roots; and the links are written anew between roots.
    Those inside one tree are gone then. At least half of the nodes that still have links are no
    roots, so rounds are few, and the next ones are small. Rounds are written to the
    shared folder.
    """
    links = written(_ordered(links, "a", "b"), "links")
    ends = F.explode(F.array("a", "b")).alias("node")
    # A set of nodes: each task passes on its own once.
    labels = links.select(ends).distinct().withColumn("component", F.col("node"))
    while links.limit(1).count():
        roots = _roots(links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")))
        moved = roots.select(F.col("node").alias("component"), "root")
        labels = written(
            labels.join(moved, "component", "left").select(
                "node", F.coalesce("root", "component").alias("component")
            ),
            "labels",
        )
        for end in ("a", "b"):
            own = roots.select(F.col("node").alias(end), F.col("root").alias("_root"))
            links = links.join(own, end, "left").withColumn(
                end, F.coalesce("_root", end)
            ).drop("_root")
        links = written(_ordered(links, "a", "b"), "links")
    return labels


def _ordered(links: DataFrame, a: str, b: str) -> DataFrame:
    """Each link once, the smaller node first, none from a node to itself."""
    return links.where(F.col(a) != F.col(b)).select(
        F.least(a, b).alias("a"), F.greatest(a, b).alias("b")
    ).distinct()


def _roots(parents: DataFrame) -> DataFrame:
    """For each node that has a parent the ``root`` above it, by jumping over parents."""
    while True:
        parents = written(parents, "parents")
        above = parents.select(F.col("node").alias("root"), F.col("root").alias("_above"))
        jumped = parents.join(above, "root", "left")
        if not jumped.where(F.col("_above").isNotNull()).limit(1).count():
            return parents
        parents = jumped.select("node", F.coalesce("_above", "root").alias("root"))


def whole_groups(
    batches: Iterator[pa.RecordBatch], key: list[str]
) -> Iterator[tuple[pa.Table, list[int]]]:
    """Batches that are sorted by numeric ``key`` columns, cut anew between keys.

    With each table come the rows at which its groups begin, and its length.
    """
    held: list[pa.RecordBatch] = []

    def finished() -> tuple[pa.Table, list[int]]:
        table = pa.Table.from_batches(held).combine_chunks()
        return table, [*_begins(table, key), table.num_rows]

    for batch in batches:
        if not batch.num_rows:
            continue
        last = _begins(batch, key)[-1]
        if held and _key(held[-1], -1, key) != _key(batch, 0, key):
            yield finished()
            held = []
        if last:
            held.append(batch.slice(0, last))
            yield finished()
            held = []
        held.append(batch.slice(last))
    if held:
        yield finished()


def _key(batch: pa.RecordBatch, row: int, key: list[str]) -> list:
    row %= batch.num_rows
    return [batch.column(name)[row].as_py() for name in key]


def _begins(rows: pa.RecordBatch | pa.Table, key: list[str]) -> list[int]:
    change = np.zeros(rows.num_rows, bool)
    change[0] = True
    for name in key:
        column = rows.column(name).to_numpy(zero_copy_only=False) if isinstance(
            rows, pa.RecordBatch
        ) else rows.column(name).to_numpy()
        change[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(change).tolist()


def in_parts(
    values: pa.Array, work: Callable[[pa.Array], pa.Array], rows: int = 500
) -> pa.Array:
    """``work`` on some rows at a time, for a function of one column."""
    starts = range(0, max(len(values), 1), rows)
    return pa.concat_arrays([work(values.slice(start, rows)) for start in starts])


def parts(
    batches: Iterator[pa.RecordBatch], rows: int = 500, most_bytes: int = 8 << 20
) -> Iterator[pa.RecordBatch]:
    """Smaller batches, for work that takes many times the memory of its input.

    A batch of more than one row has at most ``rows`` of them, and at most ``most_bytes`` of
    strings.
    """
    for batch in batches:
        sizes = np.zeros(batch.num_rows, np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
                sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + most_bytes, "right"))
            stop = min(max(stop, start + 1), start + rows, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop
