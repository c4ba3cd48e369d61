"""Nearest vectors by inner product, by multi-index hashing of learned binary codes.

**Codes.** Vectors are lifted onto the unit sphere by one more component, so that the largest
inner product is the smallest angle: ``x -> (x / M, sqrt(1 - |x|^2 / M^2))`` with ``M`` the largest
norm, and ``q -> (q / |q|, 0)``. Principal axes of a bounded sample are rotated until the signs of
the components lose least (iterative quantisation), several times from different
starts, and these signs are the bits.

**Index.** A code is cut into ``m`` substrings, and each block of the index has a table of its
codes for each of them. If two codes differ in ``R = m r + e`` bits, then in one of the first
``e + 1`` substrings they differ in ``r`` bits at most, or in another in ``r - 1``. Looking up all values
so near to a query's substrings finds every code within ``R`` bits. Where that takes more
look-ups than the block has codes, all its codes are compared: the same are found.

**Radius.** The sample gives each query a lower bound of its last neighbour's product, and for
each product the number of bits within which nearly all pairs of at least that product lie.
So vectors with near neighbours look close by, and those without look far. The bound only
rises with more rows, so what the sample teaches holds, on the safe side, for the whole.

**Rerank.** What lies within the radius is ranked by inner products of the original vectors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from keybrook.llm.common import written

NEIGHBOURS = 20
QUERY_EVERY = 20
BITS = 256
SUBSTRING_BITS = 16
# Rows to learn codes and radii from; a documented bound. All rows are indexed.
SAMPLE = 8_192
SAMPLE_QUERIES = 512
# The share of the sample's near pairs that the radius holds.
COVERED = 0.99
ROTATIONS = 20
# Rows, and queries, of a cell of the search at most. They bound a task's memory.
BLOCK_ROWS = 131_072
BLOCK_QUERIES = 131_072
# Blocks are smaller where there are few rows, to occupy the cores.
LEAST_BLOCK_ROWS = 1_024

_PARTS = BITS // SUBSTRING_BITS
_VALUES = 1 << SUBSTRING_BITS
_STEP = 0.01
_FEWEST_PAIRS = 100


@dataclass(frozen=True)
class Hasher:
    """What the sample taught: axes of the bits, the radius by product, and the sample itself."""

    largest: float
    width: int
    axes: np.ndarray
    radius: np.ndarray
    sample: np.ndarray

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors / self.largest
        rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(axis=1)))
        return np.concatenate((scaled, rest[:, None]), axis=1).astype(np.float32)

    def codes(self, lifted: np.ndarray) -> np.ndarray:
        return np.packbits(lifted @ self.axes.T > 0, axis=1)

    def directions(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
        return np.concatenate((unit, np.zeros((len(unit), 1))), axis=1).astype(np.float32)

    def radii(self, directions: np.ndarray, neighbours: int) -> np.ndarray:
        """The bits within which the ``neighbours`` nearest rows of each query lie."""
        if len(self.sample) < neighbours:
            return np.full(len(directions), BITS)
        products = directions @ self.sample.T
        last = np.partition(products, len(self.sample) - neighbours, axis=1)
        bound = last[:, len(self.sample) - neighbours]
        return self.radius[np.clip(((bound + 1) / _STEP).astype(int), 0, len(self.radius) - 1)]


def fit(sample: np.ndarray, largest: float, seed: int = 1) -> Hasher:
    """Learn codes and radii from some vectors, given as rows of doubles."""
    width = sample.shape[1]
    empty = Hasher(largest, width, np.zeros((0, width + 1)), np.zeros(0), np.zeros((0, 0)))
    lifted = empty.lifted(sample)
    _, axes = np.linalg.eigh(lifted.T.astype(np.float64) @ lifted)
    axes = axes[:, ::-1]
    random = np.random.default_rng(seed)
    found: list[np.ndarray] = []
    left = BITS
    while left:
        size = min(left, width + 1)
        own = axes[:, :size]
        projected = lifted @ own
        rotation, _ = np.linalg.qr(random.standard_normal((size, size)))
        for _ in range(ROTATIONS):
            signs = np.where(projected @ rotation > 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(signs.T @ projected)
            rotation = v.T @ u.T
        found.append((own @ rotation).T)
        left -= size
    planes = np.concatenate(found).astype(np.float32)
    hasher = Hasher(largest, width, planes, np.zeros(0), lifted)
    return Hasher(largest, width, planes, _radii(hasher, sample), lifted)


def _radii(hasher: Hasher, sample: np.ndarray) -> np.ndarray:
    """For products from -1 on, by steps, the bits that cover near pairs of the sample."""
    queries = sample[:SAMPLE_QUERIES]
    directions = hasher.directions(queries)
    products = directions @ hasher.sample.T
    codes = _words(hasher.codes(hasher.sample))
    own = _words(hasher.codes(directions))
    bits = np.stack([_distances(codes, code) for code in own.T])
    apart = np.arange(len(sample))[None, :] != np.arange(len(queries))[:, None]
    products, bits = products[apart], bits[apart]
    steps = round(2 / _STEP) + 1
    found = np.full(steps, BITS)
    for step in range(steps):
        near = bits[products >= -1 + step * _STEP]
        if len(near) < _FEWEST_PAIRS:
            found[step:] = found[max(step - 1, 0)]
            break
        found[step] = math.ceil(np.quantile(near, COVERED))
    return np.minimum.accumulate(found)


def _words(codes: np.ndarray) -> np.ndarray:
    """Codes of bytes as columns of 64-bit words."""
    return np.ascontiguousarray(codes.view(np.uint64).T)


def _distances(words: np.ndarray, query: np.ndarray) -> np.ndarray:
    """In how many bits each code differs from that of a query."""
    total = np.zeros(words.shape[1], np.uint16)
    for own, other in zip(words, query):
        total += np.bitwise_count(own ^ other)
    return total


def _balls() -> list[np.ndarray]:
    """By radius, the differences of substrings of up to so many bits."""
    values = np.arange(_VALUES, dtype=np.uint16)
    ones = np.bitwise_count(values)
    return [values[ones <= radius] for radius in range(SUBSTRING_BITS + 1)]


class Block:
    """Some rows of the index, with a table of codes by the value of each substring."""

    def __init__(self, codes: np.ndarray, vectors: np.ndarray, least: np.ndarray):
        self.words, self.vectors, self.least = _words(codes), vectors, least
        self.size = len(codes)
        self.balls = _balls()
        self.orders, self.starts = [], []
        for part in codes.view(np.uint16).T:
            self.orders.append(np.argsort(part, kind="stable").astype(np.int32))
            counts = np.bincount(part, minlength=_VALUES)
            self.starts.append(np.concatenate(([0], np.cumsum(counts))))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """The rows whose codes differ from ``code`` in ``radius`` bits at most."""
        if radius >= BITS:
            return np.arange(self.size)
        near, extra = divmod(radius, _PARTS)
        reach = [near if part <= extra else near - 1 for part in range(_PARTS)]
        probes = sum(len(self.balls[r]) for r in reach if r >= 0)
        word = code.view(np.uint64)
        if probes >= self.size:
            return np.flatnonzero(_distances(self.words, word) <= radius)
        hit = np.zeros(self.size, bool)
        for part, (r, own) in enumerate(zip(reach, code.view(np.uint16))):
            if r < 0:
                continue
            values = (self.balls[r] ^ own).astype(np.int64)
            low, high = self.starts[part][values], self.starts[part][values + 1]
            full = np.flatnonzero(high > low)
            for place in full.tolist():
                hit[self.orders[part][low[place] : high[place]]] = True
        rows = np.flatnonzero(hit)
        return rows[_distances(self.words[:, rows], word) <= radius]

    def nearest(
        self, code: np.ndarray, query: np.ndarray, radius: int, count: int
    ) -> tuple[np.ndarray, list[float]]:
        """The ``count`` rows within the radius with the largest products, ties to small ids.

        Products are exact sums, rounded once, so they do not depend on an order.
        """
        rows = self.within(code, radius)
        if not len(rows):
            return rows, []
        near = self.vectors[rows].astype(np.float64)
        products = near @ query
        if len(rows) > count:
            last = np.partition(products, len(rows) - count)[len(rows) - count]
            kept = products >= last - 1e-9 * np.abs(products).max()
            rows, near = rows[kept], near[kept]
        exact = np.array([math.fsum(row) for row in (near * query).tolist()]) + 0.0
        first = np.lexsort((self.least[rows], -exact))[:count]
        return rows[first], exact[first].tolist()


def _is_usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def distinct_vectors(rows: DataFrame, neighbours: int, query_every: int) -> DataFrame:
    """One row per vector: ``node``, its two hashes, ``vector``, whether a query has it
    (``asks``), and its smallest ``ids``.

    No result needs more than ``neighbours + 1`` of the ids of one vector.
    """
    same = Window.partitionBy("h1", "h2").orderBy("vec_id")
    ids = (
        rows.select("h1", "h2", "vec_id").distinct()
        .withColumn("_place", F.row_number().over(same))
        .where(F.col("_place") <= neighbours + 1)
        .groupBy("h1", "h2").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    vectors = rows.groupBy("h1", "h2").agg(
        F.any_value("vector").alias("vector"),
        F.max(F.col("vec_id") % query_every == 0).alias("asks"),
    )
    joined = vectors.join(ids.hint("merge"), ["h1", "h2"])
    return joined.withColumn("node", F.monotonically_increasing_id())


def usable_rows(rows: DataFrame) -> DataFrame:
    """``vec_id``, ``vector`` of doubles and its two hashes, of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    return (
        rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), vector.alias("vector"))
        .where(F.col("vec_id").isNotNull() & _is_usable(F.col("vector")))
        .select(
            "vec_id", "vector",
            F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2"),
        )
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of doubles, shorter ones padded with zeros."""
    offsets = column.offsets.to_numpy()
    sizes = np.diff(offsets)
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    found = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    found[row, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat
    return found


def _learned(classes: DataFrame) -> Hasher | None:
    norm = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    whole = classes.agg(
        F.sqrt(F.max(norm)).alias("largest"), F.max(F.size("vector")).alias("width")
    ).first()
    if whole.width is None:
        return None
    # The smallest hashes are a sample that no order of the rows can bend.
    sample = classes.select("vector", "h1", "h2").orderBy("h1", "h2").limit(SAMPLE)
    lists = sample.select("vector").toArrow().column("vector").combine_chunks()
    return fit(_matrix(lists, whole.width), whole.largest)


def _encoded(classes: DataFrame, hasher: Hasher, neighbours: int, ask: bool) -> DataFrame:
    """``node``, ``ids``, the ``code``, the ``vector`` as bytes, and a query's ``radius``."""

    def encode(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("vector"), hasher.width)
            if ask:
                lifted = hasher.directions(vectors)
                radius = hasher.radii(lifted, neighbours + 1)
            else:
                lifted, radius = hasher.lifted(vectors), np.zeros(len(vectors))
            codes = hasher.codes(lifted)
            short = vectors.astype(np.float32)
            # Four bytes a component where they say all.
            exact = np.array_equal(short, vectors)
            stored = short if exact else vectors
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    batch.column("ids"),
                    pa.array([code.tobytes() for code in codes], pa.binary()),
                    pa.array([row.tobytes() for row in stored], pa.binary()),
                    pa.array(radius.astype(np.int32)),
                ],
                ["node", "ids", "code", "vector", "radius"],
            )

    return classes.select("node", "ids", "vector").mapInArrow(
        encode, "node bigint, ids array<bigint>, code binary, vector binary, radius int"
    )


def _stacked(column: pa.Array, width: int) -> np.ndarray:
    values = [
        np.frombuffer(value, np.float32 if len(value) == 4 * width else np.float64)
        for value in column.to_pylist()
    ]
    return np.stack(values)


def _codes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BITS // 8)


def _search(batches, width: int, count: int):
    """Cells, sorted by ``cell`` with the rows before the queries, searched one after another."""
    held: list[pa.RecordBatch] = []
    cell = block = ids = None
    for batch in batches:
        if not batch.num_rows:
            continue
        mark = batch.column("cell").to_numpy() * 2 + batch.column("asks").cast(
            pa.int8()).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(mark)) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(mark)]):
            piece = batch.slice(low, high - low)
            now, asks = divmod(int(mark[low]), 2)
            if now != cell:
                held, cell, block = [], now, None
            if not asks:
                held.append(piece)
                continue
            if block is None and held:
                rows = pa.Table.from_batches(held).combine_chunks()
                held = []
                ids = rows["ids"].to_pylist()
                block = Block(
                    _codes(rows["code"]),
                    _stacked(rows["vector"], width),
                    np.array([own[0] for own in ids]),
                )
            if block is not None:
                yield _answers(block, ids, piece, width, count)


def _answers(block: Block, ids: list, piece: pa.RecordBatch, width: int, count: int):
    found: list[tuple] = []
    queries = _stacked(piece.column("vector"), width).astype(np.float64)
    nodes, radii = (piece.column(name).to_pylist() for name in ("node", "radius"))
    for node, code, query, radius in zip(nodes, _codes(piece.column("code")), queries, radii):
        rows, products = block.nearest(code, query, radius, count)
        found += [
            (node, product, ids[row]) for row, product in zip(rows.tolist(), products)
        ]
    columns = list(zip(*found)) or [()] * 3
    kinds = (pa.int64(), pa.float64(), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, kinds)],
        ["node", "score", "ids"],
    )


def nearest_vectors(
    rows: DataFrame, neighbours: int = NEIGHBOURS, query_every: int = QUERY_EVERY
) -> DataFrame:
    """The ``neighbours`` nearest rows of each query, by inner product in double precision.

    ``rows`` have ``vec_id`` and ``embedding``; queries are those whose ``vec_id`` is divisible by
    ``query_every``. Returns ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``; ties go to the
    smaller ``vec_id``. A query's own row is no candidate; where there are fewer, all are found.

    Rows without a ``vec_id`` and vectors that are null, empty, zero or hold null or
    non-finite components take no part. A shorter vector counts as padded with zeros. Equal
    vectors are searched once, however many rows have them. Repeated rows (same ``vec_id`` and
    vector) are one; a ``vec_id`` with several vectors has a place for each of them. Other columns are
    ignored, and an empty table gives an empty result. Vectors are told apart by 128 bits
    of hash.

    The search meets every block of rows with every block of queries. Blocks are bounded,
    so are the tasks; queries stream through a task, and no more than its best leave it.
    """
    spark = rows.sparkSession
    used = usable_rows(rows)
    classes = written(distinct_vectors(used, neighbours, query_every), "vector-classes")
    hasher = _learned(classes)
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if hasher is None:
        return spark.createDataFrame([], schema)
    sizes = classes.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("asks").cast("int")).alias("q"))
    sizes = sizes.first()
    few = -(-sizes.rows // LEAST_BLOCK_ROWS)
    row_blocks = max(
        -(-sizes.rows // BLOCK_ROWS), min(few, 2 * spark.sparkContext.defaultParallelism)
    )
    query_blocks = max(1, -(-sizes.q // BLOCK_QUERIES))

    def dealt(frame: DataFrame, own: int, others: int, cell) -> DataFrame:
        block = F.pmod(F.xxhash64("node"), F.lit(own)).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return (
            frame.withColumn("_own", block).withColumn("_other", other)
            .withColumn("cell", cell(F.col("_own"), F.col("_other")).cast("bigint"))
            .drop("_own", "_other")
        )

    index = dealt(
        _encoded(classes, hasher, neighbours, False).withColumn("asks", F.lit(False)),
        row_blocks, query_blocks, lambda row, query: row * query_blocks + query,
    )
    queries = dealt(
        _encoded(classes.where("asks"), hasher, neighbours, True).withColumn("asks", F.lit(True)),
        query_blocks, row_blocks, lambda query, row: row * query_blocks + query,
    )
    cells = row_blocks * query_blocks
    width, count = hasher.width, neighbours + 1
    found = (
        index.union(queries)
        .repartitionById(cells, F.col("cell").cast("int"))
        .sortWithinPartitions("cell", "asks")
        .mapInArrow(
            lambda batches: _search(batches, width, count),
            "node bigint, score double, ids array<bigint>",
        )
    )
    best = Window.partitionBy("node").orderBy(F.desc("score"), F.col("ids")[0])
    one = F.transform("ids", lambda own: F.struct((-F.col("score")).alias("minus"), own.alias("id")))
    lists = written(
        found.withColumn("_place", F.row_number().over(best))
        .where(F.col("_place") <= count)
        .groupBy("node")
        .agg(F.slice(F.sort_array(F.flatten(F.collect_list(one))), 1, count).alias("nearest")),
        "nearest",
    )
    asked = (
        used.where(F.col("vec_id") % query_every == 0).select("vec_id", "h1", "h2").distinct()
        .join(classes.where("asks").select("h1", "h2", "node"), ["h1", "h2"])
        .select(F.col("vec_id").alias("query_id"), "node")
    )
    others = F.slice(
        F.filter("nearest", lambda one: one["id"] != F.col("query_id")), 1, neighbours
    )
    return asked.join(lists, "node").select("query_id", F.posexplode(others)).select(
        "query_id",
        (F.col("pos") + 1).alias("rank"),
        F.col("col.id").alias("vec_id"),
        (-F.col("col.minus") + F.lit(0.0)).alias("score"),
    )
