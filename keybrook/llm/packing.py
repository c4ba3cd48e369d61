"""Packing of token ids into rows of one length, best fit decreasing.

Documents longer than a row are split, nothing is dropped. The pieces of a block of
documents are placed from the longest to the shortest, each into the row with the
least room that still takes it; a segment tree over capacities finds that row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from keybrook.llm.components import parts
from keybrook.llm.pieces import MODEL, load_model

ROW_LENGTH = 2_048
# About so many tokens are packed together; they bound the memory of a task.
BLOCK_TOKENS = 1_000_000
# Fixed values of the vocabulary: the end of a document, and what fills a row.
END_ID, PAD_ID = 2, 0

_SCHEMA = (
    "pack_id bigint, n_tokens bigint, doc_ids array<bigint>, doc_starts array<bigint>, "
    "segment_ends array<int>, ids array<int>, positions array<int>"
)


class CapacityTree:
    """How many open rows there are of each capacity from 0 to ``most``."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.counts = [0] * (2 * self.size)

    def add(self, capacity: int, times: int = 1) -> None:
        at = capacity + self.size
        while at:
            self.counts[at] += times
            at >>= 1

    def least_from(self, capacity: int) -> int:
        """The least capacity, not below the given one, of which there is a row; or -1."""
        at = capacity + self.size
        if self.counts[at]:
            return capacity
        # Up to the first subtree on the right that has a row, then down to its left end.
        while at > 1 and (at & 1 or not self.counts[at + 1]):
            at >>= 1
        if at <= 1:
            return -1
        at += 1
        while at < self.size:
            at <<= 1
            at += not self.counts[at]
        return at - self.size


def best_fit_decreasing(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Rows of pieces by number. Of equally long pieces, and of rows with equal room, the
    one with the smaller number comes first."""
    rows: list[list[int]] = []
    open_rows: list[list[int]] = [[] for _ in range(length + 1)]
    tree = CapacityTree(length)
    for piece in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[piece])
        room = tree.least_from(size)
        if room < 0:
            row, room = len(rows), length
            rows.append([])
        else:
            row = open_rows[room].pop()
            tree.add(room, -1)
        rows[row].append(piece)
        open_rows[room - size].append(row)
        tree.add(room - size)
    return rows


def pieces_of(ids: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """Where each piece of a document starts, and its ids."""
    for start in range(0, len(ids), length):
        yield start, ids[start : start + length]


def _packed(block: list[tuple[int | None, int, np.ndarray]], length: int, first: int):
    """The rows of a block of (doc_id, start, ids), as a batch of Arrow."""
    sizes = np.array([len(ids) for _, _, ids in block], np.int64)
    rows = best_fit_decreasing(sizes, length)
    order = [piece for row in rows for piece in row]
    matrix = np.full((len(rows), length), PAD_ID, np.int32)
    positions = np.zeros((len(rows), length), np.int32)
    ends = []
    for number, row in enumerate(rows):
        at = 0
        for piece in row:
            size = int(sizes[piece])
            matrix[number, at : at + size] = block[piece][2]
            positions[number, at : at + size] = np.arange(size)
            at += size
            ends.append(at)
    cuts = np.concatenate(([0], np.cumsum([len(row) for row in rows]))).astype(np.int32)
    used = np.array([ends[cut - 1] for cut in cuts[1:]], np.int64)
    edges = np.arange(len(rows) + 1, dtype=np.int32) * length

    def lists(offsets, values, kind):
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))

    # Cumulative lengths start with 0, so each row has one more of them than segments.
    cumulative = np.insert(np.array(ends, np.int32), cuts[:-1], 0)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.arange(first, first + len(rows)), pa.int64()),
            pa.array(used),
            lists(cuts, [block[piece][0] for piece in order], pa.int64()),
            lists(cuts, [block[piece][1] for piece in order], pa.int64()),
            lists(cuts + np.arange(len(rows) + 1), cumulative, pa.int32()),
            lists(edges, matrix.reshape(-1), pa.int32()),
            lists(edges, positions.reshape(-1), pa.int32()),
        ],
        ["pack_id", "n_tokens", "doc_ids", "doc_starts", "segment_ends", "ids", "positions"],
    )


def pack_documents(
    documents: DataFrame,
    row_length: int = ROW_LENGTH,
    block_tokens: int = BLOCK_TOKENS,
    model: str = MODEL,
) -> DataFrame:
    """Rows of ``row_length`` token ids that hold every token of every document once.

    Returns ``pack_id``, ``n_tokens`` (without the filling), ``doc_ids`` and ``doc_starts`` (for
    each segment the document, and where in its ids the segment starts),
    ``segment_ends`` (cumulative lengths, from 0), ``ids`` and ``positions`` (from 0 in each
    segment). Each document ends with ``END_ID``.

    Every task packs the documents it reads, block by block, so nothing is shuffled and
    a task that runs again makes the same rows. Null and empty texts have no tokens and
    are in no row; repeated rows are packed each; a null ``doc_id`` is carried as null. Other
    columns are ignored; an empty table gives no rows.
    """
    pieces = load_model(model)

    def pack(batches):
        first = TaskContext.get().partitionId() << 40
        block, tokens = [], 0
        for batch in parts(batches, 256):
            keys, texts = (batch.column(name).to_pylist() for name in ("doc_id", "text"))
            for key, ids in zip(keys, pieces.encode(texts)):
                if ids is None or not len(ids):
                    continue
                ids = np.append(ids, np.int32(END_ID))
                for start, piece in pieces_of(ids, row_length):
                    block.append((key, start, piece))
                    tokens += len(piece)
                    if tokens >= block_tokens:
                        packed = _packed(block, row_length, first)
                        first += packed.num_rows
                        block, tokens = [], 0
                        yield packed
        if block:
            yield _packed(block, row_length, first)

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        pack, _SCHEMA
    )


def write_packed(documents: DataFrame, folder: str, **parameters) -> None:
    """Write the rows as binary: little-endian 32-bit ids, and the rest beside them."""
    rows = pack_documents(documents, **parameters)

    def to_bytes(batches):
        for batch in batches:
            own = {name: batch.column(name) for name in batch.schema.names}
            for name in ("ids", "positions", "segment_ends"):
                lists = own[name]
                cuts = lists.offsets.to_numpy()
                flat = lists.values.to_numpy().astype("<i4")
                own[name] = pa.array(
                    [flat[low:high].tobytes() for low, high in zip(cuts[:-1], cuts[1:])],
                    pa.binary(),
                )
            yield pa.RecordBatch.from_pydict(own)

    rows.mapInArrow(
        to_bytes,
        "pack_id bigint, n_tokens bigint, doc_ids array<bigint>, doc_starts array<bigint>, "
        "segment_ends binary, ids binary, positions binary",
    ).write.parquet(folder)
