"""Texts packed for their way through a shuffle."""

from __future__ import annotations

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from keybrook.llm.common import MOST_BROADCAST_ROWS
from keybrook.llm.components import parts


def packed_texts(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key`` and the text, packed for the way through a shuffle."""

    def pack(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for batch in parts(batches):
            data = [
                (text or "").encode("utf-8", "surrogatepass")
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"),
                 pa.array([packer.compress(one) for one in data], pa.binary())],
                ["doc_id", "text_key", "packed"],
            )

    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
        "text",
    )
    return rows.mapInArrow(pack, "doc_id bigint, text_key bigint, packed binary")


def chosen_texts(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node`` and the packed text of the documents whose ``doc_id`` is a ``node`` of ``wanted``.

    ``wanted`` is a written table. If it is small it is sent to where the documents are
    read, and only texts that are wanted are packed; otherwise the packed texts are shuffled.
    """
    named = documents.where(F.col("doc_id").isNotNull())
    node = F.col("doc_id").cast("bigint")
    if wanted.count() <= MOST_BROADCAST_ROWS:
        own = F.broadcast(wanted.select(F.col("node").alias("_node")))
        named = named.select("doc_id", "text").join(own, node == F.col("_node"), "left_semi")
        return packed_texts(named).select(F.col("doc_id").alias("node"), "packed")
    # The hint keeps the texts from being sorted out by a broadcast that was not counted.
    return (
        packed_texts(named)
        .select(F.col("doc_id").alias("node"), "packed")
        .join(wanted.select("node").hint("merge"), "node")
    )


def unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)
