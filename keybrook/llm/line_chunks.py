"""Dedup of runs of lines whose ends the content itself chooses.

A rolling hash over the hashes of the last lines decides where a chunk ends, so an
inserted line shifts no later boundary. Chunks of several lines that occur more than
once are found by their hash, compared byte by byte, and removed everywhere but where
they come first.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from keybrook.llm.common import let, look_up, put_back, set_apart, written
from keybrook.llm.components import parts

# A chunk ends after a line if the hash of the last WINDOW lines is a multiple of
# DIVISOR, and after MOST_LINES anyway. Only chunks of LEAST_LINES or more are removed.
WINDOW = 2
DIVISOR = 4
LEAST_LINES = 2
MOST_LINES = 256

_MASK = (1 << 64) - 1


def _rotated(value: int, by: int) -> int:
    return ((value << by) | (value >> (64 - by))) & _MASK


def chunk_sizes(
    lines: list[bytes],
    window: int = WINDOW,
    divisor: int = DIVISOR,
    most_lines: int | None = MOST_LINES,
) -> list[int]:
    """How many lines each chunk of a document has.

    A chunk ends where the hash of the last ``window`` lines says so, and after ``most_lines``
    anyway; with None only the hash decides.
    """
    sizes, size, rolling = [], 0, 0
    hashes = [xxhash.xxh3_64_intdigest(line) for line in lines]
    for at, own in enumerate(hashes):
        rolling = _rotated(rolling, 1) ^ own
        if at >= window:
            rolling ^= _rotated(hashes[at - window], window)
        size += 1
        # The low bits of a sum of rotations say little by themselves.
        mixed = (rolling * 0x9E3779B97F4A7C15 & _MASK) >> 40
        if mixed % divisor == 0 or size == most_lines:
            sizes.append(size)
            size = 0
    return [*sizes, size] if size else sizes


def _chunks(text: str | None) -> list[tuple[int, int, bytes]]:
    """(first line, number of lines, bytes) of the chunks that may be removed."""
    if not text:
        return []
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    found, at = [], 0
    for size in chunk_sizes(lines):
        content = b"\n".join(lines[at : at + size])
        if size >= LEAST_LINES and content.strip():
            found.append((at, size, content))
        at += size
    return found


def _row_key() -> list[Column]:
    """What tells documents apart: rows alike in both are one document."""
    return [F.col("doc_id"), F.xxhash64("text").alias("text_key")]


def repeated_chunks(documents: DataFrame) -> DataFrame:
    """For each document the ``removed`` chunks: an array of (``at``, ``lines``).

    ``doc_id`` and ``text_key`` name the document. Of equal chunks the first in the order
    of ``doc_id`` (null last), text and place stays.
    """
    rows = documents.where(F.col("text").contains("\n")).select(*_row_key(), "text")
    # The key's type is what the caller's table has.
    kind = documents.schema["doc_id"].dataType.simpleString()

    def hashes(batches):
        for batch in parts(batches):
            found = [_chunks(text) for text in batch.column("text").to_pylist()]
            times = [n for n, own in enumerate(found) for _ in own]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(times, pa.int64())),
                    batch.column("text_key").take(pa.array(times, pa.int64())),
                    pa.array([at for own in found for at, _, _ in own], pa.int32()),
                    pa.array(
                        [xxhash.xxh64_intdigest(content) - (1 << 63)
                         for own in found for _, _, content in own], pa.int64(),
                    ),
                ],
                ["doc_id", "text_key", "at", "chunk"],
            )

    chunks = written(
        rows.mapInArrow(hashes, f"doc_id {kind}, text_key bigint, at int, chunk bigint"),
        "chunk-hashes",
    )
    often = written(
        chunks.groupBy("chunk").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("chunk"),
        "often-chunks",
    )
    wanted = (
        look_up(chunks, often, "chunk", F.struct("text_key", "at"))
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
        .agg(F.collect_set("at").alias("wanted"))
    )

    def contents(batches):
        for batch in parts(batches):
            places, ats, sizes, digests, texts = [], [], [], [], []
            for n, (text, wanted) in enumerate(zip(
                batch.column("text").to_pylist(), batch.column("wanted").to_pylist()
            )):
                wanted = set(wanted)
                for at, size, content in _chunks(text):
                    if at in wanted:
                        places.append(n)
                        ats.append(at)
                        sizes.append(size)
                        digests.append(xxhash.xxh64_intdigest(content) - (1 << 63))
                        texts.append(content)
            taken = pa.array(places, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(taken), batch.column("text_key").take(taken),
                    pa.array(ats, pa.int32()), pa.array(sizes, pa.int32()),
                    pa.array(digests, pa.int64()), pa.array(texts, pa.binary()),
                ],
                ["doc_id", "text_key", "at", "lines", "chunk", "content"],
            )

    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    candidates = written(
        rows.join(wanted, same)
        .select("doc_id", "text_key", "text", "wanted")
        .mapInArrow(
            contents,
            f"doc_id {kind}, text_key bigint, at int, lines int, chunk bigint, content binary",
        ),
        "chunk-contents",
    )
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key", "at")
    # Grouping by the content compares the bytes; the hash only says where they meet.
    firsts = (
        candidates.groupBy("chunk", "content")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    return (
        candidates.join(firsts, ["chunk", "content"])
        .where(place != F.col("first"))
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set(F.struct("at", "lines")).alias("removed"))
    )


def without_chunks(text: Column, removed: Column) -> Column:
    """The lines of a text that are in no removed chunk.

    Chunks do not overlap, so what is left are the runs of lines between them.
    """

    def left(lines: Column) -> Column:
        chunks = F.array_sort(removed)
        begins = F.concat(
            F.array(F.lit(0)), F.transform(chunks, lambda chunk: chunk["at"] + chunk["lines"])
        )
        ends = F.concat(F.transform(chunks, lambda chunk: chunk["at"]), F.array(F.size(lines)))
        runs = F.zip_with(
            begins, ends, lambda begin, end: F.slice(lines, begin + 1, end - begin)
        )
        return F.array_join(F.flatten(runs), "\n")

    return let(F.split(text, "\n"), left)


def remove_repeated_chunks(documents: DataFrame) -> DataFrame:
    """The documents with their own columns, ``text`` without repeated chunks, ``removed``.

    ``removed`` is an array of (``at``, ``lines``): the first line and the number of lines of
    each removed chunk; null if there is none. Null and empty texts and texts of one
    line stay as they are, and so do chunks without any content. Rows alike in ``doc_id``
    and text are one document and keep the same. A column of the input that is named
    ``removed`` is replaced. An empty table gives an empty result.
    """
    found = repeated_chunks(documents).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"),
        F.col("removed").alias("_removed"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key"))
    own = [name for name in documents.columns if name != "removed"]
    used = ("doc_id", "text")
    text = F.when(F.col("_removed").isNull(), F.col("text")).otherwise(
        without_chunks(F.col("text"), F.col("_removed"))
    )
    return set_apart(documents, *used).join(found, same, "left").select(
        *put_back(own, *used, text=text), F.col("_removed").alias("removed")
    )


def chunk_dedup(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_removed_chunks``, ``n_removed_lines`` and ``kept_sha256``."""
    kept = remove_repeated_chunks(
        documents.select("doc_id", "text", F.size(F.split("text", "\n")).alias("n_lines"))
    )
    return kept.select(
        "doc_id",
        F.coalesce(F.greatest("n_lines", F.lit(0)), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed_chunks"),
        F.coalesce(
            F.aggregate("removed", F.lit(0), lambda n, chunk: n + chunk["lines"]), F.lit(0)
        ).cast("bigint").alias("n_removed_lines"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )
