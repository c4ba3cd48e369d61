"""Word count of lines of text: the final table and the running changelog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from keybrook.functions.text import split_text, without_trailing_empty
from keybrook.operators.changelog import HOT_ROWS, ROWS_PER_BLOCK, running_count
from keybrook.operators.tables import count_by_key
from keybrook.streaming.changelog import read_changelog, start_running_count
from keybrook.streaming.sinks import Sink, write_each_batch


def keyed_words(lines: DataFrame) -> DataFrame:
    """One record per word: the word as ``key``, its place in the line as ``pos``.

    The other columns of the line are kept, save its own key and value.
    """
    kept = [name for name in lines.columns if name not in ("key", "value")]
    split = lines.select(*kept, split_text(F.col("value")).alias("parts"))
    return split.select(
        *kept, F.posexplode(without_trailing_empty(F.col("parts"))).alias("pos", "key")
    )


def pack_words(lines: DataFrame) -> DataFrame:
    """The words of each line as one text: no word has a space, so one stands between two.

    The other columns of the line are kept, save its key. A line without words has no text.
    """
    kept = [name for name in lines.columns if name not in ("key", "value")]
    split = lines.select(*kept, split_text(F.col("value")).alias("parts"))
    found = split.select(*kept, without_trailing_empty(F.col("parts")).alias("found"))
    joined = F.when(F.size("found") > 0, F.array_join("found", " "))
    return found.select(*kept, joined.alias("value"))


def unpack_words(packed: DataFrame) -> DataFrame:
    """What ``keyed_words`` gives of the lines that ``pack_words`` was given."""
    kept = [name for name in packed.columns if name != "value"]
    return packed.select(*kept, F.posexplode(F.split("value", " ", -1)).alias("pos", "key"))


def word_counts(lines: DataFrame) -> DataFrame:
    """``key`` (the word) and ``count``, over all lines."""
    split = lines.select(split_text(F.col("value")).alias("parts"))
    return count_by_key(
        split.select(F.explode(without_trailing_empty(F.col("parts"))).alias("key"))
    )


def word_changelog(
    lines: DataFrame,
    order_by: Sequence[str] = ("offset",),
    rows_per_block: int = ROWS_PER_BLOCK,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One record per word read, with the word's count so far.

    ``order_by`` orders the lines; the order of words in a line is ``pos``.
    """
    return running_count(
        lines.select("value", *order_by),
        order_by,
        split=keyed_words,
        split_order=["pos"],
        packing=(pack_words, unpack_words),
        # Between two words there is a character, and each but the first has one or more; the
        # first may be empty.
        most_per_row=F.floor(F.char_length("value") / 2) + 1,
        rows_per_block=rows_per_block,
        hot_rows=hot_rows,
    )


def start_word_counts(
    lines: DataFrame, sink: Sink, checkpoint: str, name: str = "word-count", once: bool = False
) -> StreamingQuery:
    """Keep counting. Each micro-batch emits the new count of each word it holds.

    The counts are Spark's streaming state and go on after a restart from the
    same checkpoint. Run it under two names and checkpoints for two independent
    applications on the same lines.
    """
    return write_each_batch(
        word_counts(lines), sink, name, checkpoint, once, output_mode="update"
    )


def read_word_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The table of counts as of the last micro-batch, from Spark's state store.

    It costs the size of the table, however often its counts were emitted.
    """
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.key", F.col("value.count").alias("count"))


def start_word_changelog(
    lines: DataFrame,
    root: str,
    checkpoint: str,
    name: str = "word-changelog",
    once: bool = False,
    order_by: Sequence[str] = ("offset",),
    rows_per_block: int = ROWS_PER_BLOCK,
    hot_rows: int = HOT_ROWS,
    sink: Sink | None = None,
) -> StreamingQuery:
    """Emit one record per word read, with the word's count so far."""
    return start_running_count(
        lines.select("value", *order_by),
        order_by,
        root,
        checkpoint,
        name,
        once,
        split=keyed_words,
        split_order=["pos"],
        packing=(pack_words, unpack_words),
        rows_per_block=rows_per_block,
        hot_rows=hot_rows,
        sink=sink,
    )


def read_word_changelog(spark: SparkSession, root: str, order_schema: str) -> DataFrame:
    return read_changelog(spark, root, f"{order_schema}, pos int, key string, count bigint")
