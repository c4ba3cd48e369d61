"""What several operators share: words of a text, local bindings, written tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keybrook.session import remove, shared_folder

# The white space that separates words.
WHITE_SPACE = " \t\n\x0b\x0c\r"
WHITE_SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# A table with at most this many rows may be sent to every task; the callers
# count the rows first and have another way for more.
MOST_BROADCAST_ROWS = 100_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with ``value`` computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_list(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    trimmed = F.btrim(text, F.lit(WHITE_SPACE))
    none = F.array().cast("array<string>")
    return F.when(trimmed.isNull() | (trimmed == ""), none).otherwise(
        F.split(trimmed, f"{WHITE_SPACE_CLASS}+")
    )


def lower_ascii(text: Column) -> Column:
    """Lower-case A to Z only. ``lower`` does that, and faster, if all is ASCII."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, CAPITALS, CAPITALS.lower())
    )


def named(value: Column) -> Column:
    """A string that is never null: null becomes "", any other value gets a prefix."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


_REST = "_rest"


def set_apart(frame: DataFrame, *used: str) -> DataFrame:
    """The ``used`` columns, and all others inside one, where no name of theirs can clash."""
    rest = [F.col(f"`{name}`") for name in frame.columns if name not in used]
    return frame.select(*used, (F.struct(*rest) if rest else F.lit(None)).alias(_REST))


def put_back(columns: list[str], *used: str, **changed: Column) -> list[Column]:
    """The ``columns`` of a frame that was ``set_apart``, some of them ``changed``."""
    found = []
    for name in columns:
        if name in changed:
            found.append(changed[name].alias(name))
        else:
            found.append(F.col(name) if name in used else F.col(f"{_REST}.`{name}`"))
    return found


def written(frame: DataFrame, purpose: str, *by: str) -> DataFrame:
    """Write a frame under the cluster's shared folder, and read it from there.

    This cuts the lineage: a lost executor costs the tasks that were running,
    not the stages before. The folder goes when the session's JVM ends.
    """
    spark = frame.sparkSession
    path = shared_folder(spark, purpose)
    remove_at_exit(spark, path)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def forget(frame: DataFrame) -> None:
    """Remove a ``written`` table that nothing will read any more, before the session ends."""
    for folder in {file.rpartition("/")[0] for file in frame.inputFiles()}:
        remove(frame.sparkSession, folder)


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Have Hadoop's file system remove ``path`` when it is closed."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


def look_up(
    rows: DataFrame,
    table: DataFrame,
    key: str | list[str],
    spread_by: Column,
    salts: int = 16,
    how: str = "inner",
) -> DataFrame:
    """Join of many rows with a written table that is small against them, inner or left.

    A table of counted size is broadcast. A larger one is repeated for each of
    some salts, over which a hot key of ``rows`` is spread by ``spread_by``.
    """
    if table.count() <= MOST_BROADCAST_ROWS:
        return rows.join(F.broadcast(table), key, how)
    keys = [key] if isinstance(key, str) else key
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    repeated = table.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")
