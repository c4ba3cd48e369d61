"""Quality rules: lines that many documents of a host share are not content.

Lines are normalised and hashed; for each host and hash the documents are counted;
lines in more documents than the limits allow are removed; documents that lose too
much are rejected. Beside this verdict stand some counts over each text by itself.

All of it is in Column expressions. Only hashes and counts are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from keybrook.llm.common import WORD_CLASS, let, named, word_list

# Limits: a line is removed if it stands in more than MOST_DOCS documents of its
# host and in more than MOST_SHARE of them. A document is depleted if less than
# LEAST_LEFT of its words are left.
MOST_DOCS = 5
MOST_SHARE = 0.02
LEAST_LEFT = 0.3

LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
WINDOW_WORDS = 8
SYMBOLS = r"[#*$%&|<>]"


def repeated_words(words: Column, size: int = WINDOW_WORDS) -> Column:
    """How many words are in windows of ``size`` words that occur twice or more.

    ``size`` is a power of two: hashes of windows are paired up to twice the
    length at each step. Only texts in which a hash repeats are looked at closer.
    """

    def longer(hashes: Column, step: int) -> Column:
        return let(
            hashes,
            lambda h: F.zip_with(
                h, F.slice(h, step + 1, F.size(h)), lambda a, b: F.xxhash64(a, b)
            ),
        )

    hashes = F.transform(words, lambda word: F.xxhash64(word))
    step = 1
    while step < size:
        hashes, step = longer(hashes, step), step * 2
    windows = F.slice(hashes, 1, F.greatest(F.size(words) - (size - 1), F.lit(0)))

    def covered(starts: Column) -> Column:
        state = F.struct(F.lit(0).alias("words"), F.lit(0).alias("end"))
        return F.aggregate(
            starts,
            state,
            lambda s, start: F.struct(
                (s["words"] + start + size - F.greatest(start, s["end"])).alias("words"),
                (start + size).alias("end"),
            ),
            lambda s: s["words"],
        )

    def starts(windows: Column) -> Column:
        placed = F.array_sort(
            F.transform(windows, lambda h, at: F.struct(h.alias("h"), at.alias("at")))
        )
        return let(
            placed,
            lambda p: F.array_sort(
                F.transform(
                    F.filter(
                        p,
                        lambda x, n: (F.get(p, n - 1)["h"] == x["h"])
                        | (F.get(p, n + 1)["h"] == x["h"]),
                    ),
                    lambda x: x["at"],
                )
            ),
        )

    return let(
        windows,
        lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(
            covered(starts(w))
        ),
    )


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD_CLASS))


def base_counts(text: Column) -> Column:
    """A struct of the counts over one text; all zero for null."""
    whole = F.coalesce(text, F.lit(""))
    return let(
        word_list(whole),
        lambda words: F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            (F.char_length(whole) - F.char_length(F.regexp_replace(whole, SYMBOLS, "")))
            .cast("bigint")
            .alias("n_symbols"),
            let(
                lines_with_words(whole),
                lambda lines: F.size(lines) - F.size(F.array_distinct(lines)),
            )
            .cast("bigint")
            .alias("n_dup_lines"),
            repeated_words(words).cast("bigint").alias("n_repeat_words"),
        ),
    )


def normal_line(line: Column) -> Column:
    return F.lower(F.array_join(word_list(line), " "))


def frequent_lines(
    documents: DataFrame, most_docs: int = MOST_DOCS, most_share: float = MOST_SHARE
) -> DataFrame:
    """``host`` and ``line`` (a hash) of the lines above the limits.

    A document counts once for each of its lines. Counts are summed in each task
    first, so a line in a third of all documents costs one row per task.
    """
    host = named(F.col("source")).alias("host")
    hashes = F.array_distinct(
        F.transform(
            lines_with_words(F.col("text")), lambda line: F.xxhash64(normal_line(line))
        )
    )
    counts = (
        documents.select(host, F.explode(hashes).alias("line"))
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("docs"))
        .where(F.col("docs") > most_docs)
    )
    hosts = documents.groupBy(host).agg(F.count(F.lit(1)).alias("host_docs"))
    return (
        counts.join(hosts, "host")
        .where(F.col("docs") > F.col("host_docs") * most_share)
        .select("host", "line")
    )


def line_frequency_verdicts(
    documents: DataFrame,
    most_docs: int = MOST_DOCS,
    most_share: float = MOST_SHARE,
    least_left: float = LEAST_LEFT,
) -> DataFrame:
    """Counts and verdict for each document.

    Returns ``doc_id``, the counts of ``base_counts``, ``removed_words`` (those of
    the removed lines), ``base_failed`` and ``kept``. A null source is a host of its own;
    a null or empty text has no words and fails. Rows count as documents each,
    even if they repeat; rows alike in ``doc_id``, ``source`` and ``text`` get the
    same result. Other columns are ignored; an empty table gives an empty result.
    """
    same = ["doc_id", "host", "text_hash"]
    rows = documents.select(
        "doc_id",
        named(F.col("source")).alias("host"),
        F.xxhash64("text").alias("text_hash"),
        "text",
    )
    lines = rows.select(
        *same, F.posexplode(lines_with_words(F.col("text"))).alias("at", "content")
    ).select(
        *same,
        "at",
        F.size(word_list(F.col("content"))).alias("words"),
        F.xxhash64(normal_line(F.col("content"))).alias("line"),
    )
    removed = (
        lines.join(frequent_lines(documents, most_docs, most_share), ["host", "line"])
        .groupBy(*same)
        .agg(F.collect_set(F.struct("at", "words")).alias("hits"))
        .select(
            *[F.col(name).alias(f"_{name}") for name in same],
            F.aggregate("hits", F.lit(0), lambda n, hit: n + hit["words"])
            .cast("bigint")
            .alias("_removed"),
        )
    )
    counted = rows.select(*same, base_counts(F.col("text")).alias("base"))
    joined = counted.join(
        removed,
        F.col("doc_id").eqNullSafe(F.col("_doc_id"))
        & (F.col("host") == F.col("_host"))
        & (F.col("text_hash") == F.col("_text_hash")),
        "left",
    ).select("doc_id", "base.*", F.coalesce("_removed", F.lit(0)).alias("removed_words"))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT
    )
    depleted = F.col("n_words") - F.col("removed_words") < F.col("n_words") * least_left
    return joined.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


ORACLE_SQL = rf"""
WITH docs AS (
  SELECT doc_id, source, text, row_number() OVER () AS r FROM documents),
words AS (
  SELECT r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM docs),
placed AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM words),
windows AS (
  SELECT r, pos, list(word) OVER (PARTITION BY r ORDER BY pos
    ROWS BETWEEN CURRENT ROW AND {WINDOW_WORDS - 1} FOLLOWING) AS win FROM placed),
repeats AS (
  SELECT r, pos FROM windows WHERE len(win) = {WINDOW_WORDS}
  QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
covered AS (
  SELECT r, count(DISTINCT pos + step) AS n FROM repeats, range({WINDOW_WORDS}) AS s(step)
  GROUP BY r),
lines AS (
  SELECT r, doc_id, source, line, lower(array_to_string(
      regexp_extract_all(line, '[^\x20\x09-\x0D]+'), ' ')) AS norm,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT r, doc_id, source, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dups AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r),
hosts AS (
  SELECT source, count(*) AS n FROM documents GROUP BY source),
frequent AS (
  SELECT l.source, l.norm FROM (
    SELECT source, norm, count(DISTINCT r) AS n FROM lines GROUP BY source, norm) l
  JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
  WHERE l.n > {MOST_DOCS} AND l.n > h.n * {MOST_SHARE}::DOUBLE),
removed AS (
  SELECT r, sum(words)::BIGINT AS n FROM lines l JOIN frequent f
    ON l.source IS NOT DISTINCT FROM f.source AND l.norm = f.norm
  GROUP BY r),
counts AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
    length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(coalesce(text, ''), '{SYMBOLS}'))::BIGINT AS n_symbols,
    coalesce(dups.n, 0)::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    coalesce(removed.n, 0)::BIGINT AS removed_words
  FROM docs d JOIN words USING (r) LEFT JOIN dups USING (r) LEFT JOIN covered USING (r)
  LEFT JOIN removed USING (r)),
judged AS (
  SELECT *, n_words < {LEAST_WORDS}
    OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed
  FROM counts)
SELECT *, NOT base_failed
  AND NOT (n_words - removed_words < n_words * {LEAST_LEFT}::DOUBLE) AS kept
FROM judged
"""
