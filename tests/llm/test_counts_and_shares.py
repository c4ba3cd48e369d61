"""Line frequency, mixing, shards and digests against plain code."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
import samples
from pyspark.sql import functions as F

from keybrook.llm import hilbert
from keybrook.llm.common import shared_folder
from keybrook.llm.digest_index import DigestIndex, digests_of, keep_largest
from keybrook.llm.line_frequency import line_frequency_verdicts
from keybrook.llm.mixing import documents_of_mix, mix_sources, targets


def base_counts(text):
    text = text or ""
    words = samples.words_of(text)
    windows = [tuple(words[n : n + 8]) for n in range(len(words) - 7)]
    often = Counter(windows)
    covered = {n + step for n, w in enumerate(windows) if often[w] > 1 for step in range(8)}
    lines = [line for line in text.split("\n") if samples.words_of(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(char in "#*$%&|<>" for char in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_line_frequency(documents, rows):
    lines = {}
    for n, row in enumerate(rows):
        for line in (row.text or "").split("\n"):
            if samples.words_of(line):
                key = (row.source, " ".join(samples.words_of(line)).lower())
                lines.setdefault(key, set()).add(n)
    hosts = Counter(row.source for row in rows)
    expected = []
    for row in rows:
        counts = base_counts(row.text)
        removed = 0
        for line in (row.text or "").split("\n"):
            words = samples.words_of(line)
            if words:
                key = (row.source, " ".join(words).lower())
                if len(lines[key]) > 3 and len(lines[key]) > 0.05 * hosts[row.source]:
                    removed += len(words)
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        kept = not failed and counts[0] - removed >= 0.3 * counts[0]
        expected.append((row.doc_id, *counts, removed, failed, kept))
    got = line_frequency_verdicts(documents, most_docs=3, most_share=0.05).collect()
    assert Counter(map(tuple, got)) == Counter(expected)
    assert any(x[6] for x in expected) and any(not x[7] and not x[8] for x in expected)


def test_targets_stop_at_the_ceiling(spark):
    sizes = {"a": 10, "b": 1000, "c": 50, None: 0}
    frame = spark.createDataFrame(
        [(f"={name}" if name else "", name, size) for name, size in sizes.items()],
        "source_key string, source string, source_size bigint",
    )
    got = {row.source: row.target for row in targets(frame, 1.5, (3, 1, 2), 2).collect()}
    # Resharing by hand: 1590 by weights 3, 1, 2, 3; a, c and null are capped.
    assert got["a"] == 20 and got["c"] == 100 and got[None] == 0
    assert got["b"] == pytest.approx(1470)


def test_mix_meets_targets_and_is_nested(documents, rows):
    got = mix_sources(documents).collect()
    sizes = Counter()
    taken = Counter()
    for row in got:
        sizes[row.source] += row.size
        taken[row.source] += row.taken
        assert row.taken in (0, row.size, 2 * row.size)
    largest = defaultdict(int)
    for row in got:
        assert row.source_size == sizes[row.source]
        largest[row.source] = max(largest[row.source], row.size)
    for row in got:
        assert abs(taken[row.source] - row.target) <= largest[row.source]
    assert sum({r.source: r.target for r in got}.values()) == pytest.approx(
        1.5 * sum(sizes.values())
    )
    assert sorted(map(str, got)) == sorted(map(str, mix_sources(documents).collect()))
    mixed = Counter(row.doc_id for row in documents_of_mix(documents).collect())
    times = Counter()
    for row in got:
        times[row.doc_id] += row.times
    assert mixed == Counter({key: n for key, n in times.items() if n})


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_shards(documents, rows, law):
    got = hilbert.hilbert_shards(documents, law=law, rows_per_run=7).collect()
    expected = Counter(
        (row.doc_id, len((row.text or "").encode()) + 1, zlib.crc32((row.text or "").encode()))
        for row in rows
    )
    assert Counter((row.doc_id, row["size"], row.text_crc32) for row in got) == expected
    slots = defaultdict(list)
    bytes_of = Counter()
    for row in got:
        slots[row.shard].append(row.slot)
        bytes_of[row.shard] += row["size"]
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    if law == "rows":
        assert set(slots) == set(range(8))
        counts = [len(own) for own in slots.values()]
        assert max(counts) - min(counts) <= 1
    else:
        largest = max(row["size"] for row in got)
        assert all(n <= sum(bytes_of.values()) / 8 + largest for n in bytes_of.values())
    order = sorted(got, key=lambda row: (row.shard, row.slot))
    assert [row.cell for row in order] == sorted(row.cell for row in got)


@pytest.mark.parametrize("bits, axes", [(1, 2), (2, 2), (3, 2), (2, 3), (2, 4)])
def test_curve_visits_each_cell_and_steps_to_a_neighbour(spark, bits, axes):
    from pyspark.sql import functions as F

    cells = spark.range(1 << bits * axes).select(
        *[
            F.shiftright("id", bits * axis).bitwiseAND(F.lit((1 << bits) - 1)).cast("int").alias(f"x{axis}")
            for axis in range(axes)
        ]
    )
    index = hilbert.curve_index([F.col(f"x{axis}") for axis in range(axes)], bits)
    got = sorted(cells.select(index.alias("place"), "*").collect())
    assert [row.place for row in got] == list(range(1 << bits * axes))
    for a, b in zip(got, got[1:]):
        assert sum(abs(x - y) for x, y in zip(a[1:], b[1:])) == 1


def normal(text):
    return (text or "").translate(samples.LOWER)


def test_digests(documents, rows):
    groups = defaultdict(list)
    for row in rows:
        groups[normal(row.text)].append(row.doc_id)
    keep = {
        text: max((key for key in ids if key is not None), default=None)
        for text, ids in groups.items()
    }
    expected = Counter(
        (
            row.doc_id,
            keep[normal(row.text)],
            len(groups[normal(row.text)]),
            row.doc_id == keep[normal(row.text)],
            hashlib.sha256(normal(row.text).encode()).hexdigest(),
        )
        for row in rows
    )
    assert Counter(map(tuple, keep_largest(documents).collect())) == expected


def test_index_persists_and_appends_only_what_is_new(spark):
    folder = shared_folder(spark, "test-index")
    first = spark.createDataFrame([(1, "a"), (2, "b"), (5, "A")], "doc_id bigint, text string")
    second = spark.createDataFrame([(9, "a"), (4, "c"), (3, "c")], "doc_id bigint, text string")
    DigestIndex(spark, folder, 4).append(digests_of(first))
    again = DigestIndex(spark, folder, 4)
    again.append(digests_of(second))
    assert sorted(row.keep_id for row in again.rows().collect()) == [2, 4, 5]
    again.append(digests_of(second))
    assert again.rows().count() == 3


def test_written_shards_hold_few_values_of_each_dimension(spark, tmp_path):
    languages, sources = ["de", "en", "es", "fr"], [f"{chr(97 + n)}-source" for n in range(12)]
    rows = [(n, "w " * (1 + n * 7 % 40), languages[n % 4], sources[n * 5 % 12], n)
            for n in range(2400)]
    docs = spark.createDataFrame(rows, samples.SCHEMA)
    hilbert.write_shards(docs, str(tmp_path / "shards"))
    stored = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(row.doc_id for row in stored.collect()) == list(range(2400))
    placed = {row.doc_id: (row.shard, row.slot) for row in hilbert.hilbert_shards(docs).collect()}
    assert all(placed[row.doc_id] == (row.shard, row.slot) for row in stored.collect())
    # A reader of one language, or of one source, finds shards to leave out, by what they hold.
    held = [
        (set(own.langs), set(own.sources))
        for own in stored.groupBy("shard").agg(
            F.collect_set("lang").alias("langs"), F.collect_set("source").alias("sources")
        ).collect()
    ]
    assert len(held) == 8
    left_out = [sum(name not in langs for langs, _ in held) for name in languages]
    left_out_sources = [sum(name not in own for _, own in held) for name in sources]
    assert sum(left_out) / 4 >= 2 and sum(left_out_sources) / 12 >= 2


def test_an_index_is_opened_with_its_own_buckets(spark):
    folder = shared_folder(spark, "test-index")
    frame = spark.createDataFrame([(n, f"text {n}") for n in range(200)], "doc_id bigint, text string")
    made = DigestIndex(spark, folder, 4)
    made.append(digests_of(frame))
    made.close()
    with pytest.raises(ValueError, match="4 buckets"):
        DigestIndex(spark, folder, 8)
    again = DigestIndex(spark, folder)
    assert again.unseen(digests_of(frame)).count() == 0
    again.close()
    with pytest.raises(ValueError, match="no index"):
        DigestIndex(spark, shared_folder(spark, "test-index"))


def test_copies_do_not_meet_before_the_index(spark, plan_of):
    """What is shuffled to the buckets is a written table of one row per digest."""
    index = DigestIndex(spark, shared_folder(spark, "test-index"), 4)
    copies = digests_of(spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit("the same").alias("text")))
    unseen = index.unseen(copies)
    assert [row.keep_id for row in unseen.collect()] == [2999]
    assert "HashAggregate" not in plan_of(unseen) and "sha2" not in plan_of(unseen)
    index.close()


def test_no_table_stays_in_the_catalog(spark, documents):
    before = {table.name for table in spark.catalog.listTables()}
    keep_largest(documents).collect()
    assert {table.name for table in spark.catalog.listTables()} <= before


def test_empty_documents_are_taken_no_more_often_than_others(spark):
    # Source "b" is at its ceiling of two, so nothing is left of its budget for a third copy.
    rows = [(n, "w " * 50, "a") for n in range(40)] + [(100, "w " * 5, "b")] + [
        (200 + n, "", "b") for n in range(200)
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    times = {row.doc_id: row.times for row in mix_sources(frame, weights=(1, 50)).collect()}
    assert times[100] == 2 and max(times.values()) == 2


def test_the_index_is_not_shuffled(spark, plan_of):
    folder = shared_folder(spark, "test-index")
    index = DigestIndex(spark, folder, 4)
    some = digests_of(spark.createDataFrame([(1, "a")], "doc_id bigint, text string"))
    index.append(some)
    plan = plan_of(index.unseen(some))
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") == 1
