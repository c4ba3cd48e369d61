from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from keybrook.functions.codecs import decode_string, encode_string
from keybrook.operators.tables import latest_by_key
from keybrook.plans.enriched_orders import flatten, start_enriched_orders
from keybrook.plans.mail_rewrite import (
    both_topics,
    new_mail,
    original_and_new_mail,
    start_mail_rewrite,
)
from keybrook.plans.word_count import (
    read_word_changelog,
    read_word_counts,
    start_word_changelog,
    start_word_counts,
    word_changelog,
    word_counts,
)
from keybrook.schemas import (
    CUSTOMER,
    MAIL_TOPIC,
    NEW_MAIL_TOPIC,
    ORDER,
    ORIGINAL_AND_NEW_MAIL_TOPIC,
    PRODUCT,
)
from keybrook.session import session_conf, shared_folder
from keybrook.sources.lines import stream_lines
from keybrook.sources.topics import (
    from_envelope,
    read_topic,
    stream_topic,
    to_envelope,
    write_topic,
)
from keybrook.streaming.changelog import read_changelog, start_running_count
from keybrook.streaming.sinks import (
    append_to_topics,
    drain_stream,
    read_batches,
    show_records,
    to_folders,
    to_topic_folder,
)
from keybrook.streaming.tables import (
    KeptTable,
    maintain,
    present_rows,
    table_version,
    totals_after,
)

LINES = [
    "oak elm oak",
    " fir, oak!",
    "",
    "... elm",
    "oak oak oak fir",
    "Größe ELM",
]


@pytest.fixture
def topics(spark, tmp_path):
    """Write records to a topic, one file per call."""
    root = str(tmp_path / "topics")

    def send(topic, rows, key_codec="string", value_codec="string", schema="key string, value string, offset bigint"):
        records = spark.createDataFrame(rows, schema).coalesce(1)
        write_topic(to_envelope(records, topic, key_codec, value_codec), root)

    send.root = root
    return send


def send_lines(topics, offsets):
    topics("lines", [(None, LINES[n], n) for n in offsets])


def lines_stream(spark, topics, files=1):
    return from_envelope(stream_topic(spark, topics.root, "lines", files))


def all_lines(spark, offsets=range(len(LINES))):
    return spark.createDataFrame([(LINES[n], n) for n in offsets], "value string, offset bigint")


def rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=str)


def test_word_counts_go_on_after_a_restart(spark, topics, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    send_lines(topics, [0, 1])
    send_lines(topics, [2, 3])
    start_word_counts(lines_stream(spark, topics), to_folders(out), checkpoint, once=True).awaitTermination()
    assert rows(read_word_counts(spark, checkpoint)) == rows(word_counts(all_lines(spark, range(4))))
    send_lines(topics, [4, 5])
    start_word_counts(lines_stream(spark, topics), to_folders(out), checkpoint, once=True).awaitTermination()
    assert rows(read_word_counts(spark, checkpoint)) == rows(word_counts(all_lines(spark)))
    # conflated: at most one record per word and batch
    emitted = read_batches(spark, out, "key string, count bigint")
    assert emitted.count() == emitted.select("key", "batch_id").distinct().count()


@pytest.mark.parametrize("rows_per_block, hot_rows", [(1, 1), (10_000, 10_000)])
def test_word_changelog_goes_on_after_a_restart(spark, topics, tmp_path, rows_per_block, hot_rows):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        start_word_changelog(
            lines_stream(spark, topics),
            out,
            checkpoint,
            once=True,
            rows_per_block=rows_per_block,
            hot_rows=hot_rows,
        ).awaitTermination()

    send_lines(topics, [0, 1])
    send_lines(topics, [2])
    run()
    send_lines(topics, [3, 4])
    send_lines(topics, [5])
    run()
    found = read_word_changelog(spark, out, "offset bigint").drop("batch_id")
    order = ["offset", "pos", "key", "count"]
    assert rows(found.select(*order)) == rows(word_changelog(all_lines(spark)).select(*order))


def test_a_large_batch_is_read_again_and_shuffled_once(spark, tmp_path, plan_of):
    """A copy of the lines of a batch would take several times the disk of the files."""
    folder = str(tmp_path / "in")
    spark.createDataFrame(
        [(n, "a b hot " * 5) for n in range(400)], "offset bigint, value string"
    ).repartition(16).write.parquet(folder)
    plans, logs = [], []

    def keep(log, batch_id):
        logs.extend(log.collect())
        plans.append(plan_of(log))

    start_word_changelog(
        spark.readStream.schema("offset bigint, value string").parquet(folder),
        str(tmp_path / "out"), str(tmp_path / "checkpoint"), once=True,
        rows_per_block=500, hot_rows=100, sink=keep,
    ).awaitTermination()
    [plan] = plans
    final = plan[: plan.index("== Initial Plan ==")]
    assert "InMemoryTableScan" not in final and "ReusedExchange" in final
    assert "RoundRobin" not in final
    hot = [row["count"] for row in sorted(logs, key=lambda row: (row.offset, row.pos)) if row.key == "hot"]
    assert len(logs) == 6000 and hot == list(range(1, 2001))


def test_a_batch_for_a_topic_is_staged_in_files(spark, tmp_path, monkeypatch):
    """Not in the cache, whose rows are several times as large."""
    root = str(tmp_path / "topics")
    log = spark.createDataFrame(
        [(offset, pos, f"k{pos}", offset) for offset in range(20) for pos in range(3)],
        "offset bigint, pos int, key string, value bigint",
    ).repartition(3)
    monkeypatch.setattr(type(log), "persist", lambda *_: pytest.fail("a copy in the cache"))
    sink = to_topic_folder(root, "counts", "words", "string", "long")
    for _ in range(2):
        sink(log, 0)
    stored = from_envelope(read_topic(spark, root, "counts"), "string", "long").orderBy("offset")
    found = [(row.key, row.value) for row in stored.collect()]
    assert found == [(f"k{pos}", offset) for offset in range(20) for pos in range(3)]
    assert not list((tmp_path / "topics").glob("_staged*"))


def test_two_applications_on_the_same_lines(spark, topics, tmp_path):
    send_lines(topics, range(6))
    for name in ("first", "second"):
        start_word_changelog(
            lines_stream(spark, topics),
            str(tmp_path / "out" / f"application={name}"),
            str(tmp_path / "checkpoints" / name),
            name=name,
            once=True,
        ).awaitTermination()
    logs = [
        rows(read_word_changelog(spark, str(tmp_path / "out" / f"application={name}"), "offset bigint"))
        for name in ("first", "second")
    ]
    assert logs[0] == logs[1]
    assert len(logs[0]) == word_changelog(all_lines(spark)).count()


def test_two_applications_share_the_output_topic(spark, topics, tmp_path):
    send_lines(topics, range(6))
    for name in ("first", "second"):
        shared = to_topic_folder(topics.root, "counts", name, "string", "long")
        start_word_counts(
            lines_stream(spark, topics),
            lambda batch, batch_id: shared(batch.withColumnRenamed("count", "value"), batch_id),
            str(tmp_path / name),
            name=name,
            once=True,
        ).awaitTermination()
    counts = from_envelope(read_topic(spark, topics.root, "counts"), "string", "long")
    expected = word_counts(all_lines(spark))
    assert rows(counts.select("key", "value")) == rows(expected.unionAll(expected))


def test_lines_of_text_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("oak elm\noak")
    start_word_counts(
        stream_lines(spark, str(folder)), to_folders(str(tmp_path / "out")), str(tmp_path / "c"), once=True
    ).awaitTermination()
    assert rows(read_word_counts(spark, str(tmp_path / "c"))) == [("elm", 1), ("oak", 2)]


ORDER_ROWS = f"key bigint, value {ORDER.simpleString()}, offset bigint"
CUSTOMER_ROWS = f"key bigint, value {CUSTOMER.simpleString()}, offset bigint"
PRODUCT_ROWS = f"key bigint, value {PRODUCT.simpleString()}, offset bigint"
ENRICHED = (
    f"key bigint, value struct<product: {PRODUCT.simpleString()}, "
    f"customer: {CUSTOMER.simpleString()}, order: {ORDER.simpleString()}>"
)


@pytest.mark.parametrize("max_broadcast_bytes", [1 << 20, 0])
def test_each_batch_meets_the_tables_as_they_are_then(spark, topics, tmp_path, max_broadcast_bytes):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def table(topic, record):
        return lambda: latest_by_key(
            from_envelope(read_topic(spark, topics.root, topic), "long", record)
        )

    def run():
        orders = from_envelope(stream_topic(spark, topics.root, "order", 1), "long", ORDER)
        start_enriched_orders(
            orders.select("key", "value"),
            table("customer", CUSTOMER),
            table("product", PRODUCT),
            to_folders(out),
            checkpoint,
            once=True,
            max_broadcast_bytes=max_broadcast_bytes,
        ).awaitTermination()
        rows = flatten(read_batches(spark, out, ENRICHED)).collect()
        return {(row.order_id, row.product_name, row.customer_name) for row in rows}

    topics("customer", [(1, ("Ann", "female", "north"), 0)], "long", CUSTOMER, CUSTOMER_ROWS)
    topics("product", [(10, ("pen", "blue", "acme"), 0)], "long", PRODUCT, PRODUCT_ROWS)
    topics("order", [(100, (1, 10, 1), 0), (101, (2, 10, 1), 1)], "long", ORDER, ORDER_ROWS)
    assert run() == {(100, "pen", "Ann")}

    changes = [(1, ("Ann2", "female", "east"), 1), (2, ("Bo", "male", "south"), 2)]
    topics("customer", changes, "long", CUSTOMER, CUSTOMER_ROWS)
    topics("order", [(102, (1, 10, 2), 2), (103, (2, 10, 2), 3)], "long", ORDER, ORDER_ROWS)
    # The earlier orders are not emitted again.
    assert run() == {(100, "pen", "Ann"), (102, "pen", "Ann2"), (103, "pen", "Bo")}

    topics("customer", [(2, None, 3)], "long", CUSTOMER, CUSTOMER_ROWS)
    topics("order", [(104, (2, 10, 3), 4)], "long", ORDER, ORDER_ROWS)
    assert run() == {(100, "pen", "Ann"), (102, "pen", "Ann2"), (103, "pen", "Bo")}


def test_a_running_query_sees_table_changes(spark, topics, tmp_path, monkeypatch):
    monkeypatch.setattr("keybrook.streaming.sinks.COMMIT_INTERVAL", "1 second")
    out = str(tmp_path / "out")
    topics("customer", [(1, ("Ann", "female", "north"), 0)], "long", CUSTOMER, CUSTOMER_ROWS)
    topics("product", [(10, ("pen", "blue", "acme"), 0)], "long", PRODUCT, PRODUCT_ROWS)
    topics("order", [(100, (1, 10, 1), 0)], "long", ORDER, ORDER_ROWS)
    orders = from_envelope(stream_topic(spark, topics.root, "order"), "long", ORDER)
    query = start_enriched_orders(
        orders.select("key", "value"),
        lambda: latest_by_key(from_envelope(read_topic(spark, topics.root, "customer"), "long", CUSTOMER)),
        lambda: latest_by_key(from_envelope(read_topic(spark, topics.root, "product"), "long", PRODUCT)),
        to_folders(out),
        str(tmp_path / "checkpoint"),
    )
    try:
        query.processAllAvailable()
        topics("customer", [(2, ("Bo", "male", "south"), 1)], "long", CUSTOMER, CUSTOMER_ROWS)
        topics("order", [(101, (2, 10, 1), 1)], "long", ORDER, ORDER_ROWS)
        query.processAllAvailable()
    finally:
        query.stop()
    found = flatten(read_batches(spark, out, ENRICHED)).collect()
    assert {(row.order_id, row.customer_name) for row in found} == {(100, "Ann"), (101, "Bo")}


@pytest.mark.parametrize("key, codec", [("bigint", "long"), ("string", "string")])
def test_table_of_a_stream_of_upserts(spark, topics, tmp_path, key, codec):
    checkpoint = str(tmp_path / "checkpoint")
    schema = f"key {key}, value string, offset bigint"

    def name(number):
        return number if key == "bigint" else f"k{number}"

    def send(batch):
        topics("upserts", [(name(k), v, n) for k, v, n in batch], codec, "string", schema)

    def table():
        found = present_rows(spark, checkpoint, key, "string")
        return {row.key: row.value for row in found.collect()}

    def run():
        upserts = from_envelope(stream_topic(spark, topics.root, "upserts", 1), codec, "string")
        maintain(upserts, "table", checkpoint, once=True).awaitTermination()
        return table()

    assert table() == {}  # before its stream has started
    send([(1, "a", 0), (2, "b", 1)])
    send([(1, "a2", 0), (2, None, 1)])
    send([(3, "c", 0)])
    assert run() == {name(1): "a2", name(3): "c"}
    for number in range(3):
        send([(3, f"c{number}", 0)])
    assert run() == {name(1): "a2", name(3): "c2"}


def test_a_late_older_value_does_not_undo_a_delete(spark, tmp_path):
    schema = "key bigint, value string, offset bigint"
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    for number, batch in enumerate([[(1, "a", 5), (1, None, 9)], [(1, "late", 7)]]):
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(f"{folder}/part={number}")
        stream = spark.readStream.schema(schema).parquet(folder)
        maintain(stream, "late", checkpoint, once=True).awaitTermination()
        assert present_rows(spark, checkpoint, "bigint", "string").collect() == []


def test_a_drained_stream_stops_when_it_has_enough(spark, topics, tmp_path, monkeypatch):
    monkeypatch.setattr("keybrook.streaming.sinks.COMMIT_INTERVAL", "0 seconds")
    for n in range(8):
        topics("drained", [("k", f"v{5 * n + i}", 5 * n + i) for i in range(5)])
    stream = stream_topic(spark, topics.root, "drained", 1)
    kept, checkpoint = str(tmp_path / "kept"), str(tmp_path / "checkpoint")
    first = drain_stream(stream, 12, kept, checkpoint, timeout=120)
    assert [row.value for row in from_envelope(first).collect()] == [f"v{n}" for n in range(12)]
    # Three batches hold twelve records; the others were not kept.
    assert len(list(Path(kept).glob("batch_id=*"))) == 3
    short = drain_stream(
        stream_topic(spark, topics.root, "drained"), 100, str(tmp_path / "all"),
        str(tmp_path / "other"), timeout=8,
    )
    assert short.count() == 40


def test_totals_of_a_batch_that_runs_again(spark, tmp_path):
    root = str(tmp_path / "totals")
    batches = [[("a", 1), ("b", 2)], [("a", 5)], [("c", 1), ("b", 1)], [("a", 1)], []]
    expected = [[("a", 1), ("b", 2)], [("a", 6)], [("b", 3), ("c", 1)], [("a", 7)], []]
    for batch_id, (batch, totals) in enumerate(zip(batches, expected)):
        counts = spark.createDataFrame(batch, "key string, count bigint")
        for _ in range(1 + batch_id % 2):
            assert rows(totals_after(spark, root, batch_id, counts, "totals")) == totals
    # What is kept does not grow with the batches.
    assert len(list((tmp_path / "totals" / "in").glob("batch_id=*"))) == 2
    assert len(list((tmp_path / "totals" / "after").glob("batch_id=*"))) == 2


def test_a_kept_table_is_written_once_for_each_version(spark, tmp_path):
    schema = "key bigint, value string, offset bigint"
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    kept = KeptTable.maintained(spark, checkpoint, "bigint", "string")
    assert table_version(spark, checkpoint) == -1
    assert rows(kept.present().rows) == []
    readers = []
    for number in range(5):
        spark.createDataFrame([(number, "v", number)], schema).coalesce(1).write.parquet(
            f"{folder}/part={number}"
        )
        stream = spark.readStream.schema(schema).parquet(folder)
        maintain(stream, "kept", checkpoint, once=True).awaitTermination()
        assert table_version(spark, checkpoint) == number
        readers.append(kept.present())
        # Any number of micro-batches share the copy.
        assert all(kept.present() is readers[-1] for _ in range(10))
        assert rows(readers[-1].rows) == [(n, "v") for n in range(number + 1)]
        assert len(list(Path(kept.folder).iterdir())) <= 2
    # A reader that began before the last change can finish.
    assert readers[-2].rows.count() == 4


@pytest.mark.parametrize("max_broadcast_bytes", [1 << 20, 0])
def test_copies_of_tables_do_not_grow_with_batches(spark, topics, tmp_path, max_broadcast_bytes):
    checkpoint = str(tmp_path / "customers")
    topics("customer", [(1, ("Ann", "female", "north"), 0)], "long", CUSTOMER, CUSTOMER_ROWS)
    topics("product", [(10, ("pen", "blue", "acme"), 0)], "long", PRODUCT, PRODUCT_ROWS)
    upserts = from_envelope(stream_topic(spark, topics.root, "customer"), "long", CUSTOMER)
    maintain(upserts, "customers", checkpoint, once=True).awaitTermination()
    kept = KeptTable.maintained(spark, checkpoint, "bigint", CUSTOMER.simpleString())
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("lookup-table-*"))
    for n in range(6):
        topics("order", [(100 + n, (1, 10, n), n)], "long", ORDER, ORDER_ROWS)
    orders = from_envelope(stream_topic(spark, topics.root, "order", 1), "long", ORDER)
    products = KeptTable(spark, lambda: 0, lambda _: latest_by_key(
        from_envelope(read_topic(spark, topics.root, "product"), "long", PRODUCT)))
    out = str(tmp_path / "out")
    query = start_enriched_orders(
        orders.select("key", "value"), kept.present, products.present, to_folders(out),
        str(tmp_path / "checkpoint"), once=True, max_broadcast_bytes=max_broadcast_bytes,
    )
    query.awaitTermination()
    assert len(list(Path(out).glob("batch_id=*"))) == 6
    assert flatten(read_batches(spark, out, ENRICHED)).count() == 6
    assert set(shared.glob("lookup-table-*")) == before
    assert len(list(Path(kept.folder).iterdir())) == len(list(Path(products.folder).iterdir())) == 1


@pytest.mark.parametrize("replace, times", [(False, 2), (True, 1)])
def test_a_new_checkpoint_is_a_new_run(spark, topics, tmp_path, replace, times):
    for n in range(3):
        topics("mail", [(None, f"line {n}", n)])
    out = str(tmp_path / "out")
    for run in ("one", "two"):
        # Not as many batches in the second run as in the first.
        mail = stream_topic(spark, topics.root, "mail", 1 if run == "one" else None)
        append_to_topics(
            mail, out, "app", str(tmp_path / run), once=True, replace_earlier_runs=replace
        ).awaitTermination()
        # Started again with the same checkpoint it goes on, and has nothing to do.
        append_to_topics(
            mail, out, "app", str(tmp_path / run), once=True, replace_earlier_runs=replace
        ).awaitTermination()
    stored = from_envelope(read_topic(spark, out, "mail")).collect()
    assert sorted(row.value for row in stored) == sorted([f"line {n}" for n in range(3)] * times)
    assert len({row.offset for row in stored}) == 3 * times


def test_long_keys_are_counted_over_restarts(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for number in range(3):
        batch = [(n % 2, 10 * number + n) for n in range(5)]
        spark.createDataFrame(batch, "key bigint, offset bigint").coalesce(1).write.parquet(
            f"{folder}/part={number}"
        )
        start_running_count(
            spark.readStream.schema("key bigint, offset bigint").parquet(folder),
            ["offset"], out, str(tmp_path / "checkpoint"), "longs", once=True,
        ).awaitTermination()
    log = read_changelog(spark, out, "key bigint, offset bigint, count bigint")
    for key in (0, 1):
        own = log.where(F.col("key") == key).orderBy("offset").collect()
        assert [row["count"] for row in own] == list(range(1, len(own) + 1))


def test_two_applications_write_mail_and_a_lost_commit_doubles_nothing(spark, topics, tmp_path):
    topics(MAIL_TOPIC, [("k", text, n) for n, text in enumerate(MAIL)])
    out = str(tmp_path / "out")

    def run(name, checkpoint, **options):
        mail = from_envelope(stream_topic(spark, topics.root, MAIL_TOPIC), "bytes", "string")
        start_mail_rewrite(
            mail, out, str(tmp_path / checkpoint), name=name, once=True, **options
        ).awaitTermination()

    run("a", "one")
    run("b", "two")
    new = read_topic(spark, out, NEW_MAIL_TOPIC)
    assert new.count() == 2 * len(MAIL)
    assert new.select("offset").distinct().count() == 2 * len(MAIL)
    # The same application with its checkpoint lost takes the place of its earlier run.
    run("a", "three", replace_earlier_runs=True)
    assert read_topic(spark, out, NEW_MAIL_TOPIC).count() == 2 * len(MAIL)


MAIL = ["ann@sbrf.example", "bo@sbrf.example", "sbrf.sbrf", "SBRF", "", None]


def test_mail_rewrite_streams_to_both_topics(spark, topics, tmp_path):
    topics(MAIL_TOPIC, [(None, text, n) for n, text in enumerate(MAIL)])
    topics(MAIL_TOPIC, [("k", "late@sbrf.example", 9)])
    out = str(tmp_path / "out")
    mail = from_envelope(stream_topic(spark, topics.root, MAIL_TOPIC, 1), "bytes", "string")
    start_mail_rewrite(mail, out, str(tmp_path / "checkpoint"), once=True).awaitTermination()

    stored = from_envelope(read_topic(spark, topics.root, MAIL_TOPIC), "bytes", "string")
    new = from_envelope(read_topic(spark, out, NEW_MAIL_TOPIC), "bytes", "string")
    assert rows(new.select("key", "value")) == rows(new_mail(stored).select("key", "value"))
    pairs = from_envelope(read_topic(spark, out, ORIGINAL_AND_NEW_MAIL_TOPIC))
    found = rows(pairs.select("key", "value"))
    assert found == rows(original_and_new_mail(stored).select("key", "value"))
    assert ("sbrf.sbrf", "sbt.sbt") in found and ("SBRF", "SBRF") in found
    assert ("ann@sbrf.example", "ann@sbt.example") in found and ("", "") in found


def test_both_topics_batch(spark):
    mail = spark.createDataFrame([(None, "a@sbrf", 0)], "key string, value string, offset bigint")
    both = both_topics(mail.withColumn("key", encode_string(F.col("key"))))
    found = both.select("topic", decode_string(F.col("key")), decode_string(F.col("value")))
    assert rows(found) == sorted([
        (NEW_MAIL_TOPIC, None, "a@sbt"),
        (ORIGINAL_AND_NEW_MAIL_TOPIC, "a@sbrf", "a@sbt"),
    ], key=str)


def test_show_records(spark, topics, tmp_path, capsys):
    send_lines(topics, [0])
    query = show_records(
        lines_stream(spark, topics), "show", str(tmp_path / "checkpoint"), once=True
    )
    query.awaitTermination()
    assert query.exception() is None
    assert LINES[0] in capsys.readouterr().out


def test_session_options_are_put_back(spark):
    name = "spark.sql.streaming.stateStore.minDeltasForSnapshot"
    before = spark.conf.get(name)
    with session_conf(spark, {name: "3", "keybrook.unset": "1"}):
        assert spark.conf.get(name) == "3"
    assert spark.conf.get(name) == before and spark.conf.get("keybrook.unset", None) is None


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one.startswith(f"{base}/x-") and two.startswith(f"{base}/x-") and one != two


def test_rows_for_two_runs_are_dealt_to_all_tasks(spark, tmp_path):
    """Each run reads half of its files per trigger, and no task writes a fixed share."""
    from keybrook.plans import registry

    folder, calls = str(tmp_path), []

    class Done:
        def awaitTermination(self):  # noqa: N802
            pass

    def run(files):
        calls.append((files, spark.read.parquet(f"{folder}/topic=t").count()))
        return Done()

    registry._in_two_runs(spark.range(2000).toDF("offset"), "offset", folder, "t", run)
    files = spark.read.parquet(f"{folder}/topic=t").inputFiles()
    assert len(files) == 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [number for number, _ in calls] == [len(files) // 4] * 2
    assert 0 < calls[0][1] < calls[1][1] == 2000
