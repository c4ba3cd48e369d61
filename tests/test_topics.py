from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from keybrook.schemas import CUSTOMER, ENVELOPE, SERVICE_ORDER
from generators import generate_customers, generate_orders, generate_products
from keybrook.session import session_conf
from keybrook.sources.lines import read_lines, spread_over_cores
from keybrook.sources.offsets import Ledger, StaleRunError
from keybrook.sources.topics import (
    drain,
    drain_topic,
    first_folders,
    from_envelope,
    read_kafka,
    read_topic,
    rejected_record,
    split_malformed,
    stream_kafka,
    to_checked_envelope,
    to_envelope,
    write_batch,
    write_topic,
)


def test_keyed_records_come_back_typed(spark, tmp_path):
    root = str(tmp_path / "topics")
    customers = generate_customers(spark.range(20))
    write_topic(to_envelope(customers, "customer", "long", CUSTOMER), root)
    write_topic(to_envelope(customers.limit(0), "customer", "long", CUSTOMER), root)
    stored = read_topic(spark, root, "customer")
    assert stored.columns == ENVELOPE.names
    back = from_envelope(stored, "long", CUSTOMER).select("key", "value", "offset")
    assert sorted(back.collect()) == sorted(customers.collect())


def test_tombstones_survive(spark, tmp_path):
    root = str(tmp_path / "topics")
    rows = spark.createDataFrame([(1, None, 0)], f"key bigint, value {CUSTOMER.simpleString()}, offset bigint")
    write_topic(to_envelope(rows, "customer", "long", CUSTOMER), root)
    assert from_envelope(read_topic(spark, root, "customer"), "long", CUSTOMER).first().value is None


def test_drain_takes_the_first_in_order(spark, plan_of):
    topic = spark.range(1000).select((999 - F.col("id")).alias("offset")).repartition(4)
    first = drain(topic, 10)
    assert sorted(row.offset for row in first.collect()) == list(range(10))
    assert "TakeOrderedAndProject" in plan_of(first)
    assert drain(topic, 5000).count() == 1000


def test_lines(spark, tmp_path):
    path = tmp_path / "input.txt"
    path.write_text("one two\n\nthree\n")
    rows = read_lines(spark, str(path)).collect()
    assert [(row.key, row.value) for row in rows] == [(None, "one two"), (None, ""), (None, "three")]


def test_spread_only_where_files_are_few(spark, tmp_path):
    for files in (1, 6):
        spark.range(100).repartition(files).write.parquet(str(tmp_path / str(files)))
    few = spark.read.parquet(str(tmp_path / "1"))
    assert spread_over_cores(few).rdd.getNumPartitions() == 4
    many = spark.read.parquet(str(tmp_path / "6"))
    assert spread_over_cores(many) is many
    # One large file has many splits.
    size = max(path.stat().st_size for path in (tmp_path / "1").glob("*.parquet"))
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": str(size // 4)}):
        assert spread_over_cores(few) is few


def test_offsets_go_on_over_writes(spark, tmp_path):
    root = str(tmp_path / "topics")
    schema = "key bigint, value string, partition int, offset bigint"
    for write in range(3):
        rows = [(n, f"{write}", n % 2, n) for n in range(4)]
        frame = spark.createDataFrame(rows, schema)
        write_topic(to_envelope(frame, "t", "long", "string"), root)
    stored = from_envelope(read_topic(spark, root, "t"), "long", "string").collect()
    for partition in (0, 1):
        own = sorted((row.offset, row.value) for row in stored if row.partition == partition)
        assert [value for _, value in own] == ["0", "0", "1", "1", "2", "2"]
        assert len({offset for offset, _ in own}) == 6


def test_a_batch_written_again_replaces_itself(spark, tmp_path):
    root = str(tmp_path / "topics")
    for application, batch in (("a", 0), ("b", 0), ("a", 1), ("a", 1), ("b", 0)):
        rows = [(f"{application}{batch}", "v", 0), (f"{application}{batch}", "v", 1)]
        frame = spark.createDataFrame(rows, "key string, value string, offset bigint")
        write_batch(to_envelope(frame, "t", "string", "string"), root, application, batch)
    stored = from_envelope(read_topic(spark, root, "t")).collect()
    assert sorted(row.key for row in stored) == ["a0", "a0", "a1", "a1", "b0", "b0"]
    assert len({row.offset for row in stored}) == 6


def _letters(spark, *keys):
    rows = [(key, "v", n) for n, key in enumerate(keys)]
    frame = spark.createDataFrame(rows, "key string, value string, offset bigint")
    return to_envelope(frame, "t", "string", "string")


def test_a_new_run_adds_or_replaces_and_retires_the_old_one(spark, tmp_path):
    for replace, left in ((False, ["a", "b", "c"]), (True, ["c"])):
        root = str(tmp_path / f"topics-{replace}")
        write_batch(_letters(spark, "a"), root, "one", 0, "first")
        write_batch(_letters(spark, "b"), root, "one", 1, "first")
        write_batch(_letters(spark, "other"), root, "two", 0, "first")
        write_batch(_letters(spark, "c"), root, "one", 0, "second", replace)
        stored = from_envelope(read_topic(spark, root, "t")).collect()
        assert sorted(row.key for row in stored) == [*left, "other"]
        assert {row.offset for row in stored if row.key == "c"} == {3}
        with pytest.raises(StaleRunError):
            write_batch(_letters(spark, "late"), root, "one", 2, "first", replace)
        assert read_topic(spark, root, "t").count() == len(left) + 1


def test_a_write_reads_as_many_files_however_many_came_before(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "topics")
    opened = []
    newest = Ledger.newest

    def counted(self):
        opened[-1] += 1
        return newest(self)

    monkeypatch.setattr(Ledger, "newest", counted)
    batch = _letters(spark, "a", "b").cache()
    for number in range(50):
        opened.append(0)
        write_batch(batch, root, "app", number, "run")
        kept = [path for path in (tmp_path / "topics" / "_offsets").iterdir()
                if not path.name.startswith(".")]
        assert len(kept) <= 8
    assert opened == [1] * 50
    offsets = [row.offset for row in read_topic(spark, root, "t").collect()]
    assert sorted(offsets) == list(range(100))


def test_two_writers_never_get_the_same_offsets(spark, tmp_path):
    root = str(tmp_path / "topics")
    batches = [_letters(spark, f"{n}a", f"{n}b") for n in range(6)]
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda n: write_batch(batches[n], root, f"app{n}", 0), range(6)))
    offsets = [row.offset for row in read_topic(spark, root, "t").collect()]
    assert sorted(offsets) == list(range(12))


def test_drain_reads_only_the_first_batches(spark, tmp_path):
    root = str(tmp_path / "topics")
    for number in range(6):
        write_batch(_letters(spark, *[f"{number}{n}" for n in range(10)]), root, "app", number)
    assert len(first_folders(spark, root, "t", 15)) == 2
    assert first_folders(spark, root, "t", 0) == []
    drained = drain_topic(spark, root, "t", 15)
    assert len(drained.inputFiles()) < len(read_topic(spark, root, "t").inputFiles())
    assert [row.offset for row in drained.collect()] == list(range(15))
    assert drain_topic(spark, root, "t", 1000).count() == 60
    assert drain_topic(spark, root, "t", 0).collect() == []


def test_malformed_records_fail_or_are_set_apart(spark):
    values = [b'{"name": "Ann", "gender": "female", "region": "n"}', b"{not json", b"[]", b"", None]
    rows = [(bytes(7) + bytes([n]), value, "t", 0, n, None) for n, value in enumerate(values)]
    rows.append((b"short", values[0], "t", 0, 9, None))
    envelope = spark.createDataFrame(rows, ENVELOPE)
    good, bad = split_malformed(envelope, "long", CUSTOMER)
    assert sorted((row.key, row.value and row.value.name) for row in good.collect()) == [
        (0, "Ann"), (4, None),
    ]
    assert sorted(row.offset for row in bad.collect()) == [1, 2, 3, 9]
    with pytest.raises(Exception, match="malformed record"):
        from_envelope(envelope.where("offset = 1"), "long", CUSTOMER).collect()


def test_records_that_break_their_contract_go_to_their_own_topic(spark, tmp_path):
    root = str(tmp_path / "topics")
    good = ("a", 1, "CREATED", "JUMPERS", 2, 9.5)
    values = [good, ("b", None, "LOST", "HATS", 2, None), None, ("c", 2, "FAILED", "JUMPERS", 1, 0.0)]
    rows = [(n, value, n) for n, value in enumerate(values)]
    schema = f"key bigint, value {SERVICE_ORDER.simpleString()}, offset bigint"
    records = spark.createDataFrame(rows, schema)
    envelope = to_checked_envelope(records, "good", "bad", "long", SERVICE_ORDER)
    write_topic(envelope, root)
    kept = from_envelope(read_topic(spark, root, "good"), "long", SERVICE_ORDER).collect()
    assert sorted((row.key, row.value and row.value.id) for row in kept) == [
        (0, "a"), (2, None), (3, "c"),
    ]
    [refused] = from_envelope(
        read_topic(spark, root, "bad"), "long", rejected_record(SERVICE_ORDER)
    ).collect()
    assert (refused.key, refused.value.value.id) == (1, "b")
    assert refused.value.missing == ["customerId", "price"]
    assert refused.value.unknown == ["state", "product"]
    # What was written without a check is found when it is read.
    write_topic(to_envelope(records, "unchecked", "long", SERVICE_ORDER), root)
    stored = read_topic(spark, root, "unchecked")
    fine, broken = split_malformed(stored, "long", SERVICE_ORDER, complete=True)
    assert sorted(row.key for row in fine.collect()) == [0, 2, 3]
    assert broken.count() == 1 and broken.columns == ENVELOPE.names
    assert split_malformed(stored, "long", SERVICE_ORDER)[1].count() == 0


def test_kafka_needs_its_connector(spark):
    for read in (read_kafka, stream_kafka):
        try:
            topic = read(spark, "localhost:9092", "order")
        except AnalysisException as missing:
            assert "kafka" in str(missing).lower()
        else:
            assert topic.columns[:2] == ["key", "value"]


def test_generators_are_seeded_and_in_their_domains(spark):
    customers = generate_customers(spark.range(50)).select("key", "value.*").collect()
    assert customers == generate_customers(spark.range(50)).select("key", "value.*").collect()
    assert {row.gender for row in customers} == {"male", "female", "unknown"}
    assert all(len(row.name) == 10 and len(row.region) == 20 for row in customers)
    assert all((row.name + row.region).isalnum() for row in customers)
    products = generate_products(spark.range(50)).select("value.*").collect()
    assert all(len(row.description) == 100 and row.description.isalnum() for row in products)
    orders = generate_orders(spark.range(200), 10, 20).select("value.*").collect()
    assert {row.customer_id for row in orders} == set(range(10))
    assert {row.product_id for row in orders} == set(range(20))
    times = [row.time_order_placed_at for row in orders]
    assert min(times) < 0 < max(times) and len(set(times)) == 200
    other = generate_customers(spark.range(50), seed=9).select("key", "value.*").collect()
    assert other != customers


def test_generated_tables_do_not_depend_on_partitions(spark):
    one = generate_products(spark.range(0, 30, 1, 1)).collect()
    many = generate_products(spark.range(0, 30, 1, 7)).orderBy("key").collect()
    assert one == many


@pytest.mark.parametrize("count", [0, 1, 100])
def test_every_generated_order_is_enriched(spark, count):
    from keybrook.operators.tables import latest_by_key
    from keybrook.plans.enriched_orders import enrich_orders

    enriched = enrich_orders(
        generate_orders(spark.range(count), 100, 100),
        latest_by_key(generate_customers(spark.range(100))),
        latest_by_key(generate_products(spark.range(100))),
    )
    assert enriched.count() == count
