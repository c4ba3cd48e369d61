"""Queries over the sample tables, each with the SQL that gives the same rows.

Every query reads its whole tables. Nested values are flattened, and bytes are
shown as hexadecimal text, so that rows compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from keybrook.functions.codecs import decode_long, decode_string, encode_string
from keybrook.functions.text import words, words_of_batch
from keybrook.operators.changelog import running_count
from keybrook.operators.checks import accepted, check_records, rejected
from keybrook.operators.joins import StoredTable, unmatched
from keybrook.operators.records import (
    complete_records,
    flat_map_arrays,
    flat_map_values,
    observe_skipped,
    rekey,
)
from keybrook.operators.tables import count_by_key, latest_by_key, named_table, stored_table
from keybrook.plans.enriched_orders import (
    enrich_orders,
    flatten,
    read_enriched_orders,
    start_enriched_orders,
)
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
    CUSTOMER_STORE,
    MAIL_TOPIC,
    NEW_MAIL_TOPIC,
    ORDER,
    ORDER_TOPIC,
    ORIGINAL_AND_NEW_MAIL_TOPIC,
    SYMBOLS,
    WORD_COUNTS_TOPIC,
)
from keybrook.session import work_folder
from keybrook.sources.lines import read_lines, spread_over_cores, stream_lines
from keybrook.sources.sample_feeds import (
    customer_feed,
    document_lines,
    mail_feed,
    order_feed,
    product_feed,
    stream_table,
    table,
    user_upserts,
)
from keybrook.sources.topics import (
    drain,
    from_envelope,
    read_topic,
    rejected_record,
    split_malformed,
    stored_files,
    stream_records,
    stream_topic,
    to_checked_envelope,
    to_envelope,
    write_records,
    write_topic,
)
from keybrook.streaming.changelog import read_changelog, start_running_count
from keybrook.streaming.sinks import to_folders, to_topic_folder
from keybrook.streaming.tables import KeptTable, maintain, present_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The rewriting of page addresses, which stand for mail addresses.
SEARCH, REPLACEMENT = "example", "sample"


def query(name: str, sql: str):
    """Register a query and the SQL that gives the same rows."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        ORACLES[name] = sql
        return build

    return register


# ---- enrichment ----

_ENRICHED_FIELDS = """
    l_orderkey AS order_id,
    p_name AS product_name, p_type AS product_description,
    p_brand AS product_supplier_name,
    c_name AS customer_name, c_mktsegment AS customer_gender, r_name AS customer_region,
    o_custkey AS order_customer_id, l_partkey AS order_product_id,
    epoch_us(o_orderdate) AS order_time_order_placed_at
"""
_ENRICHED_TABLES = """
    lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey
"""
_ENRICHED = f"SELECT {_ENRICHED_FIELDS} FROM {_ENRICHED_TABLES}"


@query("enriched_orders", _ENRICHED)
def enriched_orders(spark: SparkSession, folder: str) -> DataFrame:
    return flatten(
        enrich_orders(
            order_feed(spark, folder),
            latest_by_key(customer_feed(spark, folder)),
            latest_by_key(product_feed(spark, folder)),
        )
    )


@query("enriched_orders_large_tables", _ENRICHED)
def enriched_orders_large_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The way taken when the tables are too large to replicate."""
    return flatten(
        enrich_orders(
            order_feed(spark, folder),
            latest_by_key(customer_feed(spark, folder)),
            latest_by_key(product_feed(spark, folder)),
            max_broadcast_bytes=0,
        )
    )


@query("enriched_orders_drops", _ENRICHED + " WHERE c_acctbal >= 0")
def enriched_orders_drops(spark: SparkSession, folder: str) -> DataFrame:
    return flatten(
        enrich_orders(
            order_feed(spark, folder),
            latest_by_key(customer_feed(spark, folder, F.col("c_acctbal") < 0)),
            latest_by_key(product_feed(spark, folder)),
        )
    )


_UNMATCHED = """
    SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS product_id
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE NOT EXISTS (
        SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0)
"""


def _unmatched(spark: SparkSession, folder: str, **options) -> DataFrame:
    customers = latest_by_key(customer_feed(spark, folder, F.col("c_acctbal") < 0))
    missing = unmatched(
        order_feed(spark, folder),
        customers,
        lambda key, order: order["customer_id"],
        **options,
    )
    return missing.select(F.col("key").alias("order_id"), "value.customer_id", "value.product_id")


@query("unmatched_orders", _UNMATCHED)
def unmatched_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _unmatched(spark, folder)


@query("unmatched_orders_large_table", _UNMATCHED)
def unmatched_orders_large_table(spark: SparkSession, folder: str) -> DataFrame:
    return _unmatched(spark, folder, max_broadcast_bytes=0)


@query("enriched_orders_plain_tables", """
    SELECT l_orderkey AS order_id,
           p_name AS product_name, p_type AS product_description,
           p_brand AS product_supplier_name,
           c_name AS customer_name, c_mktsegment AS customer_gender,
           CAST(c_nationkey AS VARCHAR) AS customer_region,
           o_custkey AS order_customer_id, l_partkey AS order_product_id,
           epoch_us(o_orderdate) AS order_time_order_placed_at
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN part ON l_partkey = p_partkey
""")
def enriched_orders_plain_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Tables that have one row per key already, and need no newest value."""
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"),
        F.struct(
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("gender"),
            F.col("c_nationkey").cast("string").alias("region"),
        ).alias("value"),
    )
    products = product_feed(spark, folder).select("key", "value")
    return flatten(enrich_orders(order_feed(spark, folder), customers, products))


# ---- tables ----

_LATEST = """
    SELECT user_id, event_type, value AS amount
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS place
          FROM events)
    WHERE place = 1 AND event_type <> 'error'
"""


def _user_rows(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("key").alias("user_id"), "value.event_type", "value.amount")


@query("latest_by_key", _LATEST)
def latest_per_user(spark: SparkSession, folder: str) -> DataFrame:
    return _user_rows(latest_by_key(user_upserts(table(spark, folder, "events"))))


@query("table_rekeyed_view", _LATEST)
def table_by_name(spark: SparkSession, folder: str) -> DataFrame:
    rows = latest_by_key(user_upserts(table(spark, folder, "events")))
    return _user_rows(named_table(rows, CUSTOMER_STORE))


@query("table_stored_by_name", _LATEST)
def table_stored_by_name(spark: SparkSession, folder: str) -> DataFrame:
    rows = latest_by_key(user_upserts(table(spark, folder, "events")))
    return _user_rows(stored_table(rows, "user-store", work_folder(spark, "tables")))


# ---- words ----

_WORD_CHARS = r"[^\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]+"


def _words_sql(source: str, columns: str) -> str:
    """Rows of (columns, pos, word) of the texts of a table."""
    return f"""
        SELECT {columns}, unnest(words) AS word,
               generate_subscripts(words, 1) - 1 AS pos
        FROM (
            SELECT {columns},
                   CASE WHEN len(raw) = 1 THEN raw
                        WHEN raw = ['', ''] THEN []
                        WHEN raw[-1] = '' THEN raw[:-2]
                        ELSE raw END AS words
            FROM (SELECT {columns},
                         regexp_split_to_array(lower(text), '{_WORD_CHARS}') AS raw
                  FROM {source}))
    """


def _word_count_sql(source: str, columns: str) -> str:
    return f"""
        SELECT word, count(*) AS count FROM ({_words_sql(source, columns)}) GROUP BY word
    """


_WORD_CHANGELOG = f"""
    SELECT doc_id, CAST(pos AS INTEGER) AS pos, word,
           row_number() OVER (PARTITION BY word ORDER BY doc_id, pos) AS count
    FROM ({_words_sql("documents", "doc_id")})
"""


def _counts(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("key").alias("word"), "count")


def _changelog(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("offset").alias("doc_id"), "pos", F.col("key").alias("word"), "count")


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread_over_cores(document_lines(table(spark, folder, "documents")))


def _conversation_lines(spark: SparkSession, folder: str) -> DataFrame:
    return spread_over_cores(
        table(spark, folder, "conversations").select(
            "conv_id", "turn", F.col("text").alias("value")
        )
    )


@query("tokenize",
    "SELECT conv_id, turn, CAST(pos AS INTEGER) AS pos, word FROM "
    f"({_words_sql('conversations', 'conv_id, turn')})"
)
def tokenize(spark: SparkSession, folder: str) -> DataFrame:
    split = flat_map_values(_conversation_lines(spark, folder), words)
    return split.withColumnRenamed("value", "word")


@query("tokenize_batches",
    "SELECT conv_id, turn, CAST(pos AS INTEGER) AS pos, word FROM "
    f"({_words_sql('conversations', 'conv_id, turn')})"
)
def tokenize_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The same words by a table-valued function of the user over Arrow batches."""
    lines = _conversation_lines(spark, folder)
    return flat_map_arrays(lines, words_of_batch, "string").withColumnRenamed("value", "word")


@query("word_count", _word_count_sql("documents", "doc_id"))
def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return _counts(word_counts(_documents(spark, folder)))


@query("word_count_lines", _word_count_sql("conversations", "conv_id, turn"))
def word_count_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return _counts(word_counts(_conversation_lines(spark, folder)))


@query("running_count", _WORD_CHANGELOG)
def running_word_count(spark: SparkSession, folder: str) -> DataFrame:
    return _changelog(word_changelog(_documents(spark, folder)))


@query("running_count_blocks", _WORD_CHANGELOG)
def running_word_count_in_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks smaller than usual, as a large input would have many."""
    lines = _documents(spark, folder)
    return _changelog(word_changelog(lines, rows_per_block=100_000, hot_rows=100))


_EVENT_CHANGELOG = """
    SELECT event_id, event_type,
           row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS count
    FROM events
"""


@query("running_count_events", _EVENT_CHANGELOG)
def running_event_count(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        F.col("event_type").alias("key"), "event_id"
    )
    return running_count(events, ["event_id"]).withColumnRenamed("key", "event_type")


# ---- rewriting ----

_REPLACED = f"replace(url, '{SEARCH}', '{REPLACEMENT}')"


@query("map_values", f"SELECT page_id, {_REPLACED} AS url FROM pages")
def map_values(spark: SparkSession, folder: str) -> DataFrame:
    mail = mail_feed(table(spark, folder, "pages"))
    return new_mail(mail, SEARCH, REPLACEMENT).select(
        F.col("key").alias("page_id"), F.col("value").alias("url")
    )


@query("map_records", f"SELECT url AS original, {_REPLACED} AS rewritten FROM pages")
def map_records(spark: SparkSession, folder: str) -> DataFrame:
    mail = mail_feed(table(spark, folder, "pages"))
    return original_and_new_mail(mail, SEARCH, REPLACEMENT).select(
        F.col("key").alias("original"), F.col("value").alias("rewritten")
    )


_BOTH_TOPICS = f"""
    SELECT '{NEW_MAIL_TOPIC}' AS topic, page_id AS mail_offset,
           CAST(page_id AS VARCHAR) AS key_text, {_REPLACED} AS value_text
    FROM pages
    UNION ALL
    SELECT '{ORIGINAL_AND_NEW_MAIL_TOPIC}', page_id, url, {_REPLACED} FROM pages
"""


def _mail_with_bytes(pages: DataFrame) -> DataFrame:
    mail = mail_feed(pages)
    return mail.withColumn("key", encode_string(F.col("key").cast("string")))


def _both_topics(records: DataFrame) -> DataFrame:
    return records.select(
        "topic",
        F.col("offset").alias("mail_offset"),
        decode_string(F.col("key")).alias("key_text"),
        decode_string(F.col("value")).alias("value_text"),
    )


@query("fan_out", _BOTH_TOPICS)
def fan_out(spark: SparkSession, folder: str) -> DataFrame:
    mail = _mail_with_bytes(table(spark, folder, "pages"))
    return _both_topics(both_topics(mail, SEARCH, REPLACEMENT))


def _some_null(spark: SparkSession, folder: str) -> DataFrame:
    """Events, some without a key or a value."""
    return table(spark, folder, "events").select(
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("key"),
        F.when(F.col("value") >= 1, F.col("value")).alias("value"),
        "event_id",
    )


@query("skip_null_records", """
    SELECT event_id, event_type, value AS amount FROM events
    WHERE event_type <> 'error' AND value >= 1
""")
def skip_null_records(spark: SparkSession, folder: str) -> DataFrame:
    return complete_records(_some_null(spark, folder)).select(
        "event_id", F.col("key").alias("event_type"), F.col("value").alias("amount")
    )


# ---- topics ----


@query("bounded_drain", """
    SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 100
""")
def bounded_drain(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumnRenamed("event_id", "offset")
    return drain(events, 100).select(
        F.col("offset").alias("event_id"), "user_id", "event_type"
    )


@query("long_key_codec", """
    SELECT o_orderkey AS order_id, printf('%016X', o_orderkey) AS key_hex,
           hex(o_orderstatus) AS value_hex
    FROM orders
""")
def key_value_codecs(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("value")
    )
    encoded = to_envelope(orders, "orders", "long", "string")
    decoded = from_envelope(encoded, "long", "bytes")
    return decoded.select(
        F.col("key").alias("order_id"),
        F.lpad(F.hex("key"), 16, "0").alias("key_hex"),
        F.hex("value").alias("value_hex"),
    )


@query("topic_round_trip", """
    SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS product_id,
           epoch_us(o_orderdate) AS time_order_placed_at
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def topic_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written to a topic as bytes, read back and decoded."""
    root = work_folder(spark, "topics")
    write_topic(to_envelope(order_feed(spark, folder), ORDER_TOPIC, "long", ORDER), root)
    orders = from_envelope(read_topic(spark, root, ORDER_TOPIC), "long", ORDER)
    return orders.select(F.col("key").alias("order_id"), "value.*")


@query("topic_upserts_two_writes", _LATEST)
def topic_upserts_two_writes(spark: SparkSession, folder: str) -> DataFrame:
    """Upserts in two writes whose own offsets overlap; the second write is newer."""
    root = work_folder(spark, "topics")
    value = T.StructType([
        T.StructField("event_type", T.StringType()), T.StructField("amount", T.DoubleType()),
    ])
    upserts = user_upserts(table(spark, folder, "events"))
    middle = upserts.agg(F.avg("offset")).first()[0]
    for part in (F.col("offset") <= middle, F.col("offset") > middle):
        own = upserts.where(part)
        low = own.agg(F.min("offset")).first()[0] or 0
        own = own.withColumn("offset", F.col("offset") - low)
        write_topic(to_envelope(own, "users", "long", value), root)
    stored = from_envelope(read_topic(spark, root, "users"), "long", value)
    return _user_rows(latest_by_key(stored))


@query("word_changelog_topic", f"""
    SELECT word, count, row_number() OVER (ORDER BY doc_id, pos) AS place
    FROM ({_WORD_CHANGELOG})
""")
def word_changelog_topic(spark: SparkSession, folder: str) -> DataFrame:
    """The changelog streamed to a topic of one partition, and its records in order."""
    work = work_folder(spark, "word-changelog-topic")
    sink = to_topic_folder(f"{work}/topics", WORD_COUNTS_TOPIC, "words", "string", "long")
    start_word_changelog(
        document_lines(stream_table(spark, folder, "documents")),
        f"{work}/out",
        f"{work}/checkpoint",
        once=True,
        sink=lambda batch, batch_id: sink(batch.withColumnRenamed("count", "value"), batch_id),
    ).awaitTermination()
    log = from_envelope(
        read_topic(spark, f"{work}/topics", WORD_COUNTS_TOPIC), "string", "long"
    )
    # The rank over the whole topic is for the comparison with SQL only.
    # Only what is shown is shuffled for it, without the one key that all have.
    placed = log.select("key", "value", "offset", F.lit(1).alias("all"))
    ranked = running_count(
        placed,
        ["offset"],
        packing=(lambda rows: rows.drop("all"), lambda rows: rows.withColumn("all", F.lit(1))),
        key="all",
        name="place",
    )
    return ranked.select(F.col("key").alias("word"), F.col("value").alias("count"), "place")


_BROKEN = "event_type = 'error'"


@query("malformed_records", f"""
    SELECT event_id, NOT ({_BROKEN}) AS accepted,
           CASE WHEN NOT ({_BROKEN}) THEN user_id END AS user_id,
           CASE WHEN NOT ({_BROKEN}) THEN value END AS amount
    FROM events
""")
def malformed_records(spark: SparkSession, folder: str) -> DataFrame:
    """A topic in which some values are broken: the good records, and the rejected bytes."""
    root = work_folder(spark, "topics")
    record = T.StructType([
        T.StructField("user_id", T.LongType()), T.StructField("amount", T.DoubleType()),
    ])
    events = table(spark, folder, "events").select(
        F.col("event_id").alias("key"),
        F.struct("user_id", F.col("value").alias("amount")).alias("value"),
        "event_id",
        F.expr(_BROKEN).alias("broken"),
    )
    good = to_envelope(events.where("not broken"), "events", "long", record)
    bad = to_envelope(
        events.where("broken").withColumn("value", F.lit("{not json")), "events", "long", "string"
    )
    write_topic(good.unionByName(bad), root)
    accepted_rows, rejected_rows = split_malformed(
        read_topic(spark, root, "events"), "long", record
    )
    kept = accepted_rows.select(
        F.col("key").alias("event_id"), F.lit(True).alias("accepted"), "value.user_id",
        "value.amount",
    )
    dropped = rejected_rows.select(
        decode_long(F.col("key")).alias("event_id"), F.lit(False).alias("accepted"),
        F.lit(None).cast("bigint").alias("user_id"), F.lit(None).cast("double").alias("amount"),
    )
    return kept.unionByName(dropped)


@query("rekeyed_count", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def rekeyed_count(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        F.col("user_id").alias("key"), F.col("event_type").alias("value")
    )
    counts = count_by_key(rekey(events, lambda key, value: value))
    return counts.select(F.col("key").alias("event_type"), "count")


@query("skipped_counts", """
    SELECT count(*) AS records, count(*) FILTER (event_type = 'error') AS null_keys,
           count(*) FILTER (value < 1 OR value IS NULL) AS null_values
    FROM events
""")
def skipped_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What ``skip_null_records`` passes over, counted in the pass that reads the records."""
    observed, seen = observe_skipped(_some_null(spark, folder), "skipped")
    observed.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(
        [tuple(seen.get[name] for name in ("records", "null_keys", "null_values"))],
        "records bigint, null_keys bigint, null_values bigint",
    )


# ---- contract checks ----

_CHECKED_ORDER = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("status", T.StringType(), False, {SYMBOLS: ["F", "O"]}),
    T.StructField("price", T.DoubleType(), False),
])


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders, some without a price or a status."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_totalprice") >= 100000, F.col("o_totalprice")).alias("price"),
    )


def _checked_orders(spark: SparkSession, folder: str) -> DataFrame:
    return check_records(_orders(spark, folder), _CHECKED_ORDER)


@query("required_fields", """
    SELECT o_orderkey AS order_id,
           CASE WHEN o_totalprice < 100000 AND o_orderpriority = '1-URGENT' THEN 'status,price'
                WHEN o_totalprice < 100000 THEN 'price'
                WHEN o_orderpriority = '1-URGENT' THEN 'status'
                ELSE '' END AS missing
    FROM orders
""")
def required_fields(spark: SparkSession, folder: str) -> DataFrame:
    return _checked_orders(spark, folder).select(
        "order_id", F.array_join("missing", ",").alias("missing")
    )


@query("enum_domain", """
    SELECT o_orderkey AS order_id,
           CASE WHEN o_orderpriority <> '1-URGENT' AND o_orderstatus NOT IN ('F', 'O')
                THEN 'status' ELSE '' END AS unknown
    FROM orders
""")
def enum_domain(spark: SparkSession, folder: str) -> DataFrame:
    return _checked_orders(spark, folder).select(
        "order_id", F.array_join("unknown", ",").alias("unknown")
    )


@query("accepted_records", """
    SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS price,
           o_totalprice >= 100000 AND o_orderstatus IN ('F', 'O') AS accepted
    FROM orders WHERE o_orderpriority <> '1-URGENT' AND o_totalprice >= 100000
""")
def accepted_records(spark: SparkSession, folder: str) -> DataFrame:
    return _checked_orders(spark, folder).where(F.size("missing") == 0).select(
        "order_id", "status", "price", "accepted"
    )


_ACCEPTED = """
    o_totalprice >= 100000 AND o_orderpriority <> '1-URGENT' AND o_orderstatus IN ('F', 'O')
"""


@query("accepted_side", f"""
    SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS price
    FROM orders WHERE {_ACCEPTED}
""")
def accepted_side(spark: SparkSession, folder: str) -> DataFrame:
    return accepted(_orders(spark, folder), _CHECKED_ORDER)


@query("rejected_side", f"SELECT o_orderkey AS order_id FROM orders WHERE NOT ({_ACCEPTED})")
def rejected_side(spark: SparkSession, folder: str) -> DataFrame:
    return rejected(_orders(spark, folder), _CHECKED_ORDER).select("order_id")


@query("checked_topic", f"""
    SELECT CASE WHEN coalesce({_ACCEPTED}, false) THEN 'orders' ELSE 'rejected' END AS topic,
           o_orderkey AS order_id,
           CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderstatus END AS status,
           CASE WHEN coalesce({_ACCEPTED}, false) THEN ''
                ELSE concat_ws(',', CASE WHEN o_orderpriority = '1-URGENT' THEN 'status' END,
                  CASE WHEN o_totalprice < 100000 THEN 'price' END) END AS missing,
           CASE WHEN o_orderpriority <> '1-URGENT' AND o_orderstatus NOT IN ('F', 'O')
                THEN 'status' ELSE '' END AS unknown
    FROM orders
""")
def checked_topic(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written in one pass, those that break their contract to a topic of their own."""
    root = work_folder(spark, "topics")
    orders = _orders(spark, folder)
    records = orders.select(
        F.col("order_id").alias("key"), F.struct(*orders.columns).alias("value")
    )
    write_topic(to_checked_envelope(records, "orders", "rejected", "long", _CHECKED_ORDER), root)
    good = from_envelope(read_topic(spark, root, "orders"), "long", _CHECKED_ORDER)
    bad = from_envelope(read_topic(spark, root, "rejected"), "long", rejected_record(_CHECKED_ORDER))
    return good.select(
        F.lit("orders").alias("topic"), F.col("value.order_id").alias("order_id"),
        F.col("value.status").alias("status"), F.lit("").alias("missing"), F.lit("").alias("unknown"),
    ).unionByName(bad.select(
        F.lit("rejected").alias("topic"), F.col("key").alias("order_id"),
        F.col("value.value.status").alias("status"),
        F.array_join("value.missing", ",").alias("missing"),
        F.array_join("value.unknown", ",").alias("unknown"),
    ))


# ---- lines of text files ----

_LINES = """
    (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS text FROM conversations
     WHERE text IS NOT NULL)
"""


def _text_files(spark: SparkSession, folder: str) -> str:
    path = work_folder(spark, "lines")
    texts = table(spark, folder, "conversations").where(F.col("text").isNotNull())
    texts.select("text").repartition(3).write.text(path)
    return path


@query("word_count_text_lines", _word_count_sql(_LINES, "conv_id, turn"))
def word_count_text_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _counts(word_counts(spread_over_cores(read_lines(spark, _text_files(spark, folder)))))


@query("stream_word_count_text_lines", _word_count_sql(_LINES, "conv_id, turn"))
def stream_word_count_text_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The files one by one."""
    work = work_folder(spark, "line-count")
    lines = stream_lines(spark, _text_files(spark, folder), max_files_per_trigger=1)
    start_word_counts(
        lines, to_folders(f"{work}/out"), f"{work}/checkpoint", once=True
    ).awaitTermination()
    return _counts(read_word_counts(spark, f"{work}/checkpoint"))


# ---- streaming twins: all that is in the files now, then the query stops ----


def _in_two_runs(
    rows: DataFrame, by: str, folder: str, topic: str, run: Callable[[int], StreamingQuery]
) -> None:
    """Run a query over some of the rows, start it again after the others have come.

    The rows lie in as many files as a shuffle has partitions, so that no task has a fixed
    share of them. ``run`` takes the files per trigger, half of those that have come, so each
    run has several micro-batches, and the second goes on from the checkpoint of the first.
    """
    spark = rows.sparkSession
    files = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    seen = 0
    for part in (0, 1):
        own = rows.where(F.pmod(F.xxhash64(by), F.lit(2)) == part)
        # By key: rows that are dealt out in turn are sorted first.
        write_records(own.repartition(files, by), folder, topic)
        come = len(stored_files(spark, folder, topic))
        run(-(-(come - seen) // 2)).awaitTermination()
        seen = come


@query("stream_word_count", _word_count_sql("documents", "doc_id"))
def stream_word_count(spark: SparkSession, folder: str) -> DataFrame:
    work = work_folder(spark, "word-count")

    def run(files: int) -> StreamingQuery:
        schema = "offset bigint, value string"
        lines = stream_records(spark, f"{work}/in", "lines", schema, files)
        return start_word_counts(lines, to_folders(f"{work}/out"), f"{work}/checkpoint", once=True)

    lines = document_lines(table(spark, folder, "documents"))
    _in_two_runs(lines, "offset", f"{work}/in", "lines", run)
    return _counts(read_word_counts(spark, f"{work}/checkpoint"))


@query("stream_running_count_words", _WORD_CHANGELOG)
def stream_running_word_count(spark: SparkSession, folder: str) -> DataFrame:
    work = work_folder(spark, "word-changelog")
    lines = document_lines(stream_table(spark, folder, "documents"))
    start_word_changelog(
        lines, f"{work}/out", f"{work}/checkpoint", once=True
    ).awaitTermination()
    return _changelog(read_word_changelog(spark, f"{work}/out", "offset bigint"))


def _users_in_halves(spark: SparkSession, folder: str) -> DataFrame:
    """Events by user, numbered by the half of the table they are in."""
    events = table(spark, folder, "events")
    middle = events.agg(F.avg("event_id")).first()[0]
    return events.select(
        F.col("user_id").alias("key"), "event_id", (F.col("event_id") > middle).alias("late")
    )


@query("stream_running_count", """
    SELECT event_id, user_id,
           row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS count
    FROM events
""")
def stream_running_event_count(spark: SparkSession, folder: str) -> DataFrame:
    """Long keys, and a second run that goes on counting."""
    work = work_folder(spark, "event-changelog")
    events = _users_in_halves(spark, folder)
    for late in (False, True):
        own = events.where(F.col("late") == late).select("key", "event_id")
        write_records(own, f"{work}/in", "events")
        start_running_count(
            stream_records(spark, f"{work}/in", "events", "key bigint, event_id bigint"),
            ["event_id"],
            f"{work}/out",
            f"{work}/checkpoint",
            "event-changelog",
            once=True,
        ).awaitTermination()
    rows = read_changelog(spark, f"{work}/out", "key bigint, event_id bigint, count bigint")
    return rows.select("event_id", F.col("key").alias("user_id"), "count")


_USER = "struct<event_type: string, amount: double>"


@query("stream_latest_by_key", _LATEST)
def stream_latest_per_user(spark: SparkSession, folder: str) -> DataFrame:
    work = work_folder(spark, "user-table")

    def run(files: int) -> StreamingQuery:
        upserts = stream_records(
            spark, f"{work}/in", "users", f"key bigint, value {_USER}, offset bigint", files
        )
        return maintain(upserts, "user-table", f"{work}/checkpoint", once=True)

    users = user_upserts(table(spark, folder, "events"))
    _in_two_runs(users, "offset", f"{work}/in", "users", run)
    return _user_rows(present_rows(spark, f"{work}/checkpoint", "bigint", _USER))


def _maintained(
    spark: SparkSession, work: str, name: str, upserts: DataFrame
) -> Callable[[], StoredTable]:
    """A table that follows a folder of upserts, as it is when asked for."""
    value = upserts.schema["value"].dataType.simpleString()
    write_records(upserts, f"{work}/in", name)
    stream = stream_records(
        spark, f"{work}/in", name, f"key bigint, value {value}, offset bigint"
    )
    maintain(stream, name, f"{work}/{name}", once=True).awaitTermination()
    return KeptTable.maintained(spark, f"{work}/{name}", "bigint", value).present


@query("stream_enriched", _ENRICHED)
def stream_enriched_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in several micro-batches and two runs, joined with maintained tables.

    What a micro-batch reads of a table is its present rows, not its history.
    """
    work = work_folder(spark, "enriched-orders")
    customers = _maintained(spark, work, "customers", customer_feed(spark, folder))
    products = _maintained(spark, work, "products", product_feed(spark, folder))

    def run(files: int) -> StreamingQuery:
        orders = stream_records(
            spark, f"{work}/in", ORDER_TOPIC, f"key bigint, value {ORDER.simpleString()}", files
        )
        return start_enriched_orders(
            orders, customers, products, to_folders(f"{work}/out"), f"{work}/checkpoint", once=True
        )

    _in_two_runs(order_feed(spark, folder), "key", f"{work}/in", ORDER_TOPIC, run)
    return flatten(read_enriched_orders(spark, f"{work}/out"))


def _stream_mail(spark: SparkSession, folder: str, work: str, application: str) -> None:
    """Pages as mail in the envelope, streamed to both topics by one application."""
    mail = from_envelope(stream_topic(spark, f"{work}/mail", MAIL_TOPIC), "bytes", "string")
    start_mail_rewrite(
        mail,
        f"{work}/topics",
        f"{work}/checkpoints/{application}",
        name=application,
        once=True,
        search=SEARCH,
        replacement=REPLACEMENT,
    ).awaitTermination()


def _fan_out_by(spark: SparkSession, folder: str, applications: list[str]) -> DataFrame:
    work = work_folder(spark, "mail-rewrite")
    mail = _mail_with_bytes(table(spark, folder, "pages"))
    write_topic(to_envelope(mail, MAIL_TOPIC, "bytes", "string"), f"{work}/mail")
    for application in applications:
        _stream_mail(spark, folder, work, application)
    made = [
        read_topic(spark, f"{work}/topics", topic)
        for topic in (NEW_MAIL_TOPIC, ORIGINAL_AND_NEW_MAIL_TOPIC)
    ]
    return _both_topics(made[0].unionByName(made[1])).drop("mail_offset")


_BOTH_TOPICS_ONCE = f"SELECT topic, key_text, value_text FROM ({_BOTH_TOPICS})"


@query("stream_fan_out", _BOTH_TOPICS_ONCE)
def stream_fan_out(spark: SparkSession, folder: str) -> DataFrame:
    return _fan_out_by(spark, folder, ["mail-rewrite"])


@query("stream_fan_out_two_applications", f"{_BOTH_TOPICS_ONCE} UNION ALL {_BOTH_TOPICS_ONCE}")
def stream_fan_out_two_applications(spark: SparkSession, folder: str) -> DataFrame:
    return _fan_out_by(spark, folder, ["first", "second"])
