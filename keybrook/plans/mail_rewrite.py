"""Rewriting of mail addresses, to two topics at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from keybrook.functions.codecs import encode_string
from keybrook.functions.text import replace_literal
from keybrook.operators.records import fan_out, map_records, map_values
from keybrook.schemas import NEW_MAIL_TOPIC, ORIGINAL_AND_NEW_MAIL_TOPIC
from keybrook.streaming.sinks import append_to_topics

# What is searched in a mail address, and what replaces it.
SEARCH, REPLACEMENT = "sbrf", "sbt"


def new_mail(mail: DataFrame, search: str = SEARCH, replacement: str = REPLACEMENT) -> DataFrame:
    """The rewritten address under the old key."""
    return map_values(mail, lambda value: replace_literal(value, search, replacement))


def original_and_new_mail(
    mail: DataFrame, search: str = SEARCH, replacement: str = REPLACEMENT
) -> DataFrame:
    """The rewritten address under the original address."""
    return map_records(
        mail, lambda key, value: (value, replace_literal(value, search, replacement))
    )


def both_topics(
    mail: DataFrame, search: str = SEARCH, replacement: str = REPLACEMENT
) -> DataFrame:
    """The records of both outputs, as bytes, from one pass over the mail.

    ``mail`` has a binary key and a text value.
    """

    def new(key: Column, value: Column) -> tuple[Column, Column]:
        return key, encode_string(replace_literal(value, search, replacement))

    def original_and_new(key: Column, value: Column) -> tuple[Column, Column]:
        return encode_string(value), encode_string(replace_literal(value, search, replacement))

    return fan_out(mail, {NEW_MAIL_TOPIC: new, ORIGINAL_AND_NEW_MAIL_TOPIC: original_and_new})


def start_mail_rewrite(
    mail: DataFrame,
    root: str,
    checkpoint: str,
    name: str = "mail-rewrite",
    once: bool = False,
    search: str = SEARCH,
    replacement: str = REPLACEMENT,
    replace_earlier_runs: bool = False,
) -> StreamingQuery:
    """Write both topics below ``root``, in one query and one pass."""
    return append_to_topics(
        both_topics(mail, search, replacement), root, name, checkpoint, once, replace_earlier_runs
    )
