from __future__ import annotations

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from keybrook.functions.text import replace_literal, words
from keybrook.plans.word_count import keyed_words, word_counts

CASES = [
    ("Alder  Birch", ["alder", "birch"]),
    (" lead", ["", "lead"]),
    ("trail! ", ["trail"]),
    ("", [""]),
    ("...", []),
    (" ", []),
    ("Größe, naïve_x é", ["größe", "naïve_x", "é"]),
    ("one", ["one"]),
    ("ЁЛКА и 42 дома", ["ёлка", "и", "42", "дома"]),
    (None, None),
]


def frame(spark, texts):
    rows = [(place, text) for place, text in enumerate(texts)]
    return spark.createDataFrame(rows, "offset bigint, value string")


@pytest.mark.parametrize("text, expected", CASES)
def test_words(spark, text, expected):
    row = frame(spark, [text]).select(words(F.col("value")).alias("words")).first()
    assert row.words == expected


def test_keyed_words_equal_words_of_each_line(spark):
    lines = frame(spark, [text for text, _ in CASES])
    found = {(row.offset, row.pos, row.key) for row in keyed_words(lines).collect()}
    assert found == {
        (offset, pos, word)
        for offset, (_, expected) in enumerate(CASES)
        for pos, word in enumerate(expected or [])
    }


def test_empty_words_are_counted(spark):
    counts = {row.key: row["count"] for row in word_counts(frame(spark, ["", " a", "..."])).collect()}
    assert counts == {"": 2, "a": 1}


def split_by_hand(text: str) -> list[str]:
    parts, current, separated = [], "", False
    for char in text.lower():
        if char.isalnum() or char == "_":
            if separated:
                parts.append(current)
                current, separated = "", False
            current += char
        else:
            separated = True
    if not separated:
        return parts + [current]
    return parts + [current] if current else parts


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="aB1_é .,!\n", max_size=12), min_size=1, max_size=20))
def test_words_by_hand(spark, texts):
    rows = frame(spark, texts).select("value", words(F.col("value")).alias("words")).collect()
    for row in rows:
        assert row.words == split_by_hand(row.value), row.value


@pytest.mark.parametrize(
    "text, search, replacement, expected",
    [
        ("ann@sbrf.example", "sbrf", "sbt", "ann@sbt.example"),
        ("sbrf.sbrf", "sbrf", "sbt", "sbt.sbt"),
        ("SBRF", "sbrf", "sbt", "SBRF"),
        ("a.b", ".", "-", "a-b"),
        ("a$b", "$", "$1", "a$1b"),
        ("", "sbrf", "sbt", ""),
        (None, "sbrf", "sbt", None),
    ],
)
def test_replace_literal(spark, text, search, replacement, expected):
    changed = replace_literal(F.col("value"), search, replacement)
    assert frame(spark, [text]).select(changed.alias("value")).first().value == expected
