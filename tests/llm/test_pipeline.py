"""Oracles at the smallest scale, and the pipeline against plain code over each stage's input."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest
import samples

import corpus_pipeline
from keybrook.llm import line_chunks, mixing, pieces
from keybrook.llm.queries import ORACLES, QUERIES

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no sample tables")


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, name):
    database = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        database.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    frame = QUERIES[name](spark, str(FOLDER))
    names = sorted(frame.columns)
    result = database.execute(ORACLES[name])
    assert sorted(column[0] for column in result.description) == names
    columns = [column[0] for column in result.description]

    def rounded(values):
        return tuple(round(v, 9) if isinstance(v, float) else v for v in values)

    theirs = Counter(
        rounded(row[columns.index(name)] for name in names) for row in result.fetchall()
    )
    assert Counter(rounded(row) for row in frame.select(*names).collect()) == theirs


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    made = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(FOLDER)).cache()
        made[name] = docs.collect()
        if name != "pieces":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    before = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    known = made["language"]
    assert len(known) >= 0.95 * len(before)
    assert all(any(char.isalpha() for char in row.text) for row in known)

    seen, expected = set(), {}
    for row in sorted(known):
        lines, out, at = row.text.encode().split(b"\n"), [], 0
        for size in line_chunks.chunk_sizes(lines):
            chunk = b"\n".join(lines[at : at + size])
            if not (size > 1 and chunk.strip() and chunk in seen):
                out += lines[at : at + size]
                seen |= {chunk} if size > 1 else set()
            at += size
        text = b"\n".join(out).decode()
        if text.strip() or text == row.text:
            expected[row.doc_id] = text
    assert {row.doc_id: row.text for row in made["line_chunks"]} == expected

    sets = {row.doc_id: samples.shingles(row.text, 5) for row in made["line_chunks"]}
    groups = samples.group_of(sets, 80)
    assert {row.doc_id for row in made["near_duplicates"]} == set(groups.values())

    times = {
        row.doc_id: row.times
        for row in mixing.mix_sources(
            spark.createDataFrame(made["near_duplicates"], samples.SCHEMA)
        ).collect()
    }
    assert Counter(row.doc_id for row in made["mix"]) == Counter(
        {key: n for key, n in times.items() if n}
    )
    assert Counter(row.doc_id for row in made["pieces"]) == Counter(
        row.doc_id for row in made["mix"]
    )
    assert all(row.round_trip for row in made["pieces"])
    model = pieces.load_model()
    texts = {row.doc_id: row.text for row in made["mix"]}
    for row in made["pieces"]:
        assert model.encode([texts[row.doc_id]])[0].tolist() == row.ids
