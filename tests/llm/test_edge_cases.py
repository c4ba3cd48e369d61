"""Empty tables, and columns of the caller whose names operators use inside."""

from __future__ import annotations

import json

import pytest
import samples
from pyspark.sql import functions as F

import corpus_pipeline

from keybrook.llm.queries import QUERIES
from keybrook.llm import (
    collocations,
    digest_index,
    hilbert,
    language,
    line_chunks,
    line_frequency,
    mixing,
    multi_index,
    packing,
    periodic_runs,
    pieces,
    sketches,
    suffixes,
)

OPERATORS = {
    "line_frequency": line_frequency.line_frequency_verdicts,
    "mixing": mixing.mix_sources,
    "mixed_documents": lambda docs: mixing.documents_of_mix(docs).select("doc_id", "text"),
    "hilbert": hilbert.hilbert_shards,
    "hilbert_bytes": lambda docs: hilbert.hilbert_shards(docs, law="bytes"),
    "digest_index": digest_index.keep_largest,
    "language": language.predict_languages,
    "pieces": pieces.encode_documents,
    "suffixes": suffixes.repeat_counts,
    "sketches": sketches.near_duplicate_groups,
    "packing": lambda docs: packing.pack_documents(docs).select("n_tokens"),
    "line_chunks": line_chunks.chunk_dedup,
    "periodic_runs": periodic_runs.run_digests,
    "collocations": lambda docs: collocations.collocations(docs, least_count=2),
}


def multiset(frame):
    return sorted(json.dumps(row.asDict(recursive=True), sort_keys=True) for row in frame.collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    empty = spark.createDataFrame([], samples.SCHEMA)
    assert OPERATORS[name](empty).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_columns_with_other_meanings(documents, name):
    few = documents.where("doc_id < 30 or doc_id is null")
    plain = multiset(OPERATORS[name](few))
    assert multiset(OPERATORS[name](samples.with_clashing_columns(few))) == plain
    assert plain


STAGES = dict(corpus_pipeline.STAGES)


@pytest.mark.parametrize("name", STAGES)
def test_stage_over_an_empty_table(spark, name):
    assert STAGES[name](spark, spark.createDataFrame([], samples.SCHEMA), "").collect() == []


@pytest.mark.parametrize("name", STAGES)
def test_stage_with_columns_of_other_meanings(spark, documents, name):
    few = documents.where("doc_id < 30 or doc_id is null or text is null or text = ''")
    plain = STAGES[name](spark, few, "")
    clashing = STAGES[name](spark, samples.with_clashing_columns(few), "")
    if name != "pieces":
        assert plain.columns == few.columns
        assert clashing.columns == [*few.columns, *samples.CLASHING]
        assert {row[few.columns.index("lang") + 3] for row in clashing.collect()} <= {"other"}
    assert multiset(clashing.select(*plain.columns)) == multiset(plain)


def test_vectors(spark):
    schema = "vec_id bigint, embedding array<float>, label int"
    empty = spark.createDataFrame([], schema)
    assert multi_index.nearest_vectors(empty).collect() == []
    rows = [(n, [float(n), 1.0], 1) for n in range(60)]
    frame = spark.createDataFrame(rows, schema)
    clashing = frame.select("*", *[F.lit("other").alias(name) for name in [
        "h1", "h2", "vector", "node", "ids", "asks", "cell", "score", "code", "radius"]])
    plain = multiset(multi_index.nearest_vectors(frame))
    assert multiset(multi_index.nearest_vectors(clashing)) == plain
    assert len(plain) == 60


def test_each_operator_has_a_query():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
