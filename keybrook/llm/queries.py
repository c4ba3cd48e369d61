"""One query per operator over the whole of its table, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

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


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def over_documents(
    operator: Callable[[DataFrame], DataFrame],
) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: operator(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_frequency": over_documents(line_frequency.line_frequency_verdicts),
    "op2_mix_sources": over_documents(mixing.mix_sources),
    "op3_hilbert_shards": over_documents(hilbert.hilbert_shards),
    "op4_digest_index": over_documents(digest_index.keep_largest),
    "op5_rank_order_language": over_documents(language.predict_languages),
    "op6_piece_encoding": over_documents(pieces.encode_documents),
    "op7_deep_shallow_suffixes": over_documents(suffixes.repeat_counts),
    "op8_bottom_k_sketches": over_documents(sketches.near_duplicate_groups),
    "op9_best_fit_packing": over_documents(packing.pack_documents),
    "op10_line_chunks": over_documents(line_chunks.chunk_dedup),
    "op11_periodic_runs": over_documents(periodic_runs.run_digests),
    "op12_collocations": over_documents(collocations.collocations),
    "op13_multi_index_hashing": lambda spark, folder: multi_index.nearest_vectors(
        table(spark, folder, "embeddings")
    ),
}

ORACLES = {
    "op1_line_frequency": line_frequency.ORACLE_SQL,
    "op2_mix_sources": mixing.ORACLE_SQL,
    "op4_digest_index": digest_index.ORACLE_SQL,
    "op8_bottom_k_sketches": sketches.ORACLE_SQL,
    "op12_collocations": collocations.ORACLE_SQL,
}
