"""A corpus pipeline: documents in, token ids of the chosen mix out.

Each stage takes all that the one before it kept and applies one operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from keybrook.llm import language, line_chunks, mixing, pieces, sketches
from keybrook.llm.common import put_back, set_apart, written

# A document whose n-grams are this far from every language is none of them.
LEAST_SCORE = 0.2
SHINGLE_WORDS, PERCENT = 5, 80


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in one of the languages of the corpus, whatever their label says.

    Those without a letter go (null, empty and blank texts too), and those that are like no
    profile. Texts are read whole, however long. Of languages equally near the first by name
    counts. Repeated rows are judged alike.
    """
    out = language.held_out(F.col("doc_id"))
    predict = language.language_of(language.fit_profiles(docs.where(~out)))
    found = set_apart(docs, "text").withColumn("_found", predict("text"))
    known = (F.col("_found.lang_pred") != language.UNKNOWN) & (
        F.col("_found.score") >= LEAST_SCORE
    )
    return found.where(known).select(*put_back(docs.columns, "text"))


def without_repeated_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without runs of lines that came before; those left empty go.

    Null and empty texts stay as they are, and so do texts of one line. Of equal runs the first by
    ``doc_id`` (null last), text and place stays, so ties cannot change the result. Rows alike in
    ``doc_id`` and text keep the same. Long texts are cut into runs whole.
    """
    used = ("doc_id", "text", "n_chars")
    kept = line_chunks.remove_repeated_chunks(set_apart(docs, *used))
    left = F.col("removed").isNull() | (F.trim(F.regexp_replace("text", r"\s+", " ")) != "")
    n_chars = F.when(F.col("removed").isNull(), F.col("n_chars")).otherwise(
        F.char_length("text").cast("bigint")
    )
    return kept.where(left).select(*put_back(docs.columns, *used, n_chars=n_chars))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Null, empty and blank texts are like nothing and stay. Rows with the same ``doc_id`` stay or
    go together; one without a ``doc_id`` stays. Texts are compared whole, however long.
    """
    groups = sketches.near_duplicate_groups(docs, SHINGLE_WORDS, PERCENT)
    dropped = written(groups.where(~F.col("kept")).select("doc_id").distinct(), "near-dropped")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    Null and empty texts have no words and are taken by their hash, at no cost. A null source
    is a source. Rows with the same ``doc_id`` are taken together.
    """
    return mixing.documents_of_mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, and whether they give its text again.

    Null and empty texts have no ids. Texts are encoded whole; of paths with equal scores
    always the same is taken. Repeated rows give repeated rows.
    """
    return pieces.encode_documents(docs)


STAGES = [
    ("language", known_language),
    ("line_chunks", without_repeated_chunks),
    ("near_duplicates", one_of_each_group),
    ("mix", mixed_sources),
    ("pieces", encoded),
]

# Profiles, chunk hashes and piece paths are not for SQL; a test compares with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
