"""The corpus pipeline: quality rules, near-dedup, decontamination, mixing, token files.

Each stage reads all documents that its predecessor kept, and its decisions take effect: rejected
documents go, one document of each near-duplicate group stays, documents that hold a benchmark item
go, documents are repeated or left out as the mix takes them, and the rest becomes token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veedor.llm import decontaminate, mixing, near_copies, repetition, token_files
from veedor.llm.common import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep."""
    return repetition.drop_low_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash finds and five-word shingle sets of Jaccard similarity 0.8 or more connect."""
    return near_copies.drop_near_copies(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a copy of a benchmark item."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them: sources weigh 3, 1, 2 in turn and share 150 % of all words, twice each at most."""
    return mixing.mixed_documents(docs, weights=(3.0, 1.0, 2.0), share=1.5, epochs=2.0)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the token files hold, in the order of the mix: a row for each of its documents, looked up and read back."""
    store = token_files.write_store(docs, tokenizer=token_files.vocabulary_path(), end_id=1, order="rows")
    return token_files.documents_of(store).select("doc_id", "occurrence", "start", "n_tokens", "ids_crc32")


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mix", mix), ("tokens", tokens)]

#: The suffix arrays, hashes, alignments and token files of the stages are outside SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
