"""From raw documents to packed training sequences: good, distinct, unlike each other, without secrets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm.bradley_terry import keep_good
from rollcall.llm.guess_cost import redact
from rollcall.llm.packing import packed
from rollcall.llm.queries import BITS, BYTE_BPE, SHINGLE, piece_digests, quality_model
from rollcall.llm.simhash import keep_one
from rollcall.llm.stream_dedup import keep_first
from rollcall.session import drop_path, scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the given labels, predicts to be good."""
    return keep_good(docs, quality_model(spark, sf_dir))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of each group of near copies."""
    return keep_one(docs, shingle=SHINGLE, max_distance=BITS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, with a checksum of each piece's ids."""
    return piece_digests(packed(docs, BYTE_BPE))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("simhash near-dedup", near_dedup),
    ("secret scans", secrets),
    ("packing", pack),
]
#: The classifier, the fingerprints and the tokenizer have no SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each stored as Parquet and read again as the next one's input.

    A stage's table goes when the next one is stored; the last one stays for the reader of the result.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_path(spark, before)
        before = path
    return docs
