"""The document pipeline: quality rules, near-duplicates, benchmark passages, secrets, piece ids.

Each stage takes the documents that the one before it left. The first three remove documents (the first
also the failed lines of those it keeps), the fourth blanks out secrets, the last encodes what is left.

Defined results: null and empty texts fail the quality rules, so nothing of them is left; of repeated rows one
stays; a null ``doc_id`` yields to any other in its group; ``lang`` and ``source`` may be null and pass through; texts
of any length are read whole; extra columns, however they are called, pass the first four stages and are left
out by the last; empty documents or an empty benchmark give an empty result or remove nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import decontaminate, pieces, quality, queries, secret_scan, simhash
from shelfcast.llm.staging import staged

#: A benchmark item of fewer tokens is no passage: it would remove every document that holds that word.
LEAST_PASSAGE = 3


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without their failed lines."""
    return quality.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest ``doc_id``."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark of at least ``LEAST_PASSAGE`` tokens."""
    return decontaminate.remove(docs, queries.table(spark, sf_dir, "benchmark"), least=LEAST_PASSAGE)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets blanked out."""
    return secret_scan.redacted(docs)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every document, and digests of the ids and of the text decoded from them."""
    return pieces.encoded(docs.select("doc_id", "lang", "source", "text"), queries.PIECE_MODEL).select(
        "doc_id",
        "lang",
        "source",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("piece_ids", piece_ids),
]
#: XXH64 fingerprints, constants in code and piece ids are beyond SQL; tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and reread."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
