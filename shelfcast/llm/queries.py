"""The operators as named queries over whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate,
    language,
    lattice,
    lexical,
    main_text,
    packing,
    pieces,
    quality,
    secret_scan,
    sharding,
    simhash,
    spelling,
    url_filter,
)
from .oracles import ORACLES  # noqa: F401


TOKEN_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept_words",
        "kept",
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"))


def op3_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score(table(spark, sf_dir, "documents"), PIECE_MODEL, iterations=1, whole_words=True)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = secret_scan.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("spans")
    return docs.select(
        "doc_id",
        *[secret_scan.count(spans, kind).alias(f"n_{kind}") for kind in secret_scan.KINDS],
        F.sha2(secret_scan.joined(spans, secret_scan.KINDS[:3]), 256).alias("base_sha256"),
        secret_scan.joined(spans).alias("spans"),
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each segment of each document is, with digests of its ids and of the packed row that holds it.

    The row's digests are those of the padded ids (2 bytes each), the cumulative lengths and the positions
    (4 bytes each), all little-endian.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = packing.pack_documents(docs, TOKEN_RANKS, public_tokenizers.PATTERN)
    lengths = F.array_join(F.transform("cu_seqlens", packing.little_endian_hex), "")
    laid = rows.select(
        "pack_group",
        "pack_row",
        "ids",
        F.sha2("ids", 256).alias("row_sha256"),
        F.sha2(F.unhex(lengths), 256).alias("cu_seqlens_sha256"),
        F.sha2("positions", 256).alias("positions_sha256"),
        F.explode("segments").alias("s"),
    )
    own = F.substring(F.col("ids"), F.col("s.start") * 2 + 1, F.col("s.n_tokens") * 2)
    return laid.select(
        F.col("s.doc_id").alias("doc_id"),
        F.col("s.segment").alias("segment"),
        F.col("s.n_segments").alias("n_segments"),
        F.col("s.n_tokens").alias("n_tokens"),
        "pack_group",
        "pack_row",
        F.col("s.start").alias("start"),
        F.sha2(own, 256).alias("ids_sha256"),
        "row_sha256",
        "cu_seqlens_sha256",
        "positions_sha256",
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judged(pages).drop("url")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encoded(docs, PIECE_MODEL).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.by_bytes(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(sharding.LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(
        F.max("compared").cast("long").alias("compared"), F.max("agreeing").cast("long").alias("agreeing")
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents"))


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_simhash": op2_simhash,
    "op3_lattice_score": op3_lattice_score,
    "op4_language": op4_language,
    "op5_secrets": op5_secrets,
    "op6_packing": op6_packing,
    "op7_url_filter": op7_url_filter,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_sharding": op9_sharding,
    "op10_decontaminate": op10_decontaminate,
    "op11_lexical_search": op11_lexical_search,
    "op12_spelling_groups": op12_spelling_groups,
    "op13_main_text": op13_main_text,
}
