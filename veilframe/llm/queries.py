"""The queries of this folder's operators, one for each, over whole tables; SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.llm import dart_minhash, mixing, oracles, pii, spotsigs, tiff, token_counts, token_store, toxicity, trie_bpe, url_trust
from veilframe.llm.common import small_batches

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; sets the session's Arrow batches to a size for texts."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text with surrogates, n_entities: one row for each document."""
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), pii.secret())


def op2_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust to nine digits: one row for each page."""
    ranks = {k: F.round(k, 9) for k in ("trust", "distrust")}
    return url_trust.judge(table(spark, sf_dir, "pages")).withColumns(ranks)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each document."""
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row for each document."""
    return mixing.taken(table(spark, sf_dir, "documents"))


def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints and two likenesses: one row for each document."""
    return spotsigs.edits(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row for each document."""
    return token_counts.count(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id with sizes and digests of its payload and file, and a feature: one row for each document."""
    return tiff.document_media(table(spark, sf_dir, "documents"))


def op8_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: one row for each document."""
    return trie_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, read back from the files: one row for each document."""
    return token_store.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id: one row for each document."""
    return dart_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_pii, op2_url_trust, op3_token_counts, op4_toxicity, op5_mixing, op6_spotsigs, op7_tiff, op8_trie_bpe, op9_token_store, op10_dart_minhash)}


def oracle_sql() -> dict[str, str]:
    return {"op2_url_trust": oracles.URL_TRUST, "op10_dart_minhash": oracles.NEAR_DUPLICATES}
