"""A training-data pipeline over `documents`: toxic ones out, near copies out, personal data replaced, sources mixed, encoded.

Each stage takes (spark, docs, sf_dir), works on all rows it gets, and all but the last return the columns of documents.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.llm import dart_minhash, mixing, pii, toxicity, trie_bpe
from veilframe.llm.common import Scratch, small_batches

#: The tokenizer of the last stage.
TOKENIZER = os.environ.get("VEILFRAME_TOKENIZER") or public_tokenizers.path("word_bpe_49k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.5, by a classifier of this input's examples."""
    small_batches(spark)
    return toxicity.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least id."""
    small_batches(spark)
    return dart_minhash.deduplicate(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates; n_chars is that of the new text."""
    small_batches(spark)
    out = pii.pseudonymise(docs, pii.secret(), count=None)
    size = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long"))
    return out.withColumn("n_chars", size).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: sources weigh 3, 1, 2 in turn and share 150 % of all words."""
    small_batches(spark)
    return mixing.apply_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids (little-endian unsigned 32-bit), their number and the decoded text's digest."""
    small_batches(spark)
    return trie_bpe.encode(docs, TOKENIZER, keep=["doc_id", "source"], decoded=None, decoded_sha256="decoded_sha256")


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_copies), ("pii", replace_personal_data), ("mixing", mix_sources), ("bpe", encode)]

#: The stages learn, draw and search; tests hold them against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each stage's result is written to the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch.keep(docs)
    return docs
