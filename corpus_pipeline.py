"""Corpus pipeline over ``documents``: five operators in order, each stage written and read again.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``docs``.  Rows without what a stage needs are kept unless its docstring says otherwise.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.llm import blob_ledger, decontamination, language_id, near_duplicates, piece_bpe
from curata.llm.common import shared_path, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no learned language go: those without a letter, or with a margin that is too narrow for their length."""
    return language_id.keep_identified(docs, docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id."""
    return near_duplicates.keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item of ``benchmark`` go."""
    return decontamination.drop_leaking(docs, table(spark, sf_dir, "benchmark"), whole=True)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; ``n_chars``, if there, follows the text."""
    clean = blob_ledger.mask_secrets(docs, shared_path(spark, "pipeline-ledger"))
    return clean.withColumn("n_chars", F.length("text").cast(clean.schema["n_chars"].dataType)) if "n_chars" in clean.columns else clean


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, lossless): the ids of each text, and whether decoding them gives the text back."""
    coded = piece_bpe.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), compare=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "lossless")


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("secret_scan", mask_secrets),
    ("sentencepiece", encode),
]

#: Compression, MinHash families and piece merging are not SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
