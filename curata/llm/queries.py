"""The thin ``opN_<name>`` queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.llm import (
    blob_ledger, decontamination, language_id, merkle_manifest, near_duplicates, personal_data, piece_bpe, projected_search, site_style, token_alignment,
    token_counts, token_files, toxicity)
from curata.llm.common import keyed_bucket, shared_path, table
from curata.llm.oracles import LEAKS, MERKLE, NEAR_DUPLICATES, PERSONAL_DATA, SECRETS
from curata.llm.spans import joined


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = piece_bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), whole=True)
    return leaks.drop("score")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = keyed_bucket("doc_id", 4) == 2
    model = language_id.fit_dictionaries(docs.filter(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), language_id.identify(model).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score", "found.margin", "found.rejected")


def _count(spans: str, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def _digest(spans: str, kinds: tuple[str, ...]):
    base = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col(spans)).alias("spans")


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.add_spans(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.col("personal_data").alias("s"))
    scores = F.array_join(F.transform("s", lambda s: s["score"].cast("string")), ",").alias("scores")
    return found.select("doc_id", *[_count("s", k) for k in personal_data.BASE], *_digest("s", personal_data.BASE), scores)


def op5_site_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op6_projected_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projected_search.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(keyed_bucket("doc_id", 3) != 1))
    scored = model.score(docs.select("doc_id", "text"))
    return scored.select("doc_id", (keyed_bucket("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = blob_ledger.scan_secrets(table(spark, sf_dir, "documents"), shared_path(spark, "blob-ledger")).withColumnRenamed("spans", "s")
    return found.select("doc_id", *[_count("s", k) for k in blob_ledger.BASE], *_digest("s", blob_ledger.BASE))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, special_tokens=True)
    sums = token_files.id_checksums(token_files.read_token_files(spark, path))
    placed = token_files.with_start(sums, token_files.read_token_files(spark, path, ["part", "n_tokens"]))
    return placed.select("doc_id", "start", F.col("n_tokens").cast("long").alias("n_tokens"), "ids_crc32")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


def merkle_rows(docs: DataFrame) -> DataFrame:
    """Leaf, roots and proof of every row, and the root folded from a leaf whose text has lost its line breaks on every second row."""
    whole = ["doc_id", "source", "lang", "n_chars", "text"]
    broken = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    altered = merkle_manifest.leaf_digest([*whole[:-1], F.replace("text", F.lit("\n"), F.lit(""))])
    manifest = merkle_manifest.build_manifest(docs, "source", "doc_id", whole, {"altered": F.when(broken & F.contains("text", F.lit("\n")), altered)})
    folded = merkle_manifest.fold(F.coalesce("altered", "digest"), F.col("path"))
    proofs = manifest.proofs().select(
        F.col("key").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root",
        merkle_manifest.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return proofs.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_rows(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_decontamination": op2_decontamination,
    "op3_language_id": op3_language_id,
    "op4_personal_data": op4_personal_data,
    "op5_site_style": op5_site_style,
    "op6_projected_search": op6_projected_search,
    "op7_toxicity": op7_toxicity,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_secret_scan": op9_secret_scan,
    "op10_token_files": op10_token_files,
    "op11_token_counts": op11_token_counts,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES: dict[str, str] = {
    "op2_decontamination": LEAKS,
    "op4_personal_data": PERSONAL_DATA,
    "op8_near_duplicates": NEAR_DUPLICATES,
    "op9_secret_scan": SECRETS,
    "op12_merkle_manifest": MERKLE,
}
