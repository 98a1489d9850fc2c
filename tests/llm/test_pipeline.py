"""The stages' contract and the whole run."""

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from curata.llm import blob_ledger, decontamination
from tests.conftest import SF_SMALL
from tests.llm.test_other_operators import _near
from tests.llm.test_text_operators import _brute_leaks, odd_docs


def test_stages_keep_columns_and_take_odd_tables(spark):
    base = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(40).withColumn("extra", F.lit(1))
    odd = odd_docs(spark).select("doc_id", "text", "lang", F.lit("s").alias("source"), F.lit(1).cast("bigint").alias("n_chars"), F.lit(2).alias("extra"))
    docs = base.unionByName(odd)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        if (name, stage) != corpus_pipeline.STAGES[-1]:
            assert out.columns == docs.columns, name
        assert 0 < out.count() <= docs.count(), name
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0, name


def test_run_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    kept = [(d, t) for (d, t), (_, _, _, k) in zip(rows, _near(rows), strict=True) if k]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    leaking = {x[0] for x in _brute_leaks(kept, items, whole=True)}
    assert set(got) == {d for d, _ in kept} - leaking
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for d, t in kept:
        if d in got and not any(f.search(t) for f in map(__import__("re").compile, (r.plain for r in blob_ledger.RULES if r.name != "hex"))):
            if not __import__("re").search("[0-9a-f]{24,}", t):
                assert list(got[d].ids) == library.encode(t)
        if d in got:
            assert got[d].lossless and got[d].n_tokens == len(got[d].ids)
    assert decontamination.SHINGLE == 5
