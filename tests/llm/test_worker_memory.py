"""A worker holds one large helper; the pipeline's last stage sends each text to the worker once and none back."""

import random

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from curata.llm import common, piece_bpe, token_files


def test_a_worker_holds_one_helper():
    first = common.held_by_worker("first", list)
    assert common.held_by_worker("first", list) is first
    piece_bpe.encoder(public_tokenizers.path("piece_bpe_32k.model"))
    last = token_files.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert list(common._HELD.values()) == [last]


def test_texts_are_compared_in_the_worker(spark):
    rows = [(1, "a text"), (2, "a ▁ mark"), (3, None), (None, "  two "), (None, "  two ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = corpus_pipeline.encode(spark, docs, "")
    assert "decoded" not in out._jdf.queryExecution().toString()
    plain = piece_bpe.encode_documents(docs.withColumn("row", F.struct("doc_id", F.coalesce("text", F.lit("")).alias("text"))), public_tokenizers.path("piece_bpe_32k.model"), key="row")
    want = plain.select("row.doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == F.col("row.text")).alias("lossless"))
    assert out.schema.names == want.schema.names
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    assert {r.lossless for r in out.collect()} == {True, False}


def test_plain_words_go_to_the_model_as_the_library_sends_them():
    coder = token_files.ByteBpeEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(6)
    letters = "abcdeghijklmnorstuzABERéèñöüßçøÆ"
    words = [" " + "".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) for _ in range(3000)]
    assert coder.plain
    for w in [*words, " x2", " it's", " ÷a", " ×", " ", " ʰa", " 日本"]:
        assert np.frombuffer(coder.encode_chunk(w), "<u4").tolist() == coder.tokenizer.encode(w, add_special_tokens=False).ids, w
