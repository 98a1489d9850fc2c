"""Strings of added tokens, against an unchanged Tokenizer."""

import zlib

import numpy as np
import public_tokenizers

from curata.llm import queries, token_files


def test_query_gives_the_ids_of_the_plain_call(spark, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end}, x.", f"  {end}\n\n{end}.", f"word{end}word, and more.", f"a {end[:-1]} b", "<|endof text|>", f"\t{end} \u3000 x", f"\0 {end}", "plain text.", None, ""]
    rows = [(i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want, at = [], 0
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = queries.op10_token_files(spark, str(tmp_path)).orderBy("start").select("doc_id", "start", "n_tokens", "ids_crc32")
    assert [tuple(r) for r in got.collect()] == want
    assert library.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    as_text = token_files.ByteBpeEncoder(public_tokenizers.path("byte_bpe_50k.json")).encode_batch(texts[:1])[0]
    assert len(as_text) == 4 * 9
