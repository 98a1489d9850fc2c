"""Batch encoding with remembered chunks: generations, shared prefixes and joined words give the libraries' ids."""

import random

import numpy as np
import public_tokenizers

from curata.llm import piece_bpe, token_files

WORDS = ["the", "then", "theme", "thematic", "un", "under", "underneath", "naïve", "日本", "x" * 80, "a,b", "it's", "end.", "1,234", "🙂", "​", "﻿q", "", "\n", "  ", "\t"]


def batches(n, seed):
    rng = random.Random(seed)
    return [[" ".join(rng.choice(WORDS) + rng.choice(["", "", ",", ".", "s"]) for _ in range(rng.randint(0, 40))) for _ in range(20)] for _ in range(n)]


def test_pieces_of_batches_with_generations(monkeypatch):
    monkeypatch.setattr(piece_bpe, "CHUNKS_KEPT", 24)
    coder = piece_bpe.PrefixTableEncoder(public_tokenizers.path("piece_bpe_32k.model"))
    for texts in batches(40, 3):
        assert coder.encode_batch(texts) == coder.processor.encode(texts)
        assert all(len(c) <= 64 for c in coder.kept)
    assert coder.encode_batch([None, ""]) == [[], []]


def test_shared_prefixes_do_not_leak_between_chunks():
    coder = piece_bpe.PrefixTableEncoder(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(4)
    chunks = {"▁" + "".join(rng.choice("abeinrst") for _ in range(rng.randint(1, 12))) for _ in range(3000)}
    together = dict(coder.encode_chunks(chunks))
    assert together.keys() == chunks
    assert all(together[c] == coder.processor.encode(c[1:]) for c in chunks)


def test_byte_ids_of_batches_with_generations(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "CHUNKS_KEPT", 24)
    file = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(file)
    library.encode_special_tokens = True
    coder = token_files.ByteBpeEncoder(file)
    for texts in batches(40, 5):
        got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode_batch(texts)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
