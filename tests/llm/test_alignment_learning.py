"""What the aligner looks at for windows that it has not seen (operator 13)."""

from __future__ import annotations

import random

import public_tokenizers

from curata.llm import token_alignment


class Counted(list):
    """A list that counts what is taken from it."""

    taken = 0

    def __getitem__(self, i):
        self.taken += 1
        return super().__getitem__(i)


def _aligner():
    return token_alignment.Aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def _aligned(both, text):
    groups, links = both.align(*both.tokens(text, both.processor.encode(text)))
    return groups, links.tolist()


def test_only_the_tokens_of_new_windows_are_looked_at():
    both = _aligner()
    words = [f"word{i} und" for i in range(300)]
    _aligned(both, " ".join(words))
    both.marked = Counted(both.marked)
    _aligned(both, " ".join(words))
    assert both.marked.taken == 0
    words[150] = "qzxkvw"
    groups, links = _aligned(both, " ".join(words))
    assert 0 < both.marked.taken < 60
    assert (groups, links) == _aligned(_aligner(), " ".join(words))


def test_new_and_older_windows_of_one_document(monkeypatch):
    monkeypatch.setattr(token_alignment, "WINDOWS_KEPT", 40)
    both, pick = _aligner(), random.Random(5)
    words = [f"{x}{y}" for x in ("qzx", "Haus", "naïve", "12345678", "日本", "a\tb", "\n", "  ") for y in ("", "kv", "ing", "!?")]
    for _ in range(60):
        text = "x" + " ".join(pick.choices(words, k=30)) + pick.choice(["", f" {pick.random()}"])
        assert _aligned(both, text) == _aligned(_aligner_once, text)


_aligner_once = _aligner()
