"""Language identification by compression (operator 3).

One raw-content zstandard dictionary per language is filled with labelled text.  A text is
encoded with every dictionary; the language whose dictionary gives the fewest bytes wins.  The
text is cut into blocks of ``BLOCK`` bytes and every block is encoded (none is left out): within
one long block the text's own history would replace the dictionary and the sizes would converge.

Defined results
* NULL text, empty text or text without a letter: ``und``, score 0, rejected.
* No labelled text at all: every text is ``und``, score 0, rejected.
* Equal sizes (texts of a few words, which zstandard stores as they are): the text is encoded again
  at ``TIE_LEVEL`` with blanks around it, so that the fixed cost of a compressed block is paid for
  and short matches count; if sizes are still equal the language with more labelled rows wins, then
  the smaller name, and margin is 0.
* ``rejected`` marks texts whose margin (second - first) / second is below ``min_margin``, but only
  from ``EVIDENCE_BYTES`` letters on: a shorter text has no room for a margin, takes the more
  frequent language and stays.

Fitting takes a bounded sample: about ``SAMPLE_DOCS`` labelled documents per language, drawn by a
hash of the key, ``SLICE_CHARS`` characters of each, until a dictionary holds
``DICTIONARY_BYTES``.  These bounds do not depend on the input size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DICTIONARY_BYTES = 65_536
SAMPLE_DOCS = 512
SLICE_CHARS = 600
LEVEL = 5
TIE_LEVEL = 19
TIE_PAD = b" " * 48
EVIDENCE_BYTES = 64
BLOCK = 1024
MIN_MARGIN = 0.004
UNDETERMINED = "und"

#: ASCII bytes other than letters become blanks; bytes of other characters stay.
_LETTERS_ONLY = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def normalise(text: str) -> bytes:
    """Lower-case words joined by single blanks: case, digits and ASCII punctuation tell no language."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS_ONLY).split())


def fit_dictionaries(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> dict[str, bytes]:
    """Language -> dictionary content, most frequent language first (ties: smaller name first)."""
    rows = docs.select(F.col(key).cast("string").alias("k"), F.col(lang).cast("string").alias("l"), F.col(text).cast("string").alias("t"))
    rows = rows.filter("l IS NOT NULL")
    counts = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    draw = F.pmod(F.xxhash64(F.lit("language-id"), "k"), F.lit(1_000_000_007))
    limit = F.create_map(*[x for l, n in counts.items() for x in (F.lit(l), F.lit(math.ceil(1_000_000_007 * min(1.0, SAMPLE_DOCS / n))))])
    middle = F.greatest(F.lit(1), (F.length("t") / 2 - SLICE_CHARS // 2).cast("int"))
    sample = (rows.filter("t IS NOT NULL").withColumn("draw", draw).filter(F.col("draw") < limit[F.col("l")])
              .select("l", "draw", F.substring(F.col("t"), middle, F.lit(SLICE_CHARS)).alias("t"))
              .groupBy("l", "t").agg(F.min("draw").alias("draw")).collect())
    found: dict[str, bytes] = {}
    for name in sorted(counts, key=lambda x: (-counts[x], x)):
        content, seen = [], 0
        for r in sorted((r for r in sample if r["l"] == name), key=lambda r: (r["draw"], r["t"])):
            words = normalise(r["t"])
            if words and seen < DICTIONARY_BYTES:
                content.append(words)
                seen += len(words) + 1
        if content:
            found[name] = b" ".join(content)[:DICTIONARY_BYTES]
    return found


class CompressionClassifier:
    """Sizes of a text under every language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = list(dictionaries)
        self.contents = list(dictionaries.values())
        self.fast = [self._coder(x, LEVEL) for x in self.contents]
        self.fine: list | None = None

    @staticmethod
    def _coder(content: bytes, level: int):
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        return zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress

    def predict(self, text: str | None, min_margin: float) -> tuple[str, float, float, bool]:
        """(language, score, margin, rejected)."""
        if not self.names or not text or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, 0.0, True
        data = normalise(text)
        blocks = [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]
        sizes = [sum(len(f(b)) for b in blocks) for f in self.fast]
        order = sorted(range(len(sizes)), key=sizes.__getitem__)   # stable: earlier name wins a tie
        if len(order) > 1 and sizes[order[0]] == sizes[order[1]]:
            self.fine = self.fine or [self._coder(x, TIE_LEVEL) for x in self.contents]
            sizes = [sum(len(f(b" " + b + TIE_PAD)) for b in blocks) for f in self.fine]
            order.sort(key=sizes.__getitem__)
        best = sizes[order[0]]
        margin = (sizes[order[1]] - best) / max(1, sizes[order[1]]) if len(order) > 1 else 1.0
        return self.names[order[0]], 1.0 - math.exp(-40.0 * margin), margin, len(data) >= EVIDENCE_BYTES and margin < min_margin


def identify(dictionaries: dict[str, bytes], text: str | Column = "text", min_margin: float = MIN_MARGIN) -> Column:
    """Struct column (lang_pred, score, margin, rejected) for a text column."""

    @F.pandas_udf("lang_pred string, score double, margin double, rejected boolean")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = CompressionClassifier(dictionaries)
        for texts in batches:
            yield pd.DataFrame([model.predict(t, min_margin) for t in texts], columns=["lang_pred", "score", "margin", "rejected"])

    return classify(F.col(text).cast("string") if isinstance(text, str) else text)


def keep_identified(docs: DataFrame, training: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
                    min_margin: float = MIN_MARGIN) -> DataFrame:
    """The rows of ``docs``, with their own columns, whose language is not rejected."""
    verdict = identify(fit_dictionaries(training, text, lang, key), text, min_margin)
    return docs.filter(~verdict["rejected"])
