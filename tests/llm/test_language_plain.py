"""Language ID against a plain loop over languages and blocks."""

import re

import zstandard

from curata.llm import language_id
from tests.conftest import SF_SMALL


def _size(data, content, level, before=b"", after=b""):
    total = 0
    for at in range(0, len(data), language_id.BLOCK):
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=level)
        coder = zstandard.ZstdCompressor(level=level, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False)
        total += len(coder.compress(before + data[at:at + language_id.BLOCK] + after))
    return total


def _plain(text, dictionaries):
    if not any(c.isalpha() for c in text or ""):
        return "und", True
    data = re.sub(r"[\x00-\x40\x5b-\x60\x7b-\x7f]+", " ", text.lower()).strip(" ").encode()
    sizes = [(_size(data, content, language_id.LEVEL), i, name) for i, (name, content) in enumerate(dictionaries.items())]
    if sorted(sizes)[0][0] == sorted(sizes)[1][0]:
        order = [i for _, i, _ in sorted(sizes)]
        names = list(dictionaries)
        sizes = [(_size(data, dictionaries[names[i]], language_id.TIE_LEVEL, b" ", language_id.TIE_PAD), place, names[i]) for place, i in enumerate(order)]
    first, second = sorted(sizes)[:2]
    return first[2], len(data) >= language_id.EVIDENCE_BYTES and (second[0] - first[0]) / second[0] < language_id.MIN_MARGIN


def test_language_equals_a_plain_loop(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    dictionaries = language_id.fit_dictionaries(docs)
    more = spark.createDataFrame([("",), (None,), ("½ ² 12",), ("die",), ("A",), ("the la der el",), ("x" * 5000,), ("word " * 3000,)], "text string")
    rows = docs.select("text").filter("length(text) < 4000").unionByName(more).select("text", language_id.identify(dictionaries).alias("x")).collect()
    assert len(rows) > 100
    assert [(r.x.lang_pred, r.x.rejected) for r in rows] == [_plain(r.text, dictionaries) for r in rows]
