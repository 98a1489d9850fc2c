"""Token counts from pre-token counts, without materialising ids (operator 11).

A pre-token is a part of a text that no merge of the vocabulary can leave.  It is counted once, however often it
stands in the corpus; a document's count is the sum over its pre-tokens of frequency times count.

1. Pre-token frequencies of batches are summed to one table of distinct pre-tokens, and each is counted once.
2. Per document, the frequencies of pre-tokens with at least ``share`` of all occurrences are summed up against a
   broadcast table; by its rule it has at most ``1 / share`` entries.  All other (document, pre-token, frequency)
   rows are joined with the table of distinct pre-tokens; there no key holds more than ``share`` of the rows.

Where a text may be cut is read from the vocabulary: a piece holds blank marks only at its start, so a run of blanks
begins a pre-token; a character that no piece of two or more characters holds is a pre-token of its own.

Defined results: NULL text counts as empty; an empty text has no bytes and no tokens.  Every row of the input gives
one row, repeated or with a NULL key or not.  Strings of control pieces are ordinary text.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.llm.common import held_by_worker, materialise

MARK = "▁"
#: Share of all occurrences from which a pre-token is broadcast: at most two million entries.
COMMON_SHARE = 5e-7
#: Distinct pre-tokens that a task holds before it hands on their frequencies.
HELD = 300_000
_BREAK = "\n"


class PieceCounter:
    """Splits texts into pre-tokens and counts the pieces of a pre-token with the sentencepiece library."""

    def __init__(self, model_file: str):
        self.processor = sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
                  if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece holds a blank inside: texts cannot be cut at blanks")
        joining = "".join(sorted(set("".join(p for p in pieces if len(p) > 1)) - {MARK}))
        if _BREAK in joining:
            raise ValueError("a longer piece holds a line break: pre-tokens cannot be counted behind one")
        self.pattern = re.compile(f" *[{re.escape(joining)}]+| +|[^ {re.escape(joining)}]")
        self.before = len(sp.encode(_BREAK))

    def split(self, text: str) -> list[str]:
        """The pre-tokens of the text with the blank that the library puts in front."""
        return self.pattern.findall(" " + text.replace(MARK, " ")) if text else []

    def count(self, pre_tokens: list[str]) -> list[int]:
        """Pieces of each pre-token; a line break in front keeps the library's own blank away from it."""
        return [len(x) - self.before for x in self.processor.encode([_BREAK + p for p in pre_tokens], num_threads=1)]


def counter(model_file: str) -> PieceCounter:
    """The worker's counter, for all tasks that the worker runs."""
    return held_by_worker((PieceCounter, model_file), lambda: PieceCounter(model_file))


def pre_token_table(texts: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """(pre_token, n, tokens): every distinct pre-token, its occurrences and its pieces."""

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        split = counter(model_file).split
        for batch in batches:
            for value in batch.column("text"):
                held.update(split(value.as_py()))
                if len(held) >= HELD:
                    yield _counts(held)
                    held = Counter()
        if held:
            yield _counts(held)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = counter(model_file).count(batch.column("pre_token").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tokens, pa.int64())], ["pre_token", "n", "tokens"])

    rows = texts.select(F.col(text).cast("string").alias("text")).filter("text <> ''")
    seen = rows.mapInArrow(frequencies, "pre_token string, n long").groupBy("pre_token").agg(F.sum("n").alias("n"))
    return seen.mapInArrow(count, "pre_token string, n long, tokens long")


def _counts(held: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["pre_token", "n"])


def count_tokens(docs: DataFrame, model_file: str, text: str = "text", key: str = "doc_id", share: float = COMMON_SHARE) -> DataFrame:
    """(key, n_bytes, n_tokens) for every row; ``model_file`` must exist on every machine."""
    pre_tokens = materialise(pre_token_table(docs, model_file, text), "pre-tokens", "zstd")
    least = (pre_tokens.agg(F.sum("n")).first()[0] or 0) * share
    held = pre_tokens.filter(F.col("n") >= least).select("pre_token", "tokens").toArrow()
    common = docs.sparkSession.sparkContext.broadcast(dict(zip(held["pre_token"].to_pylist(), held["tokens"].to_pylist(), strict=True)))

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    others = T.ArrayType(T.StructType([T.StructField("pre_token", T.StringType()), T.StructField("times", T.IntegerType())]))
    schema = T.StructType([rows.schema["row"], rows.schema["key"], T.StructField("n_bytes", T.LongType()), T.StructField("known", T.LongType()),
                           T.StructField("others", others)])
    other_type = pa.struct([("pre_token", pa.string()), ("times", pa.int32())])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, known = counter(model_file).split, common.value
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                sizes, sums, offsets, names, times = [], [], [0], [], []
                for value in part.column("text"):
                    content = value.as_py()
                    total = 0
                    for pre_token, n in Counter(split(content)).items():
                        tokens = known.get(pre_token)
                        if tokens is None:
                            names.append(pre_token)
                            times.append(n)
                        else:
                            total += n * tokens
                    sizes.append(len(content.encode()))
                    sums.append(total)
                    offsets.append(len(names))
                entries = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(times, pa.int32())], fields=list(other_type))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("key"), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)], schema.names)

    looked_up = materialise(rows.mapInArrow(look_up, schema), "token-counts", "zstd")
    rare = pre_tokens.filter(F.col("n") < least).select("pre_token", "tokens")
    rest = looked_up.select("row", F.inline("others")).join(rare, "pre_token").groupBy("row").agg(F.sum(F.col("times") * F.col("tokens")).alias("rest"))
    total = F.col("known") + F.coalesce("rest", F.lit(0))
    return looked_up.drop("others").join(rest, "row", "left").select(F.col("key").alias(key), "n_bytes", total.alias("n_tokens"))
