"""SentencePiece BPE encoding with a merge-type prefix table, and decoding (operator 1).

The result of greedy merging has a local description: a sequence of pieces is the encoding of a
text exactly if merging any two neighbouring pieces' characters gives these two pieces again.  So
every prefix of a text has one valid last piece, and the table of last pieces is filled from left
to right: an Aho-Corasick automaton reports the pieces that end at a position, and the one that is
compatible with the last piece of the prefix before it is stored.  Ids are recovered from the end
of the table backwards.  The work is linear in the text, also for a text without any blank.

No piece holds a blank mark after another character, and some characters (line breaks, say) occur
in no piece but their own; both are read from the vocabulary.  No merge crosses such a place, so
the text is cut there and the encodings of repeated chunks are kept in a bounded table.

Defined results: NULL text counts as empty; an empty text has no ids and decodes to ''.  Characters
outside the vocabulary become their UTF-8 byte pieces.  Repeated rows are encoded alike.  Extra
columns of the input are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain

import ahocorasick
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.llm.common import held_by_worker

MARK = "▁"
#: Chunks whose encoding a worker remembers, in two generations: what is used again outlives the older one.
CHUNKS_KEPT = 800_000
PAIRS_KEPT = 1_000_000
_UNKNOWN = -1


class PrefixTableEncoder:
    """Encodes as ``sentencepiece`` does for BPE models with byte fallback and identity normalisation."""

    def __init__(self, model_file: str):
        self.processor = sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = sp.get_piece_size()
        normal = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.piece = {i: sp.id_to_piece(i) for i in normal}
        self.id_of = {p: i for i, p in self.piece.items()}
        self.score = {p: sp.get_score(i) for i, p in self.piece.items()}
        self.byte_id = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id_of.items():
            self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        if any(MARK in p.lstrip(MARK) for p in self.id_of):
            raise ValueError("a piece holds a blank inside: chunks cannot be cut at blanks")
        #: A line break that is in no longer piece stands alone.
        self.lone_break = not any("\n" in p and p != "\n" for p in self.id_of)
        self.kept: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}

    def merged(self, text: str) -> list[str]:
        """Greedy merging of a short text: best score first, leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, a: int, b: int) -> bool:
        """Whether piece ``b`` can follow piece ``a`` in an encoding; for no piece ``a``, whether it can stand first,
        as it does if merging its own characters gives it."""
        if len(self.pairs) >= PAIRS_KEPT:
            self.pairs.clear()
        x, y = ([self.piece[a]] if a != _UNKNOWN else []), self.piece[b]
        found = self.pairs[a, b] = self.merged("".join(x) + y) == [*x, y]
        return found

    def encode_chunks(self, texts: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """Each text, whose blanks are already marks, with its ids.

        The texts are taken in order: the table of last pieces depends on the prefix alone, so the entries of
        the prefix that a text shares with the one before it still hold.
        """
        last: list[int] = []         # last piece of the prefix that ends here
        length: list[int] = []
        before = ""
        pairs, matches = self.pairs, self.automaton.iter
        for text in sorted(texts):
            same = 0
            for x, y in zip(before, text):
                if x != y:
                    break
                same += 1
            del last[same:], length[same:]
            last += [_UNKNOWN] * (len(text) - same)
            length += [1] * (len(text) - same)
            for end, (size, token) in matches(text):
                if end < same or last[end] != _UNKNOWN:
                    continue
                left = last[end - size] if end >= size else _UNKNOWN
                fits = pairs.get((left, token))
                if self.compatible(left, token) if fits is None else fits:
                    last[end], length[end] = token, size
            ids: list[int] = []
            end = len(text) - 1
            while end >= 0:
                token = last[end]
                if token == _UNKNOWN:
                    ids.extend(self.byte_id[b] for b in reversed(text[end].encode("utf-8", "replace")))
                else:
                    ids.append(token)
                end -= length[end]
            ids.reverse()
            before = text
            yield text, ids

    def encode_chunk(self, text: str) -> list[int]:
        """Ids of a text whose blanks are already marks."""
        return next(self.encode_chunks([text]))[1] if text else []

    def chunks(self, text: str) -> list[str]:
        """The marked text, cut where no merge can cross."""
        text = text.replace(MARK, " ")
        if self.lone_break and "  " not in text and "\0" not in text and not text.startswith(" ") and "\n " not in text:
            marked = text.replace(" ", "\0" + MARK).replace("\n", "\0\n\0")
            return [x for x in (MARK + marked).split("\0") if x]
        marked = MARK + text.replace(" ", MARK)
        return re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", marked)

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text; chunks seen before are not encoded again while they are kept."""
        cut = [self.chunks(t) if t else [] for t in texts]
        if len(self.kept) > CHUNKS_KEPT // 2:
            self.older, self.kept = self.kept, {}
        kept, older = self.kept, self.older
        missing = set().union(*cut) - kept.keys()
        known = missing & older.keys()
        kept.update((c, older[c]) for c in known)
        kept.update(self.encode_chunks(missing - known))
        out = [list(chain.from_iterable(map(kept.__getitem__, x))) for x in cut]
        for c in [c for c in missing if len(c) > 64]:
            del kept[c]
        return out

    def encode(self, text: str | None) -> list[int]:
        return self.encode_batch([text])[0]

    def decode(self, ids: list[int]) -> str:
        return self.processor.decode(ids)


def encoder(model_file: str) -> PrefixTableEncoder:
    """The worker's encoder: its tables serve all tasks that the worker runs."""
    return held_by_worker((PrefixTableEncoder, model_file), lambda: PrefixTableEncoder(model_file))


def encode_documents(docs: DataFrame, model_file: str, text: str = "text", key: str = "doc_id", compare: bool = False) -> DataFrame:
    """(key, ids array<int>, decoded string) for every row; ``model_file`` must exist on every machine.

    With ``compare`` the last column is ``lossless``, whether the decoded text equals the row's, and no text leaves the worker.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([T.StructField(key, rows.schema["key"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("lossless", T.BooleanType()) if compare else T.StructField("decoded", T.StringType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model_file)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                texts = part.column("text").to_pylist()
                ids = coder.encode_batch(texts)
                decoded = map(coder.decode, ids)
                last = pa.array([x == y for x, y in zip(decoded, texts, strict=True)], pa.bool_()) if compare else pa.array(decoded, pa.string())
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(ids, pa.list_(pa.int32())), last], schema.names)

    return rows.mapInArrow(encode, schema)


def decode_documents(encoded: DataFrame, model_file: str, ids: str = "ids") -> DataFrame:
    """Add the text that ``ids`` stand for as ``decoded`` (NULL ids: NULL)."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        processor = sentencepiece.SentencePieceProcessor(model_file=model_file)
        for batch in batches:
            yield batch.map(lambda x: None if x is None else processor.decode([int(i) for i in x]))

    return encoded.withColumn("decoded", decode(F.col(ids)))
