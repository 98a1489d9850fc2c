"""Token-id files in Parquet (operator 10).

Documents are range-partitioned and sorted by key, encoded, and written by Spark's Parquet writer
so that the files in name order hold the documents in ascending key order:

* ``tokens``  list<int32>, dictionary encoding (ids of one vocabulary repeat);
* ``doc_id``, ``part``, ``part_start``, ``n_tokens``: delta encoding (sorted or small numbers);
* row groups of ``ROW_GROUP_BYTES`` and pages of ``PAGE_BYTES`` with page indexes, so a reader that
  wants some documents or only metadata reads few pages.

``part`` is the number of the writing task and ``part_start`` the ids before the document in that
task, so a document's global start needs only one total per part.  A lost task is run again on the
same range and writes the same rows.

Defined results: NULL text counts as empty (its only id is the end id); a NULL key sorts first;
rows with equal keys are ordered by text; an empty table gives files without rows.  Strings of
special tokens inside a text are ordinary text, or with ``special_tokens`` the ids that the library's
plain call gives them.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from curata.llm.common import byte_of_character, held_by_worker

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
#: Chunks whose ids a worker remembers, in two generations: what is used again outlives the older one.
CHUNKS_KEPT = 1_600_000
#: White space other than blank and line break, where chunk borders would need more care.
_OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_OTHER_ASCII = [c for c in _OTHER_SPACE if c < "\x80"]
#: A run of blanks and breaks goes with what follows it.
_CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: One blank and Latin letters: one pre-token.
_PLAIN = re.compile(r" [A-Za-zÀ-ÖØ-öø-ɏ]+")
#: Characters of the longest chunk that is remembered.
LONGEST_KEPT = 64


class ByteBpeEncoder:
    """Encodes with the tokenizers library, remembering the ids of repeated chunks.

    The file's pre-tokeniser never joins a character with white space that follows it, so a text
    may be cut before any run of white space.  Texts with unusual white space are encoded whole, and
    so are, with ``special_tokens``, texts that hold the string of an added token.
    """

    def __init__(self, tokenizer_file: str, special_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.encode_special_tokens = not special_tokens
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if special_tokens else []
        self.characters = {byte: c for c, byte in byte_of_character().items()}
        self.plain = True
        self.kept = _Kept(self.encode_chunk, {})
        own = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        samples = [" word", " Größe", " naïvetés"]
        self.plain = not any(map(str.isalpha, own)) and all(
            [t.id for t in self.tokenizer.model.tokenize(self._alphabet(x))] == self.tokenizer.encode(x, add_special_tokens=False).ids for x in samples)

    def chunks(self, text: str) -> list[str]:
        if any(c in text for c in (_OTHER_ASCII if text.isascii() else _OTHER_SPACE)) or any(t in text for t in self.added):
            return [text]
        if "\0" in text or "  " in text or "\n\n" in text or "\n " in text or " \n" in text or text.endswith((" ", "\n")):
            return _CHUNK.findall(text)
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def encode_chunk(self, chunk: str) -> bytes:
        """Ids of a chunk that is not remembered; a plain word is one pre-token, so its bytes go to the model at once."""
        if chunk[-1:] in (",", ".") and chunk[-2:-1].isalpha():
            return self.kept[chunk[:-1]] + self.kept[chunk[-1]]     # a letter and a comma or full stop after it are always apart
        if self.plain and (chunk[:1] == " " and chunk[1:].isalpha() if chunk.isascii() else _PLAIN.fullmatch(chunk)):
            ids = [t.id for t in self.tokenizer.model.tokenize(self._alphabet(chunk))]
        else:
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def _alphabet(self, chunk: str) -> str:
        """The chunk's bytes in the byte-level alphabet."""
        return "Ġ" + chunk[1:] if chunk.isascii() else chunk.encode().decode("latin-1").translate(self.characters)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.kept) > CHUNKS_KEPT // 2:
            self.kept = _Kept(self.encode_chunk, dict(self.kept))
        ids = self.kept.__getitem__
        return [b"".join(map(ids, self.chunks(t))) for t in texts]


class _Kept(dict):
    """Ids by chunk, in two generations; a chunk that is in neither is encoded when it is asked for, and kept unless it is long."""

    def __init__(self, encode: Callable[[str], bytes], older: dict[str, bytes]):
        super().__init__()
        self.encode, self.older = encode, older

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self.encode(chunk)
        if len(chunk) <= LONGEST_KEPT:
            self[chunk] = ids
        return ids


def encoder(tokenizer_file: str, special_tokens: bool = False) -> ByteBpeEncoder:
    """The worker's encoder: what it remembers serves all tasks that the worker runs."""
    return held_by_worker((ByteBpeEncoder, tokenizer_file, special_tokens), lambda: ByteBpeEncoder(tokenizer_file, special_tokens))


def _layout(key_type: T.DataType, key: str) -> T.StructType:
    return T.StructType([T.StructField(key, key_type), T.StructField("part", T.IntegerType()), T.StructField("part_start", T.LongType()),
                         T.StructField("n_tokens", T.IntegerType()), T.StructField("tokens", T.ArrayType(T.IntegerType()))])


def write_token_files(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, text: str = "text", key: str = "doc_id",
                      row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES, special_tokens: bool = False) -> None:
    """Encode every text, append ``end_id`` and write the files in ascending key order."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    ordered = rows.repartitionByRange("key", "h").sortWithinPartitions("key", "h", "text").select("key", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, at = encoder(tokenizer_file, special_tokens), TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                piece = batch.slice(start, 1000)
                ids = [x + end for x in coder.encode_batch(piece.column("text").to_pylist())]
                counts = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                offsets = np.concatenate([[0], np.cumsum(counts)])
                values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(ids))])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("key"), pa.array(np.full(len(ids), part, np.int32)), pa.array(at + offsets[:-1]), pa.array(counts.astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)], [key, "part", "part_start", "n_tokens", "tokens"])
                at += int(offsets[-1])

    tokens = ordered.mapInArrow(encode, _layout(rows.schema["key"].dataType, key))
    options = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0", "parquet.block.size": row_group_bytes, "parquet.page.size": page_bytes,
               "parquet.enable.dictionary": "false", "parquet.enable.dictionary#tokens.list.element": "true"}
    tokens.write.options(**{k: str(v) for k, v in options.items()}).parquet(path)


def read_token_files(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The files' rows; with ``columns`` only these columns are read."""
    files = spark.read.parquet(path)
    return files.select(*columns) if columns else files


def with_start(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Add ``start``, the ids of all documents before a row; only one total per part of ``files`` is summed up."""
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("in_part"))
    before = totals.select("part", F.coalesce(F.sum("in_part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return rows.join(before, "part").withColumn("start", F.col("before") + F.col("part_start")).drop("before")


def id_checksums(files: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, part, part_start, n_tokens, ids_crc32): crc32 of the ids as little-endian unsigned 32-bit integers."""
    rows = files.select(key, "part", "part_start", "n_tokens", "tokens")
    schema = T.StructType([*rows.schema.fields[:4], T.StructField("ids_crc32", T.LongType())])

    def checksum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            offsets = np.asarray(lists.offsets)
            data = memoryview(np.ascontiguousarray(np.asarray(lists.values), dtype="<u4")).cast("B")
            sums = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(sums, pa.int64())], [*batch.schema.names[:4], "ids_crc32"])

    return rows.mapInArrow(checksum, schema)
