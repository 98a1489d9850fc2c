"""Alignment of two tokenisations of the same text by anchors at white space (operator 13).

A is a byte-level BPE vocabulary with merges (JSON), B a sentencepiece model whose blanks are marked.  Both see the
text with one blank in front.  A text is aligned if the bytes of either side's tokens are exactly the text's bytes.

1. The text is tokenised whole by either side.
2. Anchors: a byte offset before a token that begins with a blank, on both sides, where both sides' preceding tokens
   end.  Anchors cut the document into windows, pairs of id tuples.
3. A window's groups follow from its id tuples alone, so they are worked out once for each pair of tuples and kept.
4. (A id, B id) pairs of linked tokens are counted over the corpus.  Counts of pairs with at least ``share`` of all
   links are broadcast (at most ``1 / share`` entries); other pairs' links are joined with the table of counts, where
   no key holds more than ``share`` of the rows.

The tokenised form is written to the shared folder once; texts are not read again.

Defined results: a text that is NULL, empty or not given back by both sides has no tokens, zeros and '' as groups.
Every input row gives one row, repeated or with a NULL key or not; repeated rows count each time.  Strings of special
tokens are ordinary text.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.llm.common import byte_of_character as _byte_of_character, materialise

MARK = "▁"
#: The pre-token pattern of the byte-level file's pre-tokeniser: a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Windows whose groups a worker remembers, in two generations; a generation ends between two documents.
WINDOWS_KEPT = 800_000
#: What follows an id in the groups' text: another id of its side, the other side, another group, another window.
MARKS = (",", "|", ";", "\n")
#: Share of all links from which a pair's count is broadcast.
COMMON_SHARE = 5e-6


class Aligner:
    """Tokenises with both vocabularies and aligns the tokens."""

    def __init__(self, byte_file: str, piece_file: str):
        with open(byte_file, encoding="utf-8") as f:
            model = json.load(f)
        byte_of = _byte_of_character()
        special = {t["content"] for t in model["added_tokens"]}
        vocab = {bytes(byte_of[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
        self.bytes_a = [b""] * (1 + max(vocab.values()))
        for token, i in vocab.items():
            self.bytes_a[i] = token
        merged = [self._pair(m) for m in model["model"]["merges"]]
        if [vocab[bytes(byte_of[c] for c in a + b)] for a, b in merged] != list(range(256, 256 + len(merged))):
            raise ValueError("ids are not in the order of merges")
        self.encoder = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=vocab, special_tokens={})
        self.processor = sp = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in side], dtype=np.int64) for side in (self.bytes_a, self.bytes_b))
        self.blank_a, self.blank_b = (np.array([x[:1] == b" " for x in side]) for side in (self.bytes_a, self.bytes_b))
        self.bits = max(1, len(pieces) - 1).bit_length()
        self.n_names = max(len(self.bytes_a), len(pieces))
        self.marked = [f"{i}{mark}" for mark in MARKS for i in range(self.n_names)]
        self.young, self.old = Windows(), Windows()

    @staticmethod
    def _pair(merge: str | list[str]) -> list[str]:
        return merge.split(" ") if isinstance(merge, str) else merge

    def tokens(self, text: str, ids_b: list[int]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides, or None if either side's tokens are not the text's bytes.

        The byte-level side splits the bytes and drops none, so its lengths must add up; the other side's bytes are compared.
        """
        raw = (" " + text).encode()
        if not text or b"".join(map(self.bytes_b.__getitem__, ids_b)) != raw:
            return None
        ids_a = np.array(self.encoder.encode_ordinary(" " + text), dtype=np.int64)
        return (ids_a, np.array(ids_b, dtype=np.int64)) if self.size_a[ids_a].sum() == len(raw) else None

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[str, np.ndarray]:
        """The groups' text and the codes of the links of a document."""
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        first_a, first_b = self.windows(a, b, end_a, end_b)
        # each window's A ids and then its B ids, which are shifted: one slice of bytes stands for the pair of id tuples
        n_a, n_b = np.diff(first_a), np.diff(first_b)
        mixed = np.empty(len(a) + len(b), dtype="<u4")
        mixed[np.arange(len(a)) + np.repeat(first_b[:-1], n_a)] = a
        mixed[np.arange(len(b)) + np.repeat(first_a[1:], n_b)] = b + len(self.bytes_a)
        data, cuts = mixed.tobytes(), (4 * (first_a + first_b)).tolist()
        if len(self.young.texts) >= WINDOWS_KEPT // 2:
            self.young, self.old = Windows(), self.young
        keys = [data[i:j] for i, j in zip(cuts, cuts[1:])]
        found = list(map(self.young.place.get, keys))
        if None in found:
            self._learn(keys, found, a, b, end_a, end_b, first_a, first_b)
        return ";".join(map(self.young.texts.__getitem__, found)), self.young.links_at(np.array(found))

    def windows(self, a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First tokens of the windows on both sides, and the number of tokens at the end."""
        marked_a, marked_b = np.flatnonzero(self.blank_a[a[1:]]), np.flatnonzero(self.blank_b[b[1:]])
        before_a, before_b = end_a[marked_a], end_b[marked_b]
        if not len(before_b):
            return np.array([0, len(a)]), np.array([0, len(b)])
        at = np.minimum(np.searchsorted(before_b, before_a), len(before_b) - 1)
        shared = before_b[at] == before_a
        return np.concatenate([[0], marked_a[shared] + 1, [len(a)]]), np.concatenate([[0], marked_b[at[shared]] + 1, [len(b)]])

    def _learn(self, keys: list[bytes], found: list[int | None], a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray,
               first_a: np.ndarray, first_b: np.ndarray) -> None:
        """Place the windows that ``found`` lacks: older ones are taken over, the others are worked out together and remembered."""
        young, old = self.young, self.old
        missing = [i for i, place in enumerate(found) if place is None]
        fresh = {}
        for i in missing:
            key = keys[i]
            before = old.place.get(key)
            if before is None:
                fresh.setdefault(key, i)
            elif key not in young.place:
                young.add(key, *old.at(before))
        if fresh:
            young.add_all(fresh, *self._worked_out(np.array(list(fresh.values())), a, b, end_a, end_b, first_a, first_b))
        for i in missing:
            found[i] = young.place[keys[i]]

    def _worked_out(self, windows: np.ndarray, a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray,
                    first_a: np.ndarray, first_b: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The groups' texts of these windows (ascending), their links one after another, and their numbers of links.

        Only the windows' tokens are looked at.  Both sides of a window end together, so no group crosses windows.
        """
        (in_a, upto_a), (in_b, _) = _slices(first_a, windows), _slices(first_b, windows)
        a, b, ends_a, ends_b = a[in_a], b[in_b], end_a[in_a], end_b[in_b]
        at = np.searchsorted(ends_b, ends_a)
        last_a = np.flatnonzero(ends_b[at] == ends_a)
        last_b = at[last_a]
        # a group's A ids and then its B ids, each with the mark that follows it
        mark_a, mark_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        upto = np.searchsorted(last_a, upto_a - 1) + 1
        mark_a[last_a], mark_b[last_b], mark_b[last_b[upto - 1]] = 1, 2, 3
        before_b = np.concatenate([[0], last_b[:-1] + 1])
        mixed = np.empty(len(a) + len(b), dtype=np.int64)
        mixed[np.arange(len(a)) + np.repeat(before_b, np.diff(last_a, prepend=-1))] = a + mark_a * self.n_names
        mixed[np.arange(len(b)) + np.repeat(last_a + 1, np.diff(last_b, prepend=-1))] = b + mark_b * self.n_names
        texts = "".join(map(self.marked.__getitem__, mixed.tolist())).split(MARKS[3])
        return texts[:-1], a[last_a] << self.bits | b[last_b], np.diff(upto, prepend=0)


def _slices(first: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of these windows' tokens, and how many there are up to each window's end."""
    lengths = first[windows + 1] - first[windows]
    upto = np.cumsum(lengths)
    return np.arange(upto[-1]) + np.repeat(first[windows] - (upto - lengths), lengths), upto


class Windows:
    """Alignments of windows by id tuples: groups' texts, and links in one flat array."""

    def __init__(self):
        self.place: dict[bytes, int] = {}
        self.texts: list[str] = []
        self.ends = array("q", [0])
        self.links = array("q")

    def add(self, key: bytes, text: str, links: Iterable[int]) -> int:
        place = self.place[key] = len(self.texts)
        self.texts.append(text)
        self.links.extend(links)
        self.ends.append(len(self.links))
        return place

    def add_all(self, keys: Iterable[bytes], texts: list[str], links: np.ndarray, sizes: np.ndarray) -> None:
        """Windows one after another; ``sizes`` are their numbers of links."""
        self.place.update(zip(keys, range(len(self.texts), len(self.texts) + len(texts)), strict=True))
        self.texts.extend(texts)
        self.ends.frombytes((len(self.links) + np.cumsum(sizes)).astype(np.int64).tobytes())
        self.links.frombytes(links.astype(np.int64).tobytes())

    def at(self, place: int) -> tuple[str, array]:
        return self.texts[place], self.links[self.ends[place]:self.ends[place + 1]]

    def links_at(self, places: np.ndarray) -> np.ndarray:
        """The links of the windows at these places, one after another."""
        ends, links = np.frombuffer(self.ends, dtype=np.int64), np.frombuffer(self.links, dtype=np.int64)
        first = ends[places]
        lengths = ends[places + 1] - first
        upto = np.cumsum(lengths)
        return links[np.arange(upto[-1]) + np.repeat(first - (upto - lengths), lengths)]


@lru_cache(maxsize=1)
def aligner(byte_file: str, piece_file: str) -> Aligner:
    """The worker's aligner, for all tasks that the worker runs."""
    return Aligner(byte_file, piece_file)


def align_documents(docs: DataFrame, byte_file: str, piece_file: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(row, key, n_a, n_b, n_groups, n_links, groups_sha256, codes, times) for every row.

    ``codes`` are the distinct linked pairs, A id shifted by the bits of a B id and B id, with ``times`` links each.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    counts = [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    schema = T.StructType([rows.schema["row"], T.StructField(key, rows.schema["key"].dataType), *counts, T.StructField("groups_sha256", T.StringType()),
                           T.StructField("codes", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.IntegerType()))])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(byte_file, piece_file)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = part.column("text").to_pylist()
                numbers, digests, codes, times = [], [], [], []
                for content, ids_b in zip(texts, both.processor.encode(texts, num_threads=1), strict=True):
                    tokens = both.tokens(content, ids_b)
                    groups, links = both.align(*tokens) if tokens else ("", np.zeros(0, dtype=np.int64))
                    code, n = np.unique(links, return_counts=True)
                    numbers.append((len(tokens[0]), len(tokens[1]), len(links), len(links)) if tokens else (0, 0, 0, 0))
                    digests.append(hashlib.sha256(groups.encode()).hexdigest() if tokens else "")
                    codes.append(code)
                    times.append(n.astype(np.int32))
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(c) for c in codes])]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x))) for x in (codes, times)]
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("key"), *(pa.array(c, pa.int64()) for c in zip(*numbers)),
                                                  pa.array(digests, pa.string()), *lists], schema.names)

    return rows.mapInArrow(align, schema)


def pair_counts(aligned: DataFrame, bits: int) -> DataFrame:
    """(code, n, best): links of each pair over all documents, and whether no other pair of its B id has more."""
    counted = aligned.select(F.inline(F.arrays_zip("codes", "times"))).groupBy("codes").agg(F.sum("times").alias("n"))
    of_b = Window.partitionBy(F.col("codes").bitwiseAND((1 << bits) - 1))
    return counted.select(F.col("codes").alias("code"), "n", (F.col("n") == F.max("n").over(of_b)).alias("best"))


def score_links(aligned: DataFrame, pairs: DataFrame, share: float = COMMON_SHARE) -> DataFrame:
    """``aligned`` with ``n_best`` and ``count_sum`` over its links, in place of ``codes`` and ``times``."""
    least = (pairs.agg(F.sum("n")).first()[0] or 0) * share
    held = pairs.filter(F.col("n") >= least).orderBy("code").toArrow()
    common = aligned.sparkSession.sparkContext.broadcast(tuple(held[c].to_numpy() for c in ("code", "n", "best")))
    fixed = [f for f in aligned.schema.fields if f.name not in ("codes", "times")]
    schema = T.StructType([*fixed, T.StructField("known_best", T.LongType()), T.StructField("known_sum", T.LongType()),
                           T.StructField("codes", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.IntegerType()))])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, n, best = common.value
        for batch in batches:
            lists = batch.column("codes")
            offsets = np.asarray(lists.offsets)
            codes, times = np.asarray(lists.values), np.asarray(batch.column("times").values)
            at = np.minimum(np.searchsorted(code, codes), max(len(code) - 1, 0))
            hit = code[at] == codes if len(code) else np.zeros(len(codes), bool)
            add_n = np.where(hit, n[at] * times, 0) if len(code) else np.zeros(len(codes), np.int64)
            add_best = np.where(hit & best[at], times, 0) if len(code) else np.zeros(len(codes), np.int64)
            up_to = [np.concatenate([[0], np.cumsum(x)])[offsets].astype(np.int64) for x in (add_best, add_n, ~hit)]
            rest = pa.array((up_to[2] - up_to[2][0]).astype(np.int32))
            missed = ~hit[offsets[0]:offsets[-1]]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in fixed), pa.array(np.diff(up_to[0])), pa.array(np.diff(up_to[1])),
                 pa.ListArray.from_arrays(rest, pa.array(codes[offsets[0]:offsets[-1]][missed])),
                 pa.ListArray.from_arrays(rest, pa.array(times[offsets[0]:offsets[-1]][missed]))], schema.names)

    looked_up = aligned.mapInArrow(look_up, schema)
    rare = pairs.filter(F.col("n") < least)
    links = looked_up.select("row", F.inline(F.arrays_zip("codes", "times")))
    rest = links.join(rare, links["codes"] == rare["code"]).groupBy("row").agg(
        F.sum(F.col("times") * F.col("n")).alias("rest_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("rest_best"))
    return looked_up.drop("codes", "times").join(rest, "row", "left").select(
        *[f.name for f in fixed], (F.col("known_best") + F.coalesce("rest_best", F.lit(0))).alias("n_best"),
        (F.col("known_sum") + F.coalesce("rest_sum", F.lit(0))).alias("count_sum"))


def alignment(docs: DataFrame, byte_file: str, piece_file: str, text: str = "text", key: str = "doc_id", share: float = COMMON_SHARE) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row."""
    bits = max(1, sentencepiece.SentencePieceProcessor(model_file=piece_file).get_piece_size() - 1).bit_length()
    aligned = materialise(align_documents(docs, byte_file, piece_file, text, key), "aligned")
    pairs = materialise(pair_counts(aligned, bits), "aligned-pairs")
    return score_links(aligned, pairs, share).select(key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
