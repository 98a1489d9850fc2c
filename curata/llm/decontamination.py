"""Benchmark decontamination: BM25 index of test items searched with block-max WAND (operator 2).

Test items are cut into units of at most ``UNIT`` words; an inverted index holds each word's units
with the word's share of the unit's BM25 score for its own words, so scores lie between 0 and 1 and
one threshold serves all units.  Every passage (window of two units' length, moved by one) of every
text is a query.  First, bounds of coarse blocks of units are summed up for all passages of a text at
once; where no block can reach the threshold, the search ends as a WAND search without pivot does.
In the blocks that are left, cursors over the words' posting lists run block-max WAND and return
every unit with at least ``LEAST_SCORE``, not a top k.

A retrieved item is verified on the whole text: of its question's shingles of five words at least
0.75 must occur there, and of its answer's as well.  If the items have one text column only, the last
quarter of its words (five at least) is the answer and what comes before is the question.  Such a cut
may fall anywhere, so with ``whole`` an item of one text column is also accepted if 0.75 of the shingles
of the whole item occur, wherever the others are missing; the counts are those of the parts all the same.

The index goes to all executors, so its size is checked: items are dealt by a hash into as many
shards as keep each one's text within ``SHARD_CHARS``, and the texts are searched once for each shard.
Shards pass through the driver one at a time: what one has found is written to the shared folder and its
broadcast released before the next is collected.  A Python worker builds a shard's index once for all its tasks.

Defined results: NULL or empty texts and items without words match nothing; an item with fewer than
ten words is its own question and answer; a part with fewer than five words is one shingle.  Repeated
rows each get their matches.  Words are runs of letters and digits in lower case.
"""

from __future__ import annotations

import math
import re
import uuid
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.llm.common import held_by_worker, materialise

UNIT = 64
LEAST_SCORE = 0.6
SHINGLE = 5
LEAST_OVERLAP = (75, 100)
SHARD_CHARS = 32 << 20
COARSE_BLOCKS = 64
POSTING_BLOCK = 16
SEGMENT = 8192          # words of a text that are bounded at once
K1, B = 1.2, 0.75

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def shingles_of(words: list[str]) -> set[tuple[str, ...]]:
    n = max(1, len(words) - SHINGLE + 1)
    return {tuple(words[i:i + SHINGLE]) for i in range(n)} if words else set()


class _Postings:
    """A word's units in ascending order with impacts, and the largest impact of each block of them."""

    def __init__(self, pairs: list[tuple[int, float]]):
        self.units = [u for u, _ in pairs]
        self.impacts = [x for _, x in pairs]
        self.block_most = [max(self.impacts[i:i + POSTING_BLOCK]) for i in range(0, len(pairs), POSTING_BLOCK)]
        self.most = max(self.impacts)


class TestIndex:
    """BM25 index over (item, question, answer)."""

    def __init__(self, items: list[tuple[object, str, str]], least_score: float = LEAST_SCORE, whole: bool = False):
        self.least_score = least_score
        self.wholes: list[set] = []         # shingles of the whole item, none where the parts alone decide
        self.parts: list[tuple[object, set, set]] = []
        self.unit_item: list[int] = []
        units: list[list[str]] = []
        for item, question, answer in items:
            q, a = words_of(question), words_of(answer)
            if answer is None:
                n = max(SHINGLE, len(q) // 4)
                q, a = (q, q) if len(q) < 2 * SHINGLE else (q[:-n], q[-n:])
                together = q + a if a is not q else q
            else:
                together = q + a
            if not together:
                continue
            self.parts.append((item, shingles_of(q or a), shingles_of(a or q)))
            self.wholes.append(shingles_of(together) if whole and answer is None else set())
            pieces = math.ceil(len(together) / UNIT)
            for k in range(pieces):
                units.append(together[k * len(together) // pieces:(k + 1) * len(together) // pieces])
                self.unit_item.append(len(self.parts) - 1)
        self.longest = max(map(len, units), default=1)
        held = Counter(w for u in units for w in set(u))
        mean = sum(map(len, units)) / max(1, len(units))
        lists: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for number, unit in enumerate(units):
            weight = {w: math.log(1 + (len(units) - held[w] + 0.5) / (held[w] + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(unit) / mean))
                      for w, tf in Counter(unit).items()}
            own = sum(weight.values())
            for w, x in weight.items():
                lists[w].append((number, x / own))
        self.word_id = {w: i + 1 for i, w in enumerate(lists)}      # 0: a word of no unit
        self.postings = [None, *map(_Postings, lists.values())]
        self.per_block = max(1, math.ceil(len(units) / COARSE_BLOCKS))
        self.coarse = np.zeros((len(lists) + 1, max(1, math.ceil(len(units) / self.per_block))), np.float32)
        for i, pairs in enumerate(lists.values()):
            for u, x in pairs:
                self.coarse[i + 1, u // self.per_block] = max(self.coarse[i + 1, u // self.per_block], x)

    def search(self, words: set[int], low: int, high: int) -> Iterator[tuple[int, float]]:
        """Block-max WAND: units in [low, high) whose score for the words reaches the threshold."""
        least = self.least_score - 1e-9
        cursors = [[bisect_left(p.units, low), p] for p in (self.postings[w] for w in words)]
        while True:
            cursors = [c for c in cursors if c[0] < len(c[1].units) and c[1].units[c[0]] < high]
            cursors.sort(key=lambda c: c[1].units[c[0]])
            total, pivot = 0.0, -1
            for k, (at, p) in enumerate(cursors):
                total += p.most
                if total >= least:
                    pivot = k
                    break
            if pivot < 0:
                return
            unit = cursors[pivot][1].units[cursors[pivot][0]]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][1].units[cursors[pivot + 1][0]] == unit:
                pivot += 1
            bound, until = 0.0, high
            for at, p in cursors[:pivot + 1]:
                block = bisect_left(p.units, unit, at) // POSTING_BLOCK
                if block < len(p.block_most):
                    bound += p.block_most[block]
                    until = min(until, p.units[min(len(p.units), (block + 1) * POSTING_BLOCK) - 1] + 1)
            if bound >= least:
                if cursors[0][1].units[cursors[0][0]] == unit:
                    score = sum(p.impacts[at] for at, p in cursors[:pivot + 1])
                    if score >= least:
                        yield unit, score
                    for c in cursors[:pivot + 1]:
                        c[0] += 1
                else:
                    for c in cursors[:pivot]:
                        c[0] = bisect_left(c[1].units, unit, c[0])
            else:
                # no unit up to the end of the shortest block at hand, or before the next list starts, can reach it
                if pivot + 1 < len(cursors):
                    until = min(until, cursors[pivot + 1][1].units[cursors[pivot + 1][0]])
                until = max(until, unit + 1)
                for c in cursors[:pivot + 1]:
                    c[0] = bisect_left(c[1].units, until, c[0])

    def retrieve(self, words: list[str]) -> dict[int, float]:
        """Best score of each item that some passage of the text retrieves."""
        get = self.word_id.get
        ids = np.fromiter((get(w, 0) for w in words), np.int32, len(words))
        step = self.longest
        found: dict[int, float] = {}
        segment = max(step, SEGMENT // step * step)
        for start in range(0, len(ids), segment):
            own = ids[start:start + segment + step]        # the last window reaches into the next segment
            known = np.flatnonzero(own)
            if not len(known):
                continue
            # within a step a repeated word counts once
            cells = np.unique((known // step).astype(np.int64) * (len(self.postings) + 1) + own[known])
            steps, terms = cells // (len(self.postings) + 1), cells % (len(self.postings) + 1)
            bounds = np.zeros((len(own) // step + 2, self.coarse.shape[1]), np.float32)
            firsts = np.flatnonzero(np.concatenate([[True], steps[1:] != steps[:-1]]))
            bounds[steps[firsts]] = np.add.reduceat(self.coarse[terms], firsts, axis=0)
            for w, block in zip(*np.nonzero(bounds[:-1] + bounds[1:] >= self.least_score - 1e-4), strict=True):
                if w * step >= segment:
                    continue
                distinct = set(own[w * step:(w + 2) * step].tolist()) - {0}
                for unit, score in self.search(distinct, int(block) * self.per_block, (int(block) + 1) * self.per_block):
                    item = self.unit_item[unit]
                    found[item] = max(score, found.get(item, 0.0))
        return found

    def leaks(self, text: str | None) -> Iterator[tuple[object, float, int, int, int, int]]:
        """(item, score, question's shingles, those in the text, answer's shingles, those in the text)."""
        words = words_of(text)
        found = self.retrieve(words) if words else {}
        if not found:
            return
        held = shingles_of(words)
        for number, score in sorted(found.items()):
            item, question, answer = self.parts[number]
            together = self.wholes[number]
            q, a, w = (sum(self._occurs(s, held, words) for s in part) for part in (question, answer, together))
            both = q * LEAST_OVERLAP[1] >= len(question) * LEAST_OVERLAP[0] and a * LEAST_OVERLAP[1] >= len(answer) * LEAST_OVERLAP[0]
            if both or together and w * LEAST_OVERLAP[1] >= len(together) * LEAST_OVERLAP[0]:
                yield item, score, len(question), q, len(answer), a

    @staticmethod
    def _occurs(shingle: tuple[str, ...], whole: set[tuple[str, ...]], words: list[str]) -> bool:
        if len(shingle) == SHINGLE:
            return shingle in whole
        n = len(shingle)
        return any(tuple(words[i:i + n]) == shingle for i in range(len(words) - n + 1))


def find_leaks(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id", question: str = "text",
               answer: str | None = None, least_score: float = LEAST_SCORE, whole: bool = False) -> DataFrame:
    """(doc_id, item_id, score, n_question, question_found, n_answer, answer_found) for each text and test item in it."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    tests, shards = _shards(items, item, question, answer)
    schema = T.StructType([T.StructField(key, rows.schema["key"].dataType), T.StructField(item, tests.schema["item"].dataType), T.StructField("score", T.DoubleType()),
                           *[T.StructField(n, T.LongType()) for n in ("n_question", "question_found", "n_answer", "answer_found")]])
    found = []
    for held, last in shards:
        own = rows.mapInArrow(_searcher(held, least_score, whole, schema), schema)
        found.append(own if last else materialise(own, "leaks"))
    return reduce(DataFrame.unionByName, found)


class _Shard:
    """Items of one shard on all executors, known to the workers by a name of its own."""

    def __init__(self, items: DataFrame):
        self.name = uuid.uuid4().hex
        self.items = items.sparkSession.sparkContext.broadcast([tuple(r) for r in items.orderBy("item", "q", "a").collect()])

    def index(self, least_score: float, whole: bool) -> TestIndex:
        """The shard's index, built once a worker; a worker keeps that of one shard."""
        return held_by_worker((self.name, least_score, whole), lambda: TestIndex(self.items.value, least_score, whole))


def _shards(items: DataFrame, item: str, question: str, answer: str | None) -> tuple[DataFrame, Iterator[tuple[_Shard, bool]]]:
    """The test items, and their shards of a checked size one after the other, with whether it is the last."""
    tests = items.select(F.col(item).alias("item"), F.col(question).cast("string").alias("q"), (F.col(answer).cast("string") if answer else F.lit(None).cast("string")).alias("a"))
    tests = tests.filter("coalesce(q, a) IS NOT NULL").distinct()
    chars = tests.agg(F.sum(F.coalesce(F.length("q"), F.lit(0)) + F.coalesce(F.length("a"), F.lit(0)))).first()[0] or 0
    n = max(1, math.ceil(chars / SHARD_CHARS))
    parts = [tests if n == 1 else tests.filter(F.pmod(F.xxhash64("item", "q", "a"), F.lit(n)) == i) for i in range(n)]

    def one_by_one() -> Iterator[tuple[_Shard, bool]]:
        for number, part in enumerate(parts, 1):
            shard = _Shard(part)
            yield shard, number == n
            if number < n:                  # its rows are written by now; the last one's are not
                shard.items.destroy()

    return tests, one_by_one()


def _searcher(held: _Shard, least_score: float, whole: bool, schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.index(least_score, whole)
        for batch in batches:
            out = [(k.as_py(), *leak) for k, t in zip(batch.column("key"), batch.column("text"), strict=True) for leak in index.leaks(t.as_py())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(arrow)], schema=arrow)

    return search


def drop_leaking(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", question: str = "text", answer: str | None = None,
                 least_score: float = LEAST_SCORE, whole: bool = False) -> DataFrame:
    """The rows of ``docs``, with their own columns, that hold no test item."""

    def holds(held: _Shard):
        @F.pandas_udf("boolean")
        def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            index = held.index(least_score, whole)
            for texts in batches:
                yield texts.map(lambda t: any(True for _ in index.leaks(t))).astype(bool)

        return found(F.coalesce(F.col(text).cast("string"), F.lit("")))

    for held, last in _shards(items, item, question, answer)[1]:
        docs = docs.filter(~holds(held))
        docs = docs if last else materialise(docs, "not-leaking")
    return docs
