"""Near-duplicates by MinHash with tensored banding (operator 8).

A document's set is its distinct shingles of five words (ASCII letters in lower case, words split at
ASCII white space); two documents are linked if the sets' Jaccard similarity is at least 0.75.

1. Sets are fingerprinted; documents with equal sets (size and two 64-bit prints) form a class and one member stands for it.
2. Two collections of ``ROWS`` keys are made, each key from two minhashes.  The tables of the index
   are all pairs of one key of each collection: ``ROWS``^2 = 100 tables from 40 minhashes instead of
   400.  A pair of similarity s meets in some table with probability (1 - (1 - s^2)^ROWS)^2: 0.9995
   at s = 0.75, over 0.99993 at 0.8.  A key that no other document has in its collection cannot meet
   anybody, so only keys that do are paired.
3. Each table bucket has a leader.  Members whose sketches agree with the leader's are hung on it;
   buckets that then still hold several families are compared member by member in blocks.  So any
   two documents that meet in a table with agreeing sketches end in one family.
4. Within a family, sets are made again from whole texts and compared exactly, best sketch agreement
   first; pairs that are already connected need no comparison.  Members of a family over ``BLOCK`` are
   compared with its leader first, and only those apart from it with everybody.  The confirmed links' connected
   components are the result.

No group is gathered whole: buckets and families over ``BLOCK`` members are cut into blocks, and
each pair of blocks is a group of its own.  No pairs are dropped: agreement of sketches needs
``AGREE`` of 40 minhashes equal, which a pair of similarity 0.75 misses about once in 5 million.

Defined results: NULL or empty text and text without words has the empty set, is linked with nothing
and is its own component.  A row is placed by its own text: repeated rows get equal results, also
rows that share a doc_id but not the text.  A NULL doc_id is never linked; its component is NULL and
it is kept.  An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.llm.common import materialise
from curata.llm.components import connected_components

WORDS = 5
SIMILAR = (75, 100)          # intersection * 100 >= union * 75
ROWS = 10                    # keys of each collection
HASHES = 4 * ROWS
AGREE = 16
BLOCK = 512
WORDS_KEPT = 400_000

_M64 = (1 << 64) - 1


def _odd_numbers(seed: int, n: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(f"{seed}:{i}".encode()) | 1 for i in range(n)], dtype=np.uint64)


_PLACE = _odd_numbers(1, WORDS)
_MULTIPLY = _odd_numbers(2, HASHES)
_ADD = _odd_numbers(3, HASHES)
_PRINT = _odd_numbers(4, 2)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Shingles:
    """64-bit hashes of the distinct word shingles of texts."""

    def __init__(self) -> None:
        self.words: dict[bytes, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes; empty without words."""
        words = (text or "").encode("utf-8", "replace").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        known = self.words
        if len(known) > WORDS_KEPT:
            known.clear()
        try:
            h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = max(1, len(h) - WORDS + 1)
        total = np.full(n, min(len(h), WORDS), np.uint64)
        for k in range(min(WORDS, len(h))):
            total += h[k:k + n] * _PLACE[k]
        return np.unique(_mix(total))


def minhashes(shingles: np.ndarray) -> np.ndarray:
    """``HASHES`` minima of 32 bits."""
    out = np.empty(HASHES, np.uint32)
    for k in range(HASHES):
        out[k] = int((shingles * _MULTIPLY[k] + _ADD[k]).min()) >> 32
    return out


def _prints(shingles: np.ndarray) -> list[int]:
    """Two 64-bit fingerprints of a set."""
    return [int(_mix(shingles * p).sum(dtype=np.uint64)) - (1 << 63) for p in _PRINT]


def sketch(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc, text_hash, n_shingles, print_a, print_b, mins array<int>) per row; the prints tell sets apart."""
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    schema = "doc long, text_hash long, n_shingles long, print_a long, print_b long, mins array<int>"

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            sets = [shingles.of(t.as_py()) for t in batch.column("text")]
            prints = [_prints(s) for s in sets]
            mins = [minhashes(s).view(np.int32) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()), pa.array([p[0] for p in prints], pa.int64()),
                 pa.array([p[1] for p in prints], pa.int64()), pa.array(mins, pa.list_(pa.int32()))],
                ["doc", "text_hash", "n_shingles", "print_a", "print_b", "mins"])

    return rows.mapInArrow(make, schema)


def tables(reps: DataFrame) -> DataFrame:
    """(bucket, node) for every table in which ``reps`` (node, mins) may meet somebody."""
    pick = lambda side, i, k: F.get("mins", F.lit(2 * (side * ROWS + i) + k))
    keys = F.array(*[F.struct(F.lit(side).alias("side"), F.xxhash64(F.lit(side), F.lit(i), pick(side, i, 0), pick(side, i, 1)).alias("h")) for side in (0, 1) for i in range(ROWS)])
    rows = reps.select("node", F.explode(keys).alias("k")).select("node", "k.side", "k.h")
    shared = rows.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    met = rows.join(shared, "h", "left_semi").groupBy("node").agg(*[F.collect_list(F.when(F.col("side") == s, F.col("h"))).alias(f"s{s}") for s in (0, 1)])   # 2 * ROWS at most
    pairs = F.flatten(F.transform("s0", lambda x: F.transform("s1", lambda y: F.xxhash64(x, y))))
    return met.select("node", F.explode(pairs).alias("bucket"))


def _agree(a: str, b: str):
    """Sketch agreement and sizes that can be similar."""
    same = F.size(F.filter(F.zip_with(F.col(f"{a}.mins"), F.col(f"{b}.mins"), lambda x, y: x == y), lambda z: z))
    small, large = F.least(F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")), F.greatest(F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles"))
    return (small * SIMILAR[1] >= large * SIMILAR[0]) & (same >= AGREE)


class Forest:
    """Union-find over few local numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _in_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of a partition that is sorted by ``keys``, group by group; a group has two blocks at most."""
    rest: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rest = rows if rest is None else pa.concat_tables([rest, rows])
        if rest.num_rows == 0:
            continue
        columns = [rest.column(k).to_numpy() for k in keys]
        changes = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
        starts = [0, *changes.tolist()]
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            yield rest.slice(a, b - a)
        rest = rest.slice(starts[-1])
    if rest is not None and rest.num_rows:
        yield rest


def _candidates(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (i, j, agreement) of a group that may be similar, best agreement first.

    A group of two different blocks holds only pairs across them.
    """
    mins = np.stack(rows.column("mins").to_numpy())
    size, block = rows.column("n_shingles").to_numpy(), rows.column("block").to_numpy()
    n, across = len(size), rows.column("a")[0].as_py() != rows.column("b")[0].as_py()
    found = []
    for i in range(n - 1):
        same = (mins[i + 1:] == mins[i]).sum(axis=1)
        ok = (same >= AGREE) & (np.minimum(size[i + 1:], size[i]) * SIMILAR[1] >= np.maximum(size[i + 1:], size[i]) * SIMILAR[0])
        if across:
            ok &= block[i + 1:] != block[i]
        j = np.flatnonzero(ok)
        if len(j):
            found.append(np.stack([np.full(len(j), i), j + i + 1, same[j]]))
    if not found:
        return (np.empty(0, int),) * 3
    pairs = np.concatenate(found, axis=1)
    return tuple(pairs[:, np.argsort(-pairs[2], kind="stable")])


def _in_blocks(members: DataFrame, group: str) -> DataFrame:
    """Cut groups into blocks: a row appears once in each pair of its block with a block of its group."""
    sizes = members.groupBy(group).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = members.join(sizes, group).withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("a", F.least("block", "other")).withColumn("b", F.greatest("block", "other")).drop("other", "blocks")
    return rows.repartition(group, "a", "b").sortWithinPartitions(group, "a", "b")


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])


def _families(reps: DataFrame) -> DataFrame:
    """(node, family) of all nodes whose sketches agree with another's in some bucket."""
    buckets = tables(reps)
    leaders = buckets.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("n")).filter("n > 1").drop("n")
    placed = materialise(buckets.join(leaders, "bucket"), "buckets")
    sketches = F.struct("n_shingles", "mins")
    pairs = placed.filter("node <> leader").select("node", "leader").distinct()
    hung = (pairs.join(reps.select("node", sketches.alias("x")), "node").join(reps.select(F.col("node").alias("leader"), sketches.alias("y")), "leader")
            .select("node", "leader", _agree("x", "y").alias("agree")))
    hung = materialise(hung, "stars")
    first = connected_components(hung.filter("agree").select(F.col("node").alias("a"), F.col("leader").alias("b")), "families")

    # a bucket is mixed if a member is not of its leader's family; mixed buckets with equal members count once
    own = first.select("node", F.col("component").alias("family"))
    apart = (hung.filter("NOT agree").join(own, "node", "left").join(own.select(F.col("node").alias("leader"), F.col("family").alias("of_leader")), "leader", "left")
             .filter("coalesce(family, node) <> coalesce(of_leader, leader)").select("node", "leader"))
    mixed = placed.join(apart, ["node", "leader"], "left_semi").select("bucket").distinct()
    members = materialise(placed.select("bucket", "node").join(mixed, "bucket", "left_semi"), "mixed")
    alike = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("d"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("h"))
    once = alike.groupBy("n", "d", "h").agg(F.min("bucket").alias("bucket")).select("bucket")
    rows = members.join(once, "bucket", "left_semi").join(own, "node", "left").withColumn("family", F.coalesce("family", "node")).join(reps.drop("doc"), "node")

    def agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for group in _in_groups(batches, ["bucket", "a", "b"]):
            nodes = group.column("node").to_numpy()
            _, number = np.unique(group.column("family").to_numpy(), return_inverse=True)
            forest = Forest(len(nodes))
            out += [(nodes[i], nodes[j]) for i, j, _ in zip(*_candidates(group), strict=True) if forest.join(number[i], number[j])]
            if len(out) > 10_000:
                yield _edges(out)
                out = []
        yield _edges(out)

    more = _in_blocks(rows, "bucket").mapInArrow(agreeing, "a long, b long")
    contracted = own.filter("node <> family").select(F.col("node").alias("a"), F.col("family").alias("b"))
    return connected_components(contracted.unionByName(more), "families").withColumnRenamed("component", "family")


class _Members:
    """Exact sets of a group's rows, made from whole texts when they are first asked for."""

    def __init__(self, group: pa.Table, shingles: Shingles) -> None:
        self.nodes = group.column("node").to_numpy()
        self.texts, self.shingles, self.sets = group.column("text"), shingles, {}
        self.prints = list(zip(group.column("print_a").to_pylist(), group.column("print_b").to_pylist(), strict=True))

    def set_of(self, i: int) -> frozenset | None:
        """None for another text of a node's doc_id."""
        if i not in self.sets:
            own = self.shingles.of(self.texts[int(i)].as_py())
            self.sets[i] = frozenset(own.tolist()) if len(own) and tuple(_prints(own)) == self.prints[i] else None
        return self.sets[i]

    def similar(self, i: int, j: int) -> bool:
        x, y = self.set_of(i), self.set_of(j)
        if x is None or y is None or min(len(x), len(y)) * SIMILAR[1] < max(len(x), len(y)) * SIMILAR[0]:
            return False
        both = len(x & y)
        return both * SIMILAR[1] >= (len(x) + len(y) - both) * SIMILAR[0]

    def links(self, group: pa.Table, forest: Forest) -> Iterator[tuple[int, int]]:
        """Links that connect what the forest has apart."""
        for i, j, _ in zip(*_candidates(group), strict=True):
            if forest.root(i) != forest.root(j) and self.similar(i, j):
                forest.join(i, j)
                yield self.nodes[i], self.nodes[j]


def _by_leader(members: DataFrame) -> DataFrame:
    """(a, b, apart): links within families of one block; members of larger ones against their leader, ``apart`` if not linked with it.

    ``members`` has ``blocks`` per family.  A leader goes to every block of its family, everybody else to one.
    """
    own = F.pmod(F.xxhash64(F.lit("block"), "node"), F.col("blocks")).cast("int")
    rows = members.withColumn("block", F.explode(F.when(F.col("node") == F.col("family"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))))
    rows = rows.withColumn("a", F.col("block")).withColumn("b", F.col("block")).repartition("family", "block").sortWithinPartitions("family", "block")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for group in _in_groups(batches, ["family", "block"]):
            inside, family = _Members(group, shingles), group.column("family")[0].as_py()
            if group.column("blocks")[0].as_py() == 1:
                out = [(a, b, False) for a, b in inside.links(group, Forest(len(inside.nodes)))]
            else:
                leader = next(i for i, n in enumerate(inside.nodes) if n == family and inside.set_of(i) is not None)
                out = [(n, family, not inside.similar(i, leader)) for i, n in enumerate(inside.nodes) if n != family and inside.set_of(i) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.bool_()))], ["a", "b", "apart"])

    return rows.mapInArrow(confirm, "a long, b long, apart boolean")


def _links(families: DataFrame, reps: DataFrame, docs: DataFrame, text: str, key: str) -> DataFrame:
    """Links (a, b) that connect the nodes of families as all exact links between them would.

    Members of a large family are compared with its leader first, which is linear; only those that it is not
    linked with are compared with everybody, in blocks.
    """
    texts = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    held = materialise(families.join(reps, "node").join(texts, "doc").drop("doc"), "members", compression="zstd")      # texts of all documents are shuffled once
    in_blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    sizes = families.groupBy("family").agg(in_blocks(F.count("*")).alias("blocks"))
    first = materialise(_by_leader(held.join(sizes, "family")), "by-leader")
    linked = first.filter("NOT apart").select("a", "b")
    apart = first.filter("apart").select(F.col("a").alias("node"), F.col("b").alias("family")).distinct()
    if apart.isEmpty():
        return linked
    members = families.join(apart.select("family").distinct(), "family", "left_semi").join(apart.select("node", F.lit(False).alias("with_leader")), "node", "left")
    members = members.withColumn("with_leader", F.coalesce("with_leader", F.lit(True)))
    counts = members.groupBy("family").agg(in_blocks(F.count_if(~F.col("with_leader"))).alias("r"), in_blocks(F.count_if(F.col("with_leader"))).alias("l"))
    place = lambda n: F.pmod(F.xxhash64(F.lit("block"), "node"), F.col(n)).cast("int")
    members = materialise(members.join(counts, "family").drop("family"), "apart")
    rows = held.join(members, "node").withColumn("block", F.when(F.col("with_leader"), F.col("r") + place("l")).otherwise(place("r")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("with_leader"), F.col("r")).otherwise(F.col("r") + F.col("l")) - 1)))
    rows = rows.withColumn("a", F.least("block", "other")).withColumn("b", F.greatest("block", "other")).drop("other", "r", "l")
    rows = rows.repartition("family", "a", "b").sortWithinPartitions("family", "a", "b")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for group in _in_groups(batches, ["family", "a", "b"]):
            inside, together = _Members(group, shingles), np.flatnonzero(group.column("with_leader").to_numpy())
            forest = Forest(len(inside.nodes))
            for i in together[1:].tolist():
                forest.join(int(together[0]), i)
            yield _edges(list(inside.links(group, forest)))

    return linked.unionByName(rows.mapInArrow(confirm, "a long, b long"))


def _placed(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(doc, text_hash, n_shingles, component) per row of ``docs``."""
    rows = materialise(sketch(docs, text, key).withColumn("row", F.monotonically_increasing_id()), "sketches")
    same = ["print_a", "print_b", "n_shingles"]
    classes = rows.filter("n_shingles > 0 AND doc IS NOT NULL").groupBy(*same).agg(F.min("row").alias("node"), F.min("doc").alias("doc"), F.first("mins").alias("mins"))
    reps = materialise(classes, "classes")
    families = _families(reps.drop("print_a", "print_b"))
    found = connected_components(_links(families, reps, docs, text, key), "links")
    placed = reps.select("node", "doc", *same).join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = placed.groupBy("component").agg(F.min("doc").alias("smallest"))
    by_set = placed.join(smallest, "component").select(*same, "smallest")
    known = rows.select("doc", "text_hash", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("print_a")).alias("print_a"), "print_b")
    component = F.when(F.col("doc").isNotNull(), F.coalesce("smallest", "doc"))
    return known.join(by_set, same, "left").select("doc", "text_hash", "n_shingles", component.alias("component"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``, the first under the key's name."""
    return _placed(docs, text, key).select(F.col("doc").alias(key), "n_shingles", F.col("component").alias("component_id"),
                                           F.coalesce(F.col("doc") == F.col("component"), F.lit(True)).alias("kept"))


def keep_one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, with their own columns, that stand for their group; of equal rows one."""
    kept = _placed(docs, text, key).filter("doc = component").select(F.col("doc").alias("kept_doc"), F.col("text_hash").alias("kept_hash")).distinct()
    rows = docs.select(F.struct("*").alias("row_"), F.col(key).cast("long").alias("doc_"), F.xxhash64(F.col(text).cast("string")).alias("hash_"))
    once = rows.filter("doc_ IS NOT NULL").dropDuplicates(["doc_", "hash_"])
    stay = once.join(kept, (F.col("doc_") == F.col("kept_doc")) & (F.col("hash_") == F.col("kept_hash")), "left_semi")
    return stay.unionByName(rows.filter("doc_ IS NULL")).select("row_.*")
