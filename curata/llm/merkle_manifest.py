"""Merkle manifest of a dataset with nested-interval labels (operator 12).

Every row is a leaf.  The leaves of one group (``source``), in ascending key order, have ranks 0, 1, ..., and a
node of level ``l`` carries the interval of leaf ranks that it covers, ``[i * 3**l, (i + 1) * 3**l)`` cut at the
number of leaves.  The groups' roots, in group order, are the leaves of one tree above them.

* Ranks come from a range partitioning: position in the part, plus one total for each (group, part).
* Levels are handled in buckets of ``BAND``.  A bucket's block holds the nodes of ``BAND`` levels under one node, at
  most ``3**BAND`` leaves, so a hot group is many small blocks; the next bucket's leaves are the blocks' top nodes.
* A node's ancestors in a bucket are attached by a containment join: a node's interval lies in the block's interval
  exactly if they have the same group and the same lower end at the block's level, which is an equi-join.  It runs
  from the top bucket downwards, so a join key has at most ``3**BAND`` partners.
* At every level the parent's interval less the node's own leaves two intervals, left and right: the siblings.

Built-in functions only.  Each bucket is written to the shared folder, so lost executors cost one bucket.

Defined results: a NULL value is recorded as ``-``; NULL keys come first, NULL groups form a group of their own
that comes first; rows of equal group and key are ordered by leaf digest and every repeated row is a leaf; an empty
table gives no rows; a lone leaf is its group's root; a lone group's root is the root.  Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curata.llm.common import materialise

FANOUT = 3
BAND = 5
WIDTH = FANOUT ** BAND
_POWERS = "array(" + ", ".join(f"{FANOUT ** j}L" for j in range(BAND + 1)) + ")"


def record(columns: list[str | Column]) -> Column:
    """The values as one unambiguous text: ``-`` for NULL, else UTF-8 length, ``:`` and the value."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def leaf_digest(columns: list[str | Column]) -> Column:
    return F.sha2(record(columns).cast("binary"), 256)


def _same_tree(a: str, b: str) -> Column:
    return F.col(f"{a}.tree").eqNullSafe(F.col(f"{b}.tree"))


def ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add ``rank`` within ``tree`` (from 0, in ``order``) and ``n``, the rows of the tree."""
    placed = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn("place", F.monotonically_increasing_id())
    placed = materialise(placed, name).withColumn("part", F.shiftrightunsigned("place", 33))
    runs = placed.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count("*").alias("size"))
    tree = Window.partitionBy("tree")
    earlier = F.coalesce(F.sum("size").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("tree", "part", (earlier - F.col("first")).alias("shift"), F.sum("size").over(tree).alias("n"))
    on = _same_tree("p", "r") & (F.col("p.part") == F.col("r.part"))
    return placed.alias("p").join(runs.alias("r"), on).select(
        "p.*", (F.col("p.place") + F.col("r.shift")).alias("rank"), F.col("r.n").alias("n")).drop("place", "part")


def _blocks(nodes: DataFrame) -> DataFrame:
    """(tree, block, n, levels): ``levels[j]`` has the block's nodes of level j, up to its top or the tree's root."""
    found = nodes.groupBy("tree", F.expr(f"rank div {WIDTH}").alias("block")).agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("base"))
    found = found.select("tree", "block", "n", F.col("base.digest").alias("l0"))
    for j in range(1, BAND + 1):
        runs = (f"transform(sequence(0, (size(l{j - 1}) - 1) div {FANOUT}), "
                f"i -> sha2(array_join(slice(l{j - 1}, i * {FANOUT} + 1, {FANOUT}), ''), 256))")
        found = found.withColumn(f"l{j}", F.expr(f"IF(n > {FANOUT ** (j - 1)}, {runs}, NULL)"))
    levels = F.filter(F.array(*[f"l{j}" for j in range(BAND + 1)]), lambda x: x.isNotNull())
    return found.select("tree", "block", "n", levels.alias("levels"))


def _steps(levels: str, position: str) -> Column:
    """The siblings to the left and to the right on every level between a block's leaf and its top."""
    own = f"({position} div element_at({_POWERS}, j + 1))"
    first = f"({own} div {FANOUT}) * {FANOUT}"
    left = f"array_join(slice(l, cast({first} + 1 as int), cast({own} - {first} as int)), '')"
    right = f"array_join(slice(l, cast({own} + 2 as int), cast({first} + {FANOUT - 1} - {own} as int)), '')"
    return F.expr(f"transform(slice({levels}, 1, size({levels}) - 1), (l, j) -> named_struct('left', {left}, 'right', {right}))")


@dataclass
class Forest:
    """The buckets of a set of trees, lowest first, and what the blocks know of the nodes above them."""

    bands: list[DataFrame]

    @classmethod
    def build(cls, nodes: DataFrame, name: str) -> Forest:
        """``nodes``: (tree, rank, n, digest)."""
        bands = []
        while True:
            band = materialise(_blocks(nodes.select("tree", "rank", "n", "digest")), f"{name}-{len(bands)}")
            bands.append(band)
            if (band.agg(F.max("n")).first()[0] or 0) <= WIDTH:
                return cls(bands)
            nodes = band.filter(F.col("n") > WIDTH).select(
                "tree", F.col("block").alias("rank"), F.expr(f"(n + {WIDTH - 1}) div {WIDTH}").alias("n"), F.expr(f"levels[{BAND}][0]").alias("digest"))

    def roots(self) -> DataFrame:
        """(tree, digest) of every tree's root."""
        ends = [b.filter(F.col("n") <= WIDTH).select("tree", F.element_at(F.element_at("levels", -1), 1).alias("digest")) for b in self.bands]
        out = ends[0]
        for end in ends[1:]:
            out = out.unionByName(end)
        return out

    def lowest(self, ends: DataFrame) -> DataFrame:
        """The lowest bucket's blocks with ``path``, the steps above them, and the other columns of ``ends`` (tree, path, ...) of their tree."""
        carried = [F.col(f"e.{c}").alias(c) for c in ends.columns if c != "tree"]
        above = None
        for band in reversed(self.bands):
            done = band.filter(F.col("n") <= WIDTH).alias("b").join(ends.alias("e"), _same_tree("b", "e")).select("b.*", *carried)
            if above is not None:
                inside = _same_tree("b", "e") & (F.expr(f"b.block div {WIDTH}") == F.col("e.block"))
                under = band.filter(F.col("n") > WIDTH).alias("b").join(above.alias("e"), inside)
                path = F.concat(_steps("e.levels", f"(b.block % {WIDTH})"), F.col("e.path")).alias("path")
                done = done.unionByName(under.select("b.*", path, *[F.col(f"e.{c}").alias(c) for c in ends.columns if c not in ("tree", "path")]))
            above = done
        return above

    def attach(self, leaves: DataFrame, ends: DataFrame) -> DataFrame:
        """``leaves`` (tree, rank, ...) with ``path``, all steps from the leaf to the end, and the other columns of ``ends``."""
        blocks = self.lowest(ends)
        inside = _same_tree("p", "q") & (F.expr(f"p.rank div {WIDTH}") == F.col("q.block"))
        path = F.concat(_steps("q.levels", f"(p.rank % {WIDTH})"), F.col("q.path")).alias("path")
        return leaves.alias("p").join(blocks.alias("q"), inside).select(
            "p.*", path, *[F.col(f"q.{c}").alias(c) for c in ends.columns if c not in ("tree", "path")])

    def nodes(self) -> DataFrame:
        """(tree, level, lo, hi, digest): every node with the interval of leaf ranks that it covers, the end exclusive."""
        out = None
        for k, band in enumerate(self.bands):
            # a block's top is the next bucket's leaf, unless the tree ends in it
            kept = F.expr(f"IF(n > {WIDTH}, slice(levels, 1, size(levels) - 1), levels)")
            level = band.select("tree", "block", F.posexplode(kept).alias("j", "level_nodes"))
            each = level.select("tree", "block", "j", F.posexplode("level_nodes").alias("i", "digest"))
            lo = f"(block * {WIDTH} + i * element_at({_POWERS}, j + 1)) * {WIDTH ** k}L"
            rows = each.select("tree", (F.col("j") + k * BAND).alias("level"), F.expr(lo).alias("lo"),
                               F.expr(f"{lo} + element_at({_POWERS}, j + 1) * {WIDTH ** k}L").alias("hi"), "digest")
            out = rows if out is None else out.unionByName(rows)
        return out


@dataclass
class Manifest:
    """A dataset's trees: one for each group, and one over the groups' roots."""

    leaves: DataFrame
    groups: Forest
    tops: DataFrame
    top: Forest

    def nodes(self) -> DataFrame:
        """(tree, level, lo, hi, digest) of the groups' trees; ``hi`` ends with the group's last leaf."""
        counts = self.leaves.groupBy("tree").agg(F.max("n").alias("n"))
        found = self.groups.nodes().alias("a").join(counts.alias("b"), _same_tree("a", "b"))
        return found.select("a.tree", "a.level", "a.lo", F.least("a.hi", "b.n").alias("hi"), "a.digest")

    def proofs(self) -> DataFrame:
        """The leaves' rows with ``path`` (array of left and right siblings, upwards), ``subroot`` and ``root``."""
        root = self.top.roots().select("tree", F.col("digest").alias("root"), F.expr("CAST(array() AS array<struct<left:string,right:string>>)").alias("path"))
        ends = self.top.attach(self.tops, root).select(F.col("group").alias("tree"), F.col("digest").alias("subroot"), "path", "root")
        return self.groups.attach(self.leaves, ends)


def build_manifest(rows: DataFrame, group: str, key: str, columns: list[str], keep: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``rows``: leaves are the digests of ``columns``; ``keep`` adds columns to the leaves' rows."""
    kept = [c.alias(name) for name, c in (keep or {}).items()]
    leaves = materialise(rows.select(F.col(group).alias("tree"), F.col(key).alias("key"), leaf_digest(columns).alias("digest"), *kept), "merkle-leaves")
    leaves = ranked(leaves, ["key", "digest"], "merkle-ranks")
    groups = Forest.build(leaves, "merkle-groups")
    tops = ranked(groups.roots().select(F.lit(0).alias("tree"), F.col("tree").alias("group"), "digest"), ["group"], "merkle-tops")
    return Manifest(leaves, groups, tops, Forest.build(tops, "merkle-top"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf digest and its siblings give."""
    return F.aggregate(path, leaf, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """Digest of the siblings, level by level upwards, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)
