"""Largest inner products by stable projections and kd-trees (operator 6).

Inner products become distances: with M the largest norm, a vector x is lifted to (x, sqrt(M^2 - |x|^2))
and a query q to (q M / |q|, 0); the smaller the distance, the larger <x, q>.  Lifted vectors are
projected to ``DIMENSIONS`` coordinates by a Gaussian (2-stable) matrix; for a pair at distance d the
squared projected distance is d^2 times a chi-square variable.  Neighbours are visited in the order of
projected distance and verified with exact inner products, until the next projected distance r holds
chi-square CDF(r^2 / d_k^2) >= ``CONFIDENCE`` for the k-th best distance d_k so far: a nearer vector
would still be unseen with probability 1 - CONFIDENCE at most.

Distribution: a kd-tree over a bounded sample of projected vectors cuts space into cells; every vector
is put into its cell.  A query first searches its home cell, then, with the bound found there, all
cells that the stopping test does not rule out.  Cells are cut into chunks of about ``CHUNK`` vectors
with a kd-tree of their own, and their queries into blocks, so no group outgrows a task.

Equal vectors are one entry that carries its k + 1 smallest ids, which is all a top k can need.

Defined results: NULL ids, and vectors that are NULL, empty, zero or hold NULL, NaN or infinity take no
part, nor do vectors whose length is not the most frequent one.  Ties go to the smaller id.  Repeated
rows (same id and vector) count once.  With fewer candidates than k all are returned; without any
query or candidate the result is empty.  Scores are sums of products in double precision.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curata.llm.common import materialise

DIMENSIONS = 10
CONFIDENCE = 0.97
SAMPLE = 20_000
CELL = 4_096            # vectors that a cell is meant to have
CHUNK = 4_096
QUERIES = 1_024
LEAF = 256
SEED = 20_240_601


def chi_square_quantile(p: float, degrees: int) -> float:
    """The value that a chi-square variable of even ``degrees`` stays below with probability ``p``."""
    low, high = 0.0, 10.0 * degrees + 100.0
    for _ in range(100):
        x = (low + high) / 2
        term, total = 1.0, 1.0
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        low, high = (x, high) if 1 - math.exp(-x / 2) * total < p else (low, x)
    return (low + high) / 2


_STOP = chi_square_quantile(CONFIDENCE, DIMENSIONS)


def _matrix(dimension: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dimension + 1, DIMENSIONS))


def _project(vectors: np.ndarray, largest: float) -> np.ndarray:
    lift = np.sqrt(np.maximum(0.0, largest ** 2 - (vectors ** 2).sum(axis=1)))
    return np.column_stack([vectors, lift]) @ _matrix(vectors.shape[1])


def _project_queries(vectors: np.ndarray, largest: float) -> np.ndarray:
    scaled = vectors * (largest / np.sqrt((vectors ** 2).sum(axis=1)))[:, None]
    return scaled @ _matrix(vectors.shape[1])[:-1]


def _rows(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    if len(column) == 0:
        return np.empty((0, 0))
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


class KdTree:
    """Halves cut at the median of the widest coordinate, down to leaves of at most ``leaf`` points.

    ``order`` lists the points leaf by leaf; leaf j is ``order[start[j]:start[j + 1]]`` in the box (low[j], high[j]).
    """

    def __init__(self, points: np.ndarray, leaf: int):
        parts: list[np.ndarray] = []
        stack = [np.arange(len(points))]
        while stack:
            members = stack.pop()
            own = points[members]
            spread = own.max(axis=0) - own.min(axis=0)
            axis = int(np.argmax(spread))
            if len(members) > leaf and spread[axis] > 0:
                halves = members[np.argsort(own[:, axis], kind="stable")]
                stack += [halves[len(halves) // 2:], halves[:len(halves) // 2]]
            else:
                parts.append(members)
        self.order = np.concatenate(parts)
        self.start = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
        self.low = np.array([points[x].min(axis=0) for x in parts])
        self.high = np.array([points[x].max(axis=0) for x in parts])


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes."""
    out = np.empty((len(points), len(low)))
    for j in range(len(low)):
        out[:, j] = (np.maximum(0.0, np.maximum(low[j] - points, points - high[j])) ** 2).sum(axis=1)
    return out


class Best:
    """The k best (score, id) so far; ties go to the smaller id."""

    def __init__(self, k: int, floor: float = -math.inf):
        self.k, self.heap, self.floor = k, [], floor

    def add(self, score: float, ids) -> None:
        for i in ids:
            entry = (score, -i)
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, entry)
            elif entry > self.heap[0]:
                heapq.heapreplace(self.heap, entry)
            else:
                break

    def least(self) -> float:
        """The k-th best score; what another cell has found counts as well."""
        return max(self.floor, self.heap[0][0]) if len(self.heap) == self.k else self.floor


class Chunk:
    """A chunk's vectors and projections, leaf by leaf of its kd-tree."""

    def __init__(self, vectors: np.ndarray, points: np.ndarray, ids: list):
        self.tree = KdTree(points, LEAF)
        self.vectors, self.points = vectors[self.tree.order], points[self.tree.order]
        self.squares = (self.points ** 2).sum(axis=1)
        self.ids = [ids[i] for i in self.tree.order]

    def search(self, query: np.ndarray, point: np.ndarray, near: np.ndarray, largest: float, k: int, floor: float) -> list[tuple[float, int]]:
        """Visit leaves by projected distance (``near``) until the stopping test holds; (score, id) of the best k that reach ``floor``."""
        best = Best(k, floor)
        norm, own = math.sqrt(float((query ** 2).sum())), float((point ** 2).sum())

        def limit() -> float:
            least = best.least()
            return math.inf if least == -math.inf else _STOP * max(0.0, 2 * largest ** 2 - 2 * largest * least / norm)

        reach = limit()
        for leaf in np.argsort(near, kind="stable"):
            if near[leaf] > reach:
                break
            start, end = self.tree.start[leaf], self.tree.start[leaf + 1]
            gaps = self.squares[start:end] - 2 * (self.points[start:end] @ point)
            scores = self.vectors[start:end] @ query
            least = best.heap[0][0] if len(best.heap) == k else -math.inf
            good = np.flatnonzero((gaps <= reach - own) & (scores >= least))
            if len(good):
                for j in good[np.argsort(-scores[good], kind="stable")]:
                    if len(best.heap) == k and scores[j] < best.heap[0][0]:
                        break
                    best.add(float(scores[j]), self.ids[start + j])
                reach = limit()
        return [(s, -i) for s, i in best.heap if s >= floor]


def _valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _entries(rows: DataFrame, k: int) -> DataFrame:
    """(h, g, vector, ids): equal vectors once, with their k + 1 smallest ids.  Only that many rows of a vector are shuffled by a task."""
    once = rows.dropDuplicates(["h", "g", "id"])
    few = once.withColumn("place", F.row_number().over(Window.partitionBy("h", "g").orderBy("id"))).filter(F.col("place") <= k + 1)
    return few.groupBy("h", "g").agg(F.first("vector").alias("vector"), F.sort_array(F.collect_list("id")).alias("ids"))


class Cells:
    """The cells of space with their boxes."""

    def __init__(self, sample: np.ndarray, cells: int):
        tree = KdTree(sample, max(1, math.ceil(len(sample) / max(1, cells)))) if len(sample) else None
        self.low, self.high = (tree.low, tree.high) if tree else (np.zeros((1, DIMENSIONS)), np.zeros((1, DIMENSIONS)))

    def gaps(self, points: np.ndarray) -> np.ndarray:
        return box_distances(points, self.low, self.high)


def _blocks(counts: DataFrame, size: int, name: str) -> DataFrame:
    return counts.groupBy("cell").agg(F.ceil(F.count("*") / size).cast("int").alias(name))


def _searched(placed: DataFrame, asked: DataFrame, largest: float, k: int) -> DataFrame:
    """(h, g, id, score): best of each chunk for the queries (cell, h, g, vector, point, floor) sent to its cell."""
    chunks, blocks = _blocks(placed, CHUNK, "chunks"), _blocks(asked, QUERIES, "blocks")
    shape = chunks.join(blocks, "cell")
    left = placed.join(shape, "cell").withColumn("chunk", F.pmod(F.col("h"), F.col("chunks")).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = asked.join(shape, "cell").withColumn("block", F.pmod(F.col("h"), F.col("blocks")).cast("int")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    group = ("cell", "chunk", "block")

    def find(entries: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if entries.num_rows and queries.num_rows:
            chunk = Chunk(_rows(entries.column("vector")), _rows(entries.column("point")), entries.column("ids").to_pylist())
            points = _rows(queries.column("point"))
            near = box_distances(points, chunk.tree.low, chunk.tree.high)
            for n, (h, g, q, floor) in enumerate(zip(queries.column("h").to_pylist(), queries.column("g").to_pylist(), _rows(queries.column("vector")),
                                                     queries.column("floor").to_pylist(), strict=True)):
                out += [(h, g, i, s) for s, i in chunk.search(q, points[n], near[n], largest, k, floor)]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.Table.from_arrays([pa.array([r[j] for r in out], t) for j, t in enumerate(kinds)], ["h", "g", "id", "score"])

    keep = [*group, "h", "g", "vector", "point"]
    return (left.select(*keep, "ids").groupBy(*group).cogroup(right.select(*keep, "floor").groupBy(*group)).applyInArrow(find, "h long, g long, id long, score double"))


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("h", "g").orderBy(F.desc("score"), "id"))
    return found.withColumn("place", rank).filter(F.col("place") <= k).drop("place")


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``vectors`` for which ``is_query`` holds."""
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.filter(F.col("id").isNotNull() & _valid(F.col("vector")))
    rows = rows.withColumn("h", F.xxhash64("vector")).withColumn("g", F.xxhash64(F.lit("second"), "vector")).withColumn("size", F.size("vector"))
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shapes = rows.groupBy("size").agg(F.count("*").alias("n"), F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)).alias("most")).orderBy(F.desc("n"), "size").limit(1).collect()
    if not shapes:
        return empty
    size, largest = shapes[0]["size"], math.sqrt(shapes[0]["most"]) * (1 + 1e-12)
    rows = rows.filter(F.col("size") == size)
    entries = materialise(_entries(rows.select("id", "h", "g", "vector"), k), "vectors")
    n = entries.count()

    draw = min(1.0, SAMPLE / n)
    sample = entries.filter(F.pmod(F.xxhash64(F.lit("sample"), "h"), F.lit(1_000_003)) < math.ceil(draw * 1_000_003)).select("vector").collect()      # about SAMPLE vectors
    cells = Cells(_project(np.array([r["vector"] for r in sample]).reshape(-1, size), largest), min(max(1, n // CELL), max(1, len(sample) // 8)))
    held = vectors.sparkSession.sparkContext.broadcast(cells)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = _project(_rows(batch.column("vector")), largest)
                cell = held.value.gaps(points).argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(list(points), pa.list_(pa.float64()))], [*batch.schema.names, "cell", "point"])

    columns = "h long, g long, vector array<double>, ids array<long>, cell int, point array<double>"
    placed = materialise(entries.select("h", "g", "vector", "ids").mapInArrow(place, columns), "placed")
    # boxes of what is really in the cells: a row for each cell
    boxes = placed.groupBy("cell").agg(*[f(F.get("point", F.lit(i))).alias(f"{name}{i}") for i in range(DIMENSIONS) for name, f in (("low", F.min), ("high", F.max))]).collect()
    cells.low, cells.high = (np.full((len(cells.low), DIMENSIONS), x) for x in (math.inf, -math.inf))
    for b in boxes:
        cells.low[b["cell"]] = [b[f"low{i}"] for i in range(DIMENSIONS)]
        cells.high[b["cell"]] = [b[f"high{i}"] for i in range(DIMENSIONS)]
    real = vectors.sparkSession.sparkContext.broadcast(cells)

    asking = rows.filter("asks").select("id", "h", "g")
    queries = entries.select("h", "g", "vector").join(asking.select("h", "g").distinct(), ["h", "g"], "left_semi")

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = _project_queries(_rows(batch.column("vector")), largest)
                home = real.value.gaps(points).argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home.astype(np.int32)), pa.array(list(points), pa.list_(pa.float64())), pa.array(np.full(len(home), -math.inf))],
                                                 [*batch.schema.names, "cell", "point", "floor"])

    query_columns = "h long, g long, vector array<double>, cell int, point array<double>, floor double"
    first_asked = materialise(queries.mapInArrow(at_home, query_columns), "queries")
    first = materialise(_best(_searched(placed, first_asked, largest, k + 1), k + 1), "home")
    floors = first.groupBy("h", "g").agg(F.when(F.count("*") > k, F.min("score")).otherwise(-math.inf).alias("floor"))

    def elsewhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors_, points = _rows(batch.column("vector")), _rows(batch.column("point"))
                floor = np.asarray(batch.column("floor"))
                norms = np.sqrt((vectors_ ** 2).sum(axis=1))
                with np.errstate(invalid="ignore"):
                    limits = np.where(np.isinf(floor), math.inf, _STOP * np.maximum(0.0, 2 * largest ** 2 - 2 * largest * floor / norms))
                gaps = real.value.gaps(points)
                visit = (gaps <= limits[:, None]) & np.isfinite(gaps)
                visit[np.arange(len(gaps)), np.asarray(batch.column("cell"))] = False
                at, cell = np.nonzero(visit)
                rows_ = pa.Table.from_batches([batch]).take(pa.array(at)).set_column(3, "cell", pa.array(cell.astype(np.int32)))
                yield from rows_.to_batches()

    rest = first_asked.drop("floor").join(floors, ["h", "g"], "left").select("h", "g", "vector", "cell", "point", F.coalesce("floor", F.lit(-math.inf)).alias("floor"))
    second = _searched(placed, rest.mapInArrow(elsewhere, query_columns), largest, k + 1)
    ranked = _best(first.unionByName(second), k + 1).groupBy("h", "g").agg(F.collect_list(F.struct((-F.col("score")).alias("order"), "id")).alias("found"))      # k + 1 at most
    others = F.filter("found", lambda x: x["id"] != F.col("query_id"))
    answers = asking.distinct().withColumnRenamed("id", "query_id").join(ranked, ["h", "g"]).select("query_id", F.posexplode(F.slice(F.array_sort(others), 1, k)).alias("place", "x"))
    return answers.select("query_id", (F.col("place") + 1).alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.order")).alias("score"))
