"""One counted table of column values for histograms, quantiles and medians (P4, C8, X2), and ranks of values.

``value_counts`` has one row for each distinct value of each column, so whatever needs a column's
distribution but not its rows follows from it without reading the source again.  It suits columns
whose values repeat; a column of distinct measurements has as many rows here as in the source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curata.functions.blocks import ROWS_PER_BLOCK, block_count, with_blocks
from curata.sources.sinks import written_table

#: Values with at least this share of the rows are joined by broadcast (at most 1 / share), the others by key.
HOT_SHARE = 0.001


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, v, n): how often column number ``i`` has value ``v`` (double; NULL and NaN are values too)."""
    name = lambda c: "`" + c.replace("`", "``") + "`"
    pairs = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(name(c)).cast("double").alias("v")) for i, c in enumerate(columns)])))
    return pairs.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))


def finite(x: Column) -> Column:
    return F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))


def counted_histogram(counted: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """(column_name, bin, bin_lo, bin_hi, n) of every column of a counted table, with the rules of ``profiling.histogram``."""
    spark = counted.sparkSession
    schema = "column_name string, bin int, bin_lo double, bin_hi double, n bigint"
    seen = finite(F.col("v"))
    ranges = {r["i"]: (r["lo"], r["hi"]) for r in counted.groupBy("i").agg(F.min(F.when(seen, F.col("v"))).alias("lo"), F.max(F.when(seen, F.col("v"))).alias("hi")).collect()}
    if not columns:
        return spark.createDataFrame([], schema)
    edges = []
    for i in range(len(columns)):
        lo, hi = ranges.get(i, (None, None))
        edges.append((None, None, None) if lo is None else (lo, hi, (hi - lo) / bins) if hi > lo else (lo - 0.5, lo + 0.5, 1.0 / bins))
    of = lambda k: F.get(F.array(*[F.lit(e[k]).cast("double") for e in edges]), F.col("i"))
    sized = counted.where(F.col("v").isNotNull()).select("i", "v", "n", of(0).alias("lo"), of(1).alias("hi"), of(2).alias("width"))
    last = F.lit(bins - 1)
    guess = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.lit(float(bins))).cast("int"), last)
    placed = sized.withColumn("guess", F.when(seen, guess))
    low = F.col("guess") * F.col("width") + F.col("lo")
    high = F.when(F.col("guess") == last, F.col("hi")).otherwise((F.col("guess") + 1) * F.col("width") + F.col("lo"))
    inside = F.when(F.col("v") < low, F.col("guess") - 1).when((F.col("v") >= high) & (F.col("guess") != last), F.col("guess") + 1).otherwise(F.col("guess"))
    binned = placed.withColumn("bin", F.coalesce(inside, F.lit(-1)).cast("int")).groupBy("i", "bin").agg(
        F.sum("n").alias("n"), F.max("lo").alias("lo"), F.max("hi").alias("hi"), F.max("width").alias("width"))
    edge = lambda b: F.when(F.col("bin") >= 0, F.when(b == bins, F.col("hi")).otherwise(b * F.col("width") + F.col("lo")))
    names = F.array(*[F.lit(c) for c in columns])
    return binned.select(F.get(names, F.col("i")).alias("column_name"), "bin", edge(F.col("bin")).alias("bin_lo"), edge(F.col("bin") + 1).alias("bin_hi"), "n").orderBy("column_name", "bin")


def counted_quantiles(counted: DataFrame, columns: Sequence[str], q: float) -> dict[str, float | None]:
    """Exact ``percentile_disc`` of each column of a counted table: the smallest value whose cumulative share reaches ``q``.

    NULL and NaN are ignored.  Columns with few distinct values are done together, one task each; the
    values of a column with many are cut into contiguous blocks, only block totals reach the driver, and the running
    sum runs in the one block that holds the target rank.
    """
    values = counted.where(F.col("v").isNotNull() & ~F.isnan("v"))
    sizes = {r["i"]: (r["rows"], r["d"]) for r in values.groupBy("i").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("d")).collect()}
    small = [i for i, (_, d) in sizes.items() if d <= ROWS_PER_BLOCK]
    found = {}
    if small:
        run = Window.partitionBy("i").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
        summed = values.where(F.col("i").isin(small)).select("i", "v", F.sum("n").over(run).alias("upto"), F.sum("n").over(Window.partitionBy("i")).alias("rows"))
        found = {r["i"]: r["v"] for r in summed.where(F.col("upto") >= F.lit(q) * F.col("rows")).groupBy("i").agg(F.min("v").alias("v")).collect()}
    for i in sizes.keys() - found.keys():
        found[i] = _blocked_quantile(values.where(F.col("i") == i), *sizes[i], q)
    return {c: found.get(i) for i, c in enumerate(columns)}


def _blocked_quantile(grouped: DataFrame, rows: int, distinct: int, q: float) -> float:
    target, offset = q * rows, 0
    blocked = with_blocks(grouped, "v", block_count(distinct, minimum=2))
    totals = sorted((r["block"], r["t"]) for r in blocked.groupBy("block").agg(F.sum("n").alias("t")).collect())
    chosen = totals[-1][0]
    for block, total in totals:
        if offset + total >= target:
            chosen = block
            break
        offset += total
    running = F.sum("n").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    inside = blocked.where(F.col("block") == chosen).withColumn("upto", F.lit(offset) + running)
    return inside.where(F.col("upto") >= F.lit(target)).agg(F.min("v")).first()[0]


def value_ranks(df: DataFrame, column: str) -> DataFrame:
    """(value, n, rank) of a column's non-NULL values: rank 0 is the most frequent, ties in value order.

    The order is made by a range partitioning; a rank is the place in the part plus the rows of the
    parts before it.  Neither the values nor their order pass through the driver or one task.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc("value")]
    placed = written_table(counts.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "value-ranks")
    placed = placed.withColumn("part", F.shiftrightunsigned("place", 33))
    parts = placed.groupBy("part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
    before = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.join(parts.select("part", (before - F.col("first")).alias("shift")), "part").select("value", "n", (F.col("place") + F.col("shift")).alias("rank"))


def index_by_ranks(df: DataFrame, column: str, ranks: DataFrame, output: str) -> DataFrame:
    """Add ``output``, the rank of the row's value as a double; NULL and unseen values get the number of ranks.

    Equal to ``StringIndexerModel`` with ``handleInvalid='keep'``, but the dictionary is joined, not
    held by the driver.  Frequent values are few and broadcast; rows with the others, none of which
    is frequent, are joined by key.
    """
    whole = ranks.agg(F.count(F.lit(1)).alias("labels"), F.sum("n").alias("rows")).first()
    least, labels = HOT_SHARE * (whole["rows"] or 0), float(whole["labels"])
    named = ranks.select(F.col("value").alias("value_"), F.col("rank").cast("double").alias("rank_"), F.col("n").alias("n_"))
    hot = F.broadcast(named.where(F.col("n_") >= least).drop("n_"))
    marked = df.join(hot, F.col(column) == F.col("value_"), "left")
    done = marked.where(F.col("rank_").isNotNull() | F.col(column).isNull()).select(*df.columns, F.coalesce("rank_", F.lit(labels)).alias(output))
    others = marked.where(F.col("rank_").isNull() & F.col(column).isNotNull()).select(*df.columns)
    rest = others.join(named.where(F.col("n_") < least), F.col(column) == F.col("value_"), "left")
    return done.unionByName(rest.select(*df.columns, F.coalesce("rank_", F.lit(labels)).alias(output)))
