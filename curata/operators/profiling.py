"""Profiling aggregates (P1-P6): the numbers behind the five profile figures.

Each profile is ONE aggregate pass over the table (plus, for histograms, a
first pass for min/max).  Only per-column scalars reach the driver; the
results are small DataFrames that can be written or queried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.functions.exprs import existing, is_missing
from curata.sources.sinks import written_table
from curata.spec import SENTINELS, SPARSE_THRESHOLD


def class_distribution(df: DataFrame, column: str) -> DataFrame:
    """Count per class, largest first, with its share in percent (1 decimal).

    The share's total is a scalar subquery over the grouped result.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.select(F.sum("n")).scalar()
    return counts.withColumn("pct", F.round(F.col("n") * 100.0 / total, 1)).orderBy(F.desc("n"), column)


def frequency_table(df: DataFrame, column: str) -> DataFrame:
    """Count per value, ordered by the value (NULL is its own group)."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(column)


def missing_rates(
    df: DataFrame,
    sentinels: Sequence[str] = SENTINELS,
    threshold: float = SPARSE_THRESHOLD,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Share of NULL, NaN or sentinel values per column, for columns with any.

    One aggregate over all columns; the one-row result is unpivoted to
    (column_name, missing_rate, above_threshold), highest rate first.
    """
    cols = list(columns) if columns is not None else df.columns
    if not cols:
        raise ValueError("missing_rates needs at least one column")
    wide = df.agg(*[F.avg(is_missing(df, c, sentinels).cast("double")).alias(c) for c in cols])
    long = wide.unpivot([], cols, "column_name", "missing_rate")
    return (
        long.where(F.col("missing_rate") > 0)
        .withColumn("above_threshold", F.col("missing_rate") > F.lit(threshold))
        .orderBy(F.desc("missing_rate"), "column_name")
    )


def _finite(x: Column) -> Column:
    return F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))


def value_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """min and max of the finite values of each column as doubles, from one aggregate job."""
    if not columns:
        return {}
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.min(F.when(_finite(x), x)).alias(f"lo{i}"), F.max(F.when(_finite(x), x)).alias(f"hi{i}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(columns)}


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """Equal-width histogram of each numeric column over its own min..max.

    Same counts as ``numpy.histogram(x, bins)``: edges are i * width + lo, the
    bin found by division is corrected against the edges, the last bin is
    closed, and a constant column is widened to lo-0.5..lo+0.5.  NULLs are
    ignored; NaN and infinite values are counted in a row with bin -1 and no
    edges.  Missing columns are skipped, empty bins are not emitted.
    Output: column_name, bin, bin_lo, bin_hi, n.
    """
    cols = existing(df, columns)
    ranges = value_ranges(df, cols)
    stack_args: list[Column] = []
    edges: list[tuple[str, float, float, float]] = []
    for c in cols:
        lo, hi = ranges[c]
        x = F.col(c).cast("double")
        if lo is not None:
            lo, hi = (lo, hi) if hi > lo else (lo - 0.5, lo + 0.5)
            width = (hi - lo) / bins
            guess = F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(bins))).cast("int"), F.lit(bins - 1))
            low = guess * F.lit(width) + F.lit(lo)
            high = F.when(guess == bins - 1, F.lit(hi)).otherwise((guess + 1) * F.lit(width) + F.lit(lo))
            inside = F.when(x < low, guess - 1).when((x >= high) & (guess != bins - 1), guess + 1).otherwise(guess)
            edges.append((c, lo, hi, width))
        else:
            inside = F.lit(None).cast("int")
        stack_args += [F.lit(c), F.when(_finite(x), inside).when(x.isNotNull(), -1).cast("int")]
    if not stack_args:
        return df.sparkSession.createDataFrame([], "column_name string, bin int, bin_lo double, bin_hi double, n bigint")
    pairs = df.select(F.stack(F.lit(len(stack_args) // 2), *stack_args).alias("column_name", "bin"))
    counts = pairs.where(F.col("bin").isNotNull()).groupBy("column_name", "bin").agg(F.count(F.lit(1)).alias("n"))

    def edge(i: Column) -> Column:
        out = F.lit(None).cast("double")
        for c, lo, hi, width in edges:
            out = F.when(F.col("column_name") == c, F.when(i == bins, F.lit(hi)).otherwise(i * F.lit(width) + F.lit(lo))).otherwise(out)
        return F.when(F.col("bin") >= 0, out)

    return counts.select("column_name", "bin", edge(F.col("bin")).alias("bin_lo"), edge(F.col("bin") + 1).alias("bin_hi"), "n").orderBy("column_name", "bin")


def pattern_moments(df: DataFrame, columns: Sequence[str], centres: Sequence[float] | None = None) -> DataFrame:
    """Sums of the columns and of their products by null pattern: (p, n, s0.., q0_0..).

    Bit i of ``p`` says whether column i is there (NaN is not), ``si`` are the sums of the columns and ``qi_j`` those
    of the products of columns i <= j, both of differences to ``centres`` (default 0).  Rows without a gap are one
    group with one set of sums; there are as many groups as null patterns in the data.
    """
    name = lambda c: "`" + c.replace("`", "``") + "`"
    k = len(columns)
    centres = [0.0] * k if centres is None else [float(c) for c in centres]
    values = df.select(*[F.nanvl(F.col(name(c)).cast("double"), F.lit(None).cast("double")).alias(f"v{i}") for i, c in enumerate(columns)])
    pattern = " + ".join(f"IF(v{i} IS NULL, 0L, {1 << i}L)" for i in range(k))
    moved = values.select(F.expr(pattern).alias("p"), *[F.coalesce(F.col(f"v{i}") - F.lit(x) if x else F.col(f"v{i}"), F.lit(0.0)).alias(f"d{i}") for i, x in enumerate(centres)])
    return moved.groupBy("p").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"d{i}").alias(f"s{i}") for i in range(k)],
                                  *[F.expr(f"sum(d{i} * d{j}) AS q{i}_{j}") for i in range(k) for j in range(i, k)])


#: A column whose variance is below this share of its mean square is summed again around its mean.
SMALL_SPREAD = 1e-6


def _centred_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Moments around 0, written once; a second pass around the means runs only if a column's spread is small beside its mean."""
    moments = written_table(pattern_moments(df, columns), "moments")
    sums = []
    for i in range(len(columns)):
        there = F.col("p").bitwiseAND(F.lit(1 << i).cast("long")) != 0
        sums += [F.sum(F.when(there, F.col("n"))).alias(f"n{i}"), F.sum(f"s{i}").alias(f"s{i}"), F.sum(f"q{i}_{i}").alias(f"q{i}")]
    row = moments.agg(*sums).first()
    means = [row[f"s{i}"] / row[f"n{i}"] if row[f"n{i}"] else 0.0 for i in range(len(columns))]
    narrow = [row[f"n{i}"] and row[f"q{i}"] / row[f"n{i}"] - m * m < SMALL_SPREAD * m * m for i, m in enumerate(means)]
    return written_table(pattern_moments(df, columns, means), "moments") if any(narrow) else moments


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, pairwise-complete, in long form.

    One grouped aggregate makes the moments of every null pattern (``pattern_moments``); a pair's
    moments are the sums over the patterns that have both.  The columns are few: a pattern is a number of 63 bits.  A constant column gives NULL (``F.corr``
    would raise a division by zero under ANSI mode).  Without a matching column the result is empty.
    """
    cols = existing(df, columns)
    if not cols:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, corr double")
    k = len(cols)
    moments = _centred_moments(df, cols)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    entries = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit((1 << i) | (1 << j)).cast("long").alias("both"), F.col(f"s{i}").alias("si"), F.col(f"s{j}").alias("sj"),
                        F.col(f"q{i}_{i}").alias("qi"), F.col(f"q{j}_{j}").alias("qj"), F.col(f"q{i}_{j}").alias("qij")) for i, j in pairs]
    long = moments.select("p", "n", F.inline(F.array(*entries)))
    sums = long.groupBy("i", "j").agg(*[F.sum(F.when(F.col("p").bitwiseAND(F.col("both")) == F.col("both"), F.col(c))).alias(c) for c in ("n", "si", "sj", "qi", "qj", "qij")])
    spread = lambda q, x, y: F.col(q) - F.col(x) * F.col(y) / F.col("n")
    rounding = F.lit(1e-12)
    flat = lambda q, s: spread(q, s, s) <= rounding * F.col(q)
    r = F.when(flat("qi", "si") | flat("qj", "sj"), F.lit(None).cast("double")).when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(
        spread("qij", "si", "sj") / F.sqrt(spread("qi", "si", "si") * spread("qj", "sj", "sj")))
    names = F.array(*[F.lit(c) for c in cols])
    found = sums.select(F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), r.alias("corr"))
    both = F.when(F.col("a") == F.col("b"), F.array(F.struct(F.col("a").alias("col_a"), F.col("b").alias("col_b")))).otherwise(
        F.array(F.struct(F.col("a").alias("col_a"), F.col("b").alias("col_b")), F.struct(F.col("b").alias("col_a"), F.col("a").alias("col_b"))))
    return found.select("corr", F.inline(both)).select("col_a", "col_b", "corr")


def correlation_heatmap(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Wide correlation matrix rounded for annotation: feature + one column per feature."""
    cols = existing(df, columns)
    long = correlations(df, cols).withColumn("corr", F.round("corr", digits))
    wide = long.groupBy("col_a").pivot("col_b", cols).agg(F.max("corr"))
    return wide.withColumnRenamed("col_a", "feature").select("feature", *cols)
