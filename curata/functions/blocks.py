"""Contiguous value blocks for prefix sums without a single-task sort.

A running sum in value order over a whole table would put every row in one
task.  Instead the distinct values are cut into contiguous blocks at
approximate quantiles (a bounded sketch: ``blocks`` numbers reach the
driver); each block is small enough for one task, and block offsets come
from the per-block totals (``blocks`` rows).
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_BLOCK = 2_000_000


def block_count(n_distinct: int, minimum: int = 8) -> int:
    return max(minimum, math.ceil(n_distinct / ROWS_PER_BLOCK))


def with_blocks(grouped: DataFrame, value: str, blocks: int, out: str = "block") -> DataFrame:
    """Add a block number (double, ascending with ``value``) to a table with one row per distinct value."""
    probs = [i / blocks for i in range(1, blocks)]
    bounds = grouped.approxQuantile(value, probs, 1.0 / (4 * blocks)) if probs else []
    splits = [float("-inf")] + sorted({b for b in bounds if math.isfinite(b)}) + [float("inf")]
    if len(splits) < 3:   # one block: Bucketizer needs at least one inner bound
        return grouped.withColumn(out, F.lit(0.0))
    return Bucketizer(splits=splits, inputCol=value, outputCol=out).transform(grouped)
