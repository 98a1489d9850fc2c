"""Keyed split, class weights and nested samples (W1, W2, L1 sampling).

``randomSplit`` and ``sample`` depend on the partition layout of their
input; a draw from the row key does not, and it needs no shuffle.  Every row
has a draw, also with a NULL key, so the two parts of a split are disjoint
and together complete.  With a group key (a patient, say) all rows of a group
are on one side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.functions.keyed import hash_uniform


def tag_split(df: DataFrame, key: str = "row_key", fraction: float = 0.8, seed: int = 42,
              column: str = "split") -> DataFrame:
    """Add ``split`` = 'train' where u(seed, key) < fraction, else 'test'."""
    return df.withColumn(column, F.when(hash_uniform(seed, key) < fraction, F.lit("train")).otherwise(F.lit("test")))


def split_by_key(df: DataFrame, key: str = "row_key", fraction: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    u = hash_uniform(seed, key)
    return df.where(u < fraction), df.where(u >= fraction)


def nested_sample(df: DataFrame, fraction: float, key: str = "row_key", seed: int = 44) -> DataFrame:
    """Rows with u(seed, key) < fraction: a smaller fraction is a subset of a larger one."""
    if fraction >= 1.0:
        return df
    return df.where(hash_uniform(seed, key) < fraction)


def class_balance(df: DataFrame, label: str = "label") -> tuple[int, int]:
    """(n label 0, n label 1) from ONE aggregate."""
    row = df.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")).first()
    return int(row["n0"] or 0), int(row["n1"] or 0)


def add_class_weights(df: DataFrame, label: str = "label", weight_col: str = "class_weight") -> tuple[DataFrame, float]:
    """weight = n0/n1 for label 1 rows, 1.0 otherwise.  Without label-1
    rows every weight is 1.0 and the ratio is 1.0."""
    n0, n1 = class_balance(df, label)
    if n1 == 0:
        return df.withColumn(weight_col, F.lit(1.0)), 1.0
    ratio = n0 / n1
    return df.withColumn(weight_col, F.when(F.col(label) == 1, F.lit(ratio)).otherwise(F.lit(1.0))), ratio
