"""Small column helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def existing(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """The given columns that exist in ``df``, in the given order."""
    present = set(df.columns)
    return [c for c in columns if c in present]


def is_missing(df: DataFrame, name: str, sentinels: Iterable[str] = (), nan: bool = True) -> Column:
    """True where a value counts as missing: NULL, NaN (floating types) or a sentinel string."""
    dtype = df.schema[name].dataType
    col = F.col(name)
    cond = col.isNull()
    if nan and isinstance(dtype, (T.DoubleType, T.FloatType)):
        cond = cond | F.isnan(col)
    sentinels = list(sentinels)
    if sentinels and isinstance(dtype, T.StringType):
        cond = cond | col.isin(sentinels)
    # isin/== on NULL gives NULL; coalesce keeps the flag boolean
    return F.coalesce(cond, F.lit(False))


def safe_div(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI mode would raise)."""
    return num / F.nullif(den, F.lit(0))
