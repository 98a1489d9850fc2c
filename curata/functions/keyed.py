"""Keyed uniform draws.

``F.rand(seed)`` depends on how rows are laid out in partitions: the same
seed over a differently partitioned input selects different rows.  A draw
computed from the row's own key does not, so fault injection, splits and
samples are reproducible on any cluster size and after any repartition, and
an executor that recomputes a lost partition draws the same numbers.

u(seed, key) = first 32 bits of md5("<seed>:<key>") / 2^32, in [0, 1).
A NULL key draws as the empty text, so every row has a draw.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_POW_32 = 4294967296.0


def hash_uniform_expr(seed: int, key: str) -> str:
    """The draw as Spark SQL text over a key column name."""
    return (f"(CAST(conv(substring(md5(concat('{int(seed)}:', COALESCE(CAST(`{key}` AS STRING), ''))), 1, 8), 16, 10) AS DOUBLE)"
            f" / {_TWO_POW_32}D)")


def hash_uniform(seed: int, key: Column | str) -> Column:
    """Deterministic U[0,1) draw from a seed and a row key (any type)."""
    if isinstance(key, str):
        return F.expr(hash_uniform_expr(seed, key))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(_TWO_POW_32)


def hash_uniform_sql(seed: int, key_sql: str) -> str:
    """The same draw as ANSI SQL text for DuckDB (used by the oracles)."""
    return f"(('0x' || substr(md5('{seed}:' || COALESCE(CAST({key_sql} AS VARCHAR), '')), 1, 8))::BIGINT / {_TWO_POW_32})"
