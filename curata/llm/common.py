"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Hashable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def byte_of_character() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


_HELD: dict[Hashable, object] = {}


def held_by_worker(name: Hashable, build: Callable[[], object]) -> object:
    """What ``build`` gives, kept for the tasks that the worker runs later.

    A worker serves one stage after another, so it keeps one such helper: another one takes the place of the
    former, whose memory goes back to the machine first.
    """
    if name not in _HELD:
        _HELD.clear()
        give_back_memory()
        _HELD[name] = build()
    return _HELD[name]


def give_back_memory() -> None:
    """Memory that the worker has freed, but still holds, goes back to the machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):    # not in every C library
        pass


def keyed_bucket(key: str, buckets: int) -> Column:
    """crc32(key as text) mod ``buckets``; NULL keys go to bucket 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % buckets, F.lit(0))
