"""What the training-data operators share: table access, bounded memory of workers, exact hashing."""

from __future__ import annotations

import ctypes
import functools
import hashlib
import os
import sys
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from filingpanel.session import ship_package

#: Rows, and bytes, that travel to a Python worker at once: many narrow rows, or few very long texts.
BATCH_ROWS, BATCH_BYTES = 10_000, 2 << 20


def prepare(spark: SparkSession) -> None:
    """Settings of the session that every operator with Python workers relies on."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Whether the shuffle files of a query go when it has ended, and not when the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Meanwhile, shuffle files go with the query that made them: for rounds whose results are written."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


#: Bytes of keys and values that a ``Memo`` holds at most, and what an entry takes beside those of its own.
MEMO_BYTES, ENTRY_BYTES = 96 << 20, 100


class Memo(dict):
    """A dictionary that computes what it lacks and starts anew when it holds ``limit`` entries or ``most`` bytes."""

    def __init__(self, compute: Callable, limit: int, longest: int = 64, most: int = MEMO_BYTES):
        super().__init__()
        self.compute, self.limit, self.longest, self.most, self.held = compute, limit, longest, most, 0

    def __missing__(self, key: Hashable):
        value = self.compute(key)
        if len(key) <= self.longest:
            size = ENTRY_BYTES + sys.getsizeof(key) + sys.getsizeof(value)
            if len(self) >= self.limit or self.held + size > self.most:
                self.clear()
                self.held = 0
            self[key] = value
            self.held += size
        return value


@functools.cache
def _trim() -> Callable | None:
    """What gives freed memory of this process back to the system, where the C library can."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def hand_back() -> None:
    """Give memory that a task has freed back to the system: worker processes outlive their tasks and wait idle."""
    pa.default_memory_pool().release_unused()
    if (trim := _trim()) is not None:
        trim(0)


def tidy(function: Callable) -> Callable:
    """A function over a partition's batches that hands its memory back when the partition has ended."""

    @functools.wraps(function)
    def run(batches):
        try:
            yield from function(batches)
        finally:
            hand_back()

    return run


def text_or_empty(values) -> list[str]:
    """A column of texts as Python strings, null as the empty text."""
    return [v if isinstance(v, str) else "" for v in values]


#: What a worker process keeps between its tasks: the last model with its caches, and no other.
_KEPT: dict = {}


def kept(key: Hashable, build: Callable):
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = build()
    return _KEPT[key]


def digest(text: str) -> bytes:
    return hashlib.sha256(text.encode()).digest()
