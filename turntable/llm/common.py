"""What the operators share: batches of bounded size, and texts that may be null."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

BATCH_ROWS = 2_000
BATCH_BYTES = 4 << 20
KNOWN_BYTES = 64 << 20
ENTRY_BYTES = 180  # of a dictionary's entry beside the contents of its key and value

_held: dict[tuple, Any] = {}


def ready_workers(spark: SparkSession) -> None:
    """Bound the batches that go to Python, and let local workers import this package.

    A batch ends at BATCH_ROWS rows or BATCH_BYTES bytes, so that long texts do not pile up in a
    worker. On a cluster the package is installed or sent with --py-files, as any other.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    root = str(Path(__file__).resolve().parents[2])
    known = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], Any]:
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda pad: None)  # not every allocator has it


def give_back() -> None:
    """Return freed memory to the system, which counts it against the executor otherwise."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def of_worker(build: Callable[..., Any], *key: Any) -> Any:
    """`build(*key)`, kept in this worker until another operator asks for something else.

    Spark uses its Python workers again for later stages; what one operator has learnt there would
    otherwise stay beside what the next one learns.
    """
    if (build, *key) not in _held:
        _held.clear()
        gc.collect()
        give_back()
        _held[build, *key] = build(*key)
        give_back()
    return _held[build, *key]


class Known(dict):
    """Results by text, made by `work` when they are looked up first.

    Beyond `limit` bytes a new generation begins, into which those of the last one are taken that are asked for.
    """

    def __init__(self, work: Callable[[Any], Any] | None = None, limit: int = KNOWN_BYTES) -> None:
        super().__init__()
        self._work, self._limit, self._size, self._last = work, limit, 0, {}

    def __missing__(self, key: Any) -> Any:
        if self._work is None:
            raise KeyError(key)
        value = self._last[key] if key in self._last else self._work(key)
        self._size += len(key) + len(value) + ENTRY_BYTES
        self[key] = value
        return value

    def unknown(self, keys: Iterable[Any]) -> list[Any]:
        """Those of different keys that neither generation has; the others can now be looked up."""
        new = [key for key in set(keys) if key not in self]
        again = {key: self._last[key] for key in new if key in self._last}
        if again:
            self.add(again)
            new = [key for key in new if key not in again]
        return new

    def add(self, made: dict[Any, Any]) -> None:
        """Keep new results, whose keys and values have a length in bytes or characters."""
        self._size += sum(map(len, made)) + sum(map(len, made.values())) + ENTRY_BYTES * len(made)
        self.update(made)

    def trim(self) -> None:
        """To be called between batches, whose keys must all be known together."""
        if self._size > self._limit:
            self._last = dict(self)
            self.clear()
            self._size = 0


class WordTable:
    """Rows of numbers for words, each worked out once, in a table that is emptied when it is full.

    `work` gives the rows of a list of words. The table grows in place; it holds `limit` bytes, or
    the words of one call if these need more.
    """

    def __init__(self, width: int, work: Callable[[list[str]], np.ndarray], limit: int = KNOWN_BYTES) -> None:
        self._work, self._number = work, {}
        self._most = max(1, limit // (4 * width + ENTRY_BYTES))
        self.rows = np.empty((1024, width), dtype=np.float32)

    def numbers(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The rows of the table that belong to the words of each text. Rows of earlier calls may be gone."""
        number = self._number
        words = set().union(*texts)
        new = list(words.difference(number))
        if new and len(number) + len(new) > self._most:
            number.clear()
            new = list(words)
        if new:
            first, last = len(number), len(number) + len(new)
            if last > len(self.rows):
                grown = np.empty((max(last, min(2 * last, self._most)), self.rows.shape[1]), dtype=np.float32)
                grown[:first] = self.rows[:first]
                self.rows = grown
            self.rows[first:last] = self._work(new)
            number.update(zip(new, range(first, last), strict=True))
        return [np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words)) for words in texts]


def blocks_of(sizes: Sequence[int], most: int) -> Iterator[slice]:
    """Runs of items whose sizes add up to `most` at most; an item larger than that is a run of its own."""
    at = 0
    while at < len(sizes):
        stop, total = at + 1, sizes[at]
        while stop < len(sizes) and total + sizes[stop] <= most:
            total += sizes[stop]
            stop += 1
        yield slice(at, stop)
        at = stop


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: StructType | str) -> DataFrame:
    """`work` over each Arrow batch of `df`; it returns a batch of `schema`, or None for no rows.

    What a batch needed goes back to the system before the next one: a worker keeps it otherwise, also while it waits for a task.
    """
    ready_workers(df.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = work(batch) if batch.num_rows else None
            if out is not None:
                yield out
            out = batch = None
            give_back()

    return df.mapInArrow(each, schema)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """A text column as strings, null as the empty text."""
    return [text or "" for text in batch.column(column).to_pylist()]
