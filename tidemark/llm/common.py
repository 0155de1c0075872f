"""What several operators share: batches cut to a byte size, word hashes, written stages."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_path

#: Bytes of text that a task takes apart at a time.
CHUNK_BYTES = 2 << 20
#: Bytes of an Arrow batch under :func:`small_batches`; the row that reaches them is still in it.
BATCH_BYTES = 8 << 20
#: A task forgets its cached words beyond this many; results do not depend on it.
CACHE_WORDS = 400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, **options: int) -> DataFrame:
    """``df`` written once to the shared folder, with a writer's ``options``, and read from there.

    A later stage then neither repeats the work nor depends on the executors
    that did it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> Iterator[None]:
    """Actions of this thread hand their Python tasks Arrow batches that end at ``size`` bytes.

    An executor holds a batch several times outside its heap: as vectors, as
    the stream of them, and as the room both grew into. A session that has set
    the limit keeps its own.
    """
    context, key = spark.sparkContext, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = context.getLocalProperty(key)
    context.setLocalProperty(key, str(size))
    try:
        yield
    finally:
        context.setLocalProperty(key, before)


def released(task: Callable) -> Callable:
    """``task`` (batches to batches) that hands its memory back when it ends.

    Python workers live on between stages; what they once held would otherwise
    count against the stages after.
    """
    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            gc.collect()
            hand_back()

    return run


def hand_back() -> None:
    """Free memory goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def place(docs: DataFrame, name: str) -> int:
    """Which of the columns of ``docs`` Spark finds under ``name``; its own error where none or more than one is."""
    docs.select(name)
    same = [i for i, c in enumerate(docs.columns) if c.lower() == name.lower()]
    return next((i for i in same if docs.columns[i] == name), same[0])


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of some ``limit`` bytes each; a longer text is a range of its own."""
    low = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield low, i
            low, size = i, 0
        size += len(text)
    if low < len(texts):
        yield low, len(texts)


class WordHashes(dict):
    """64-bit hash of each word, computed once per task."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: Iterable[bytes], count: int) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, count)


_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = 0x9E3779B97F4A7C15 | 1


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection on 64 bits whose outputs look independent for different seeds."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def doubled(h: np.ndarray, length: int) -> np.ndarray:
    """Hashes of windows of ``2 * length`` from those of windows of ``length``.

    Entry ``i`` belongs to the window that starts at ``i``; the result has
    ``length`` entries fewer.
    """
    power = np.uint64(pow(_BASE, length, 2**64))
    return h[:-length] * power + h[length:] if len(h) > length else h[:0]


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` consecutive words, by repeated doubling."""
    total, have, part = None, 0, words
    size = 1
    rest = length
    while rest:
        if rest & 1:
            if total is None:
                total, have = part, size
            else:
                n = len(words) - have - size + 1
                if n <= 0:
                    return words[:0]
                power = np.uint64(pow(_BASE, size, 2**64))
                total, have = total[:n] * power + part[have:have + n], have + size
        rest >>= 1
        if rest:
            part = doubled(part, size)
            size *= 2
    return mixed(total)


def lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column: row ``i`` holds the values before ``ends[i]`` and from the end before it."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def pieces(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """The texts of a string column as :func:`as_bytes` gives them, some ``limit`` bytes at a time."""
    column = column.cast(pa.binary())
    sizes = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)))
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(sizes, sizes[low] + limit, "right")) - 1)
        yield as_bytes(column.slice(low, high - low))
        low = high


def ranged(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """The index range of each of :func:`pieces` and its texts, so that a batch is never held a second time."""
    low = 0
    for texts in pieces(column, limit):
        yield low, low + len(texts), texts
        low += len(texts)
