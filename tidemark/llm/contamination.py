"""Operator 8: benchmark passages in training documents, by an FM-index per shard.

A shard is a run of documents that one task holds, some megabytes of text. Its
words become numbers (those that no benchmark item has are one number that
matches nothing), its suffixes are sorted, and every window of every item is
looked up by backward search on wavelet-tree ranks. Occurrences are located by
sampled suffix places, and their spans merged per document.

Words are runs of ASCII letters and digits, lower-cased, and of all non-ASCII
characters. A window is ``width`` consecutive words of an item; an item with
fewer words, but not none, is one window.

The benchmark is the query set. It travels to the tasks in blocks of at most
``BLOCK_BYTES`` of text, each a pass of its own over the documents within the
same stage, so that its size has no bound but no task holds more than a block.

Rows: null and empty texts have no words and no hits; items with a null id or
text are ignored, items with equal ids count once; every input row gives one row
and carries its columns, of any names, in ``row``. Empty tables on either side
give no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tidemark.llm.common import place, ranged, released
from tidemark.llm.suffixes import FMIndex

BLOCK_BYTES = 16 << 20
SHARD_BYTES = 4 << 20
#: Located places are expanded for so many at a time.
PLACES = 1 << 20

_KEPT = bytes(range(48, 58)) + bytes(range(97, 123)) + bytes(range(128, 256))
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c in _KEPT else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


class Windows:
    """The distinct windows of a block of items, as numbers, and the items that have each."""

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for name, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for i in range(max(1, len(ids) - width + 1) if ids else 0):
                owners.setdefault(tuple(ids[i:i + width]), set()).add(name)
        self.items = [sorted(x) for x in owners.values()]
        self.lengths = np.array([len(x) for x in owners], np.int64)
        self.patterns = np.zeros((len(owners), width), np.int64)
        for row, x in zip(self.patterns, owners):
            row[width - len(x):] = x

    def occurrences(self, s: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of arrays: windows, and the places in ``s`` where they start."""
        index = FMIndex(s, len(self.vocabulary))
        here = np.flatnonzero(((self.patterns == 0) | (index.counts[self.patterns] > 0)).all(1))
        low, high = index.search(self.patterns[here], self.lengths[here])
        found = np.flatnonzero(high > low)
        here, low, size = here[found], low[found], (high - low)[found]
        ends = np.cumsum(size)
        for a in range(0, int(ends[-1]) if len(ends) else 0, PLACES):
            k = np.arange(a, min(a + PLACES, ends[-1]))
            which = np.searchsorted(ends, k, side="right")
            yield here[which], index.locate(low[which] + k - (ends - size)[which])


def _blocks(benchmark: DataFrame, width: int, limit: int) -> Iterator[Windows]:
    held, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("i"), "text").dropna().orderBy("i")
    for r in rows.toLocalIterator():
        text = r.text.encode()
        if held and size + len(text) > limit:
            yield Windows(held, width)
            held, size = [], 0
        held.append((r.i, text))
        size += len(text)
    yield Windows(held, width)


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


def _shard(texts: list[bytes], windows: Windows):
    """Word counts, hit spans and item ids of each text."""
    get = windows.vocabulary.get
    words = [words_of(t) for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(counts + 1)  # a 0 behind each document
    starts = ends - counts - 1
    s = np.zeros(int(ends[-1]), np.int64)
    for a, n, ws in zip(starts.tolist(), counts.tolist(), words):
        s[a:a + n] = np.fromiter((get(w, 0) for w in ws), np.int64, n)
    edge = np.zeros(len(s) + 1, np.int64)
    items: list[set[str]] = [set() for _ in texts]
    for which, at in windows.occurrences(s):
        np.add.at(edge, at, 1)
        np.add.at(edge, at + windows.lengths[which], -1)
        doc = np.searchsorted(ends, at, side="right")
        for d, w in np.unique(np.stack([doc, which], 1), axis=0).tolist():
            items[d].update(windows.items[w])
    turns = np.diff((np.cumsum(edge) > 0).astype(np.int8), prepend=0)
    begin, end = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    doc = np.searchsorted(ends, begin, side="right")
    spans: list[list[list[int]]] = [[] for _ in texts]
    for d, a, b in zip(doc.tolist(), (begin - starts[doc]).tolist(), (end - starts[doc]).tolist()):
        spans[d].append([a, b])
    return counts, spans, items


def _searched(docs: DataFrame, windows: Windows, text: int) -> DataFrame:
    """One block's pass over the texts, column ``text`` of ``row``; what earlier blocks found stands in
    ``spans`` and ``items``."""
    shared = docs.sparkSession.sparkContext.broadcast(windows)
    schema = StructType([
        docs.schema["row"], StructField("n_words", LongType()), StructField("spans", ArrayType(ArrayType(LongType()))),
        StructField("items", ArrayType(StringType()))])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        for batch in batches:
            for low, high, texts in ranged(batch["row"].field(text), SHARD_BYTES):
                part = batch.slice(low, high - low)
                counts, spans, items = _shard(texts, windows)
                if "spans" in batch.schema.names:
                    spans = [_merged(x + y) for x, y in zip(spans, part["spans"].to_pylist())]
                    items = [x.union(y) for x, y in zip(items, part["items"].to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part["row"], pa.array(counts), pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                     pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                    names=["row", "n_words", "spans", "items"])

    return docs.mapInArrow(released(search), schema)


def find_passages(docs: DataFrame, benchmark: DataFrame, width: int = 10,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For every row of ``docs`` (text): ``row`` (all its columns), n_words, ``spans`` of hit words
    ([begin, end) pairs, merged, ascending) and the ``items`` (ids as strings) with a window in it."""
    text, found = place(docs, "text"), docs.select(F.struct("*").alias("row"))
    blocks = _blocks(benchmark, width, block_bytes)
    block = next(blocks)
    while block is not None:
        found, block = _searched(found, block, text), next(blocks, None)
    return found


def digests(found: DataFrame) -> DataFrame:
    return found.select(
        "row.doc_id", "n_words",
        F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x[1] - x[0]).alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """The rows of ``docs`` without any benchmark passage, with their own columns."""
    return find_passages(docs, benchmark, width).filter(F.size("spans") == 0).select("row.*")
