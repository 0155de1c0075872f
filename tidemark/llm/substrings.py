"""Operator 5: removal of word windows that occur earlier, by level-wise doubling.

A window of ``length`` words is removed where its word sequence also starts
earlier: at a smaller ``doc_id``, or earlier in the same document.

Level one looks at half-length windows, and not at all of them: of the
half-length windows inside one full window the one with the smallest hash is its
anchor, so equal full windows have equal anchors at equal places, and an anchor
that occurs once rules out all full windows it stands for. Only what is repeated
at this level is extended to twice the length, hashed and compared. Longer
windows than ``length`` cannot change which words are covered, so the doubling
ends there.

A task first combines what it holds itself: a window repeated within a batch
sends one row, whose later copies travel along as decided. No key therefore has
more rows than there are batches, however many documents share a passage.

Equal windows are told by 64-bit hashes of 64-bit word hashes. Rows: a null
text has no words; null ids come first; rows with equal ids count as one
document, so that equal places are not earlier than each other, and repeated
rows get equal results. An empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WordHashes, as_bytes, chunks, window_hashes, written

_NO_ID = -(2**63)
_PLACE = np.dtype([("did", "<i8"), ("pos", "<i8")])
_COPY = np.dtype([("did", "<i8"), ("th", "<i8"), ("pos", "<i8")])


def _running(x: np.ndarray, n: int, f) -> np.ndarray:
    """``f`` over each run of ``n`` values, by doubling."""
    size, out = 1, x
    while 2 * size <= n:
        out, size = f(out[:-size], out[size:]), 2 * size
    return f(out[:len(out) - (n - size)], out[n - size:]) if n > size else out


def anchors(h: np.ndarray, span: int) -> np.ndarray:
    """Places of the values that are smallest in some run of ``span`` values."""
    if len(h) < span:
        return np.zeros(0, np.int64)
    least = _running(h, span, np.minimum)
    padded = np.concatenate([np.zeros(span - 1, h.dtype), least, np.zeros(span - 1, h.dtype)])
    return np.flatnonzero(_running(padded, span, np.maximum) == h)


def _hashed(texts: list[bytes], hashes: WordHashes):
    """Words of each text, the hashes of all, and the ends of the texts among them."""
    words = [t.split() for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    return words, hashes.of((w for ws in words for w in ws), int(counts.sum())), np.cumsum(counts)


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of ``keys`` and, in it, where each run of equal keys begins."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    return order, np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else order


def _packed(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column of the records between each begin and end."""
    raw, size = values.tobytes(), values.dtype.itemsize
    return pa.array([raw[a * size:b * size] for a, b in zip(begins.tolist(), ends.tolist())], pa.binary())


def _level_one(docs: DataFrame, length: int) -> DataFrame:
    """Anchors that occur more than once: did, and the list of their places in it."""
    half = length // 2

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts, ids = as_bytes(batch["text"]), batch["did"].to_numpy(zero_copy_only=False)
            keys, found = [], []
            for low, high in chunks(texts):
                _, h, ends = _hashed(texts[low:high], hashes)
                for i, (a, b) in enumerate(zip([0, *ends], ends)):
                    if b - a >= length:
                        windows = window_hashes(h[a:b], half)
                        at = anchors(windows, length - half + 1)
                        row = np.empty(len(at), _PLACE)
                        row["did"], row["pos"] = ids[low + i], at
                        keys.append(windows[at])
                        found.append(row)
            if keys:
                key, found = np.concatenate(keys), np.concatenate(found)
                order, begins = _grouped(key)
                yield pa.record_batch({
                    "h": pa.array(key[order][begins].view(np.int64)),
                    "places": _packed(found[order], begins, np.append(begins[1:], len(order)))})

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.frombuffer(b"".join(batch["places"].to_pylist()), _PLACE)
            yield pa.record_batch({"did": pa.array(rows["did"].copy()), "pos": pa.array(rows["pos"].copy())})

    rows = docs.select("did", "text").mapInArrow(places, "h bigint, places binary")
    again = (rows.withColumn("n", F.count("*").over(Window.partitionBy("h")))
                 .filter((F.col("n") > 1) | (F.octet_length("places") > _PLACE.itemsize)))
    return (again.select("places").mapInArrow(unpack, "did bigint, pos bigint")
                 .groupBy("did").agg(F.collect_list("pos").alias("at")))


def _repeats(docs: DataFrame, at: DataFrame, length: int) -> DataFrame:
    """Full windows that start earlier elsewhere: did, and the list of (th, pos) where they start."""
    half = length // 2

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts, ids = as_bytes(batch["text"]), batch["did"].to_numpy(zero_copy_only=False)
            th, marks = batch["th"].to_numpy(zero_copy_only=False), batch["at"]
            keys, found = [], []
            for low, high in chunks(texts):
                _, h, ends = _hashed(texts[low:high], hashes)
                for i, (a, b) in enumerate(zip([0, *ends], ends)):
                    n = b - a - length + 1
                    if n <= 0:
                        continue
                    marked = marks[low + i].values.to_numpy(zero_copy_only=False)
                    edge = np.zeros(n + length + 1, np.int64)
                    marked = marked[marked <= n + length - half]
                    np.add.at(edge, np.maximum(marked - (length - half), 0), 1)
                    np.add.at(edge, marked + 1, -1)
                    starts = np.flatnonzero(np.cumsum(edge)[:n])
                    row = np.empty(len(starts), _COPY)
                    row["did"], row["th"], row["pos"] = ids[low + i], th[low + i], starts
                    keys.append(window_hashes(h[a:b], length)[starts])
                    found.append(row)
            if not keys:
                continue
            key, found = np.concatenate(keys), np.concatenate(found)
            order = np.lexsort((found["pos"], found["did"], key))
            key, found = key[order], found[order]
            new = np.concatenate([[True], key[1:] != key[:-1]])
            first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
            tied = (found["did"] == found["did"][first]) & (found["pos"] == found["pos"][first])
            heads = np.flatnonzero(tied)
            # The ties of a first place stand right behind it, and what follows the last of them is later.
            last = np.append(new[heads][1:], True)
            ends = np.where(last, np.append(heads[1:], len(key)), heads + 1)
            yield pa.record_batch({
                "h": pa.array(key[heads].view(np.int64)), "did": pa.array(found["did"][heads]),
                "th": pa.array(found["th"][heads]), "pos": pa.array(found["pos"][heads]),
                "later": _packed(found, heads + 1, ends)})

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch["rank"].to_numpy(zero_copy_only=False) > 1
            rows = np.empty(int(own.sum()), _COPY)
            for name in _COPY.names:
                rows[name] = batch[name].to_numpy(zero_copy_only=False)[own]
            rows = np.concatenate([rows, np.frombuffer(b"".join(batch["later"].to_pylist()), _COPY)])
            yield pa.record_batch({n: pa.array(rows[n].copy()) for n in _COPY.names})

    rows = docs.join(at, "did").mapInArrow(windows, "h bigint, did bigint, th bigint, pos bigint, later binary")
    ranked = rows.withColumn("rank", F.rank().over(Window.partitionBy("h").orderBy("did", "pos")))
    return (ranked.filter((F.col("rank") > 1) | (F.octet_length("later") > 0))
                  .mapInArrow(unpack, "did bigint, th bigint, pos bigint")
                  .groupBy("did").agg(F.collect_list(F.struct("th", "pos")).alias("again")))


def remove_repeats(docs: DataFrame, length: int = 20) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, n_removed and ``kept``, the words left, joined by spaces."""
    docs = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)).alias("did"),
                       F.xxhash64("text").alias("th"), "text")
    at = written(_level_one(docs, length), "anchors")
    again = _repeats(docs, at, length)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids, th, marks = as_bytes(batch["text"]), batch["did"], batch["th"].to_pylist(), batch["again"]
            for low, high in chunks(texts):
                total, removed, kept = [], [], []
                for i in range(low, high):
                    words = texts[i].split()
                    total.append(len(words))
                    mark = marks[i]
                    if mark.is_valid:
                        own = mark.values.field("th").to_numpy(zero_copy_only=False) == th[i]
                        at = mark.values.field("pos").to_numpy(zero_copy_only=False)[own]
                        edge = np.zeros(len(words) + 1, np.int64)
                        np.add.at(edge, at, 1)
                        np.add.at(edge, at + length, -1)
                        gone = np.cumsum(edge)[:-1] > 0
                        removed.append(int(gone.sum()))
                        words = [words[j] for j in np.flatnonzero(~gone).tolist()]
                    else:
                        removed.append(0)
                    kept.append(b" ".join(words))
                yield pa.record_batch({"did": ids[low:high], "n_words": pa.array(total, pa.int64()),
                                       "n_removed": pa.array(removed, pa.int64()),
                                       "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    return (docs.join(again, "did", "left")
                .mapInArrow(cut, "did bigint, n_words bigint, n_removed bigint, kept string")
                .select(F.nullif("did", F.lit(_NO_ID)).alias("doc_id"), "n_words", "n_removed", "kept"))


def digests(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
