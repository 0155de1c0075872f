"""Operator 7: code length of texts under a context tree of bytes.

A text is its lower-cased words joined by one space, and one end byte. A byte is
eight binary decisions; each decision has a context tree over the ``DEPTH`` bytes
before it. Every node has a Krichevsky-Trofimov estimate from its training
counts, and the estimates of all depths on a path are mixed with the weights of
context-tree weighting: a node's probability of its data is half its own
estimate's and half the product of its children's.

Training counts all (context, byte) pairs of all training texts, combined per
task, and every context counts, however rare. The distinct codes (a context and
its byte) are dealt by the ``TOP`` nearest bytes of the context: below those a
tree depends on no other, so a task weighs its subtrees alone. What the roots of the
subtrees add up to, at most 255 nodes for each of 65,536 contexts, is weighed in
the driver and sent back; then a task has the probability of each of its codes,
also of those that only texts outside training have. The ``FREQUENT`` most
frequent codes go to every task that scores texts; a text's other codes are
joined to theirs by a shuffle on the code, so none is left out.

The base score is the add-one unigram model of the words and the end token.
Counts of words are met by a shuffle on the word: a task sends each word once
per block of documents, with the places where it stands.

Rows: null texts are empty and have the end alone; all rows of equal id and text
get equal results; other columns are ignored. Without training rows all
decisions are even and all words unknown. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, chunks, lists, mixed, released, written

DEPTH = 6
#: Bytes before a byte by which codes are dealt to tasks.
TOP = 2
#: Codes of whole subtrees that a task weighs at a time, if not one subtree has more.
SUBTREE_CODES = 1 << 18
#: Codes whose probabilities go to every task; those of all others are joined.
FREQUENT = 1_600_000
END = b"\n"
#: Text bytes whose words are met together.
BLOCK_BYTES = 10 << 20
#: Counted codes a task holds before it combines them, and sends them on if over half are distinct.
HELD_CODES = 4 << 20
#: Sums a task holds before it sends them on.
HELD = 2 << 20
CACHE_BITS = 21
#: Keys that a table looks up at a time.
LOOKED_UP = 1 << 18

_POST = np.dtype([("doc", "<u4"), ("n", "<u4")])
_DOC = np.dtype([("did", "<i8"), ("th", "<i8")])
_SUM = np.dtype([("doc", "<u4"), ("known", "<u4"), ("add", "<f8")])
_CELL = np.dtype([("key", "<i8"), ("value", "<f8")])
_NO_ID = -(2**63)


def spelled(text: bytes) -> bytes:
    """The bytes that are scored."""
    return b" ".join(text.lower().split()) + END


def _codes(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each byte: itself and the ``depth`` (up to 7) before it as one number; begins and ends of the texts."""
    raw = bytes(7 - depth) + (END * depth).join([b"", *texts])
    # Every eight bytes in a row are read as one number, of which the last ``depth + 1`` bytes count.
    code = np.ndarray(max(len(raw) - 7, 0), ">u8", raw, strides=(1,)).astype(np.uint64)
    code &= np.uint64((1 << 8 * depth + 8) - 1)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + depth) - depth
    return code, ends - sizes, ends


def count_contexts(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(code, n): how often each byte follows each run of ``depth`` bytes in the texts of ``docs`` (text, training).

    Texts that are not for training add their codes with ``n`` 0.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def combined() -> pa.RecordBatch:
            keys, n = np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held])
            held.clear()
            order = np.argsort(keys)
            keys, n = keys[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            return keys[first], np.add.reduceat(n, first)

        def sent(keys, n):
            return pa.record_batch({"code": pa.array(keys.astype(np.int64)), "n": pa.array(n.astype(np.int64))})

        for batch in batches:
            texts, training = as_bytes(batch["text"]), batch["training"].to_pylist()
            for low, high in chunks(texts):
                for one in (1, 0):
                    code, _, ends = _codes([spelled(texts[i]) for i in range(low, high) if bool(training[i]) == one], depth)
                    real = np.ones(len(code), bool)
                    real[(ends[:-1, None] + np.arange(depth)).ravel()] = False
                    keys, n = np.unique(code[real], return_counts=True)
                    held.append((keys, n * one))
                    size += len(keys)
                if size > HELD_CODES:
                    held = [combined()]
                    size = len(held[0][0])
                    if size > HELD_CODES // 2:
                        yield sent(*held[0])
                        held, size = [], 0
        if size:
            yield sent(*combined())

    # A task has combined its own codes already, so they are dealt out before Spark combines them.
    return (docs.select("text", "training").mapInArrow(released(counted), "code bigint, n bigint").repartition("code")
                    .groupBy("code").agg(F.sum("n").alias("n")))


def tree_nodes(counts: DataFrame, depth: int = DEPTH, nodes: int | None = None) -> DataFrame:
    """The nodes: depth, key (context bytes, then the bits so far behind a 1) and both counts.

    All of them, unless a caller wants a smaller tree: then those that training came to ``total / nodes`` times.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(1, -(-total // nodes)) if nodes else 1

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depths, contexts, pairs = batch["depth"], batch["context"], batch["pairs"]
            rows = np.repeat(np.arange(batch.num_rows), np.diff(pairs.offsets.to_numpy()))
            symbols = np.zeros((batch.num_rows, 256), np.int64)
            flat = pairs.flatten()
            symbols[rows, flat.field("symbol").to_numpy()] = flat.field("n").to_numpy()
            for level in range(8):
                both = symbols.reshape(batch.num_rows, 1 << level, 2, -1).sum(3)
                row, prefix = np.nonzero(both.sum(2) >= least)
                key = (contexts.to_numpy()[row] << 8) | (prefix + (1 << level))
                yield pa.record_batch({"depth": depths.take(pa.array(row)), "key": pa.array(key),
                                       "n0": pa.array(both[row, prefix, 0]), "n1": pa.array(both[row, prefix, 1])})

    masks = F.array(*[F.lit((1 << 8 * d) - 1).cast("bigint") for d in range(depth + 1)])
    pairs = (counts.select(F.posexplode(masks).alias("depth", "mask"), "code", "n")
             .select("depth", F.shiftright("code", 8).bitwiseAND(F.col("mask")).alias("context"),
                     F.col("code").bitwiseAND(255).alias("symbol"), "n")
             .groupBy("depth", "context", "symbol").agg(F.sum("n").alias("n"))
             .groupBy("depth", "context").agg(F.collect_list(F.struct("symbol", "n")).alias("pairs"), F.sum("n").alias("n"))
             .filter(F.col("n") >= least).drop("n"))
    return pairs.mapInArrow(split, "depth int, key bigint, n0 bigint, n1 bigint")


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series, after six steps up; good to 1e-12 for x >= 0.5."""
    steps = np.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5))
    y = x + 6
    return ((y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi)
            + (1 / 12 - (1 / 360 - 1 / 1260 / y**2) / y**2) / y - steps)


def _log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - math.log(math.pi) - _log_gamma(n0 + n1 + 1.0)


class ContextTree:
    """Per depth the sorted keys of the kept nodes, and the chance of a 1 where no deeper node is kept.

    A subtree begins at depth ``top`` with ``entry``: what the depths above add to each of its nodes there, in
    the order of their keys, and the weight that is left. A tree that goes on below ``depth`` has the ``weighted``
    log-probabilities of the nodes there, and gives their subtrees' :attr:`entry`.
    """

    def __init__(self, depths: np.ndarray, keys: np.ndarray, n0: np.ndarray, n1: np.ndarray, depth: int = DEPTH,
                 top: int = 0, weighted: np.ndarray | None = None):
        self.depth, self.top = depth, top
        levels = []
        for d in range(top, depth + 1):
            at = np.flatnonzero(depths == d)
            at = at[np.argsort(keys[at])]
            levels.append([keys[at], n0[at].astype(float), n1[at].astype(float)])
        self.keys = [x[0] for x in levels]
        self._levels = levels
        self._parents = parents = [None] + [np.searchsorted(self.keys[i - 1], self._cut(self.keys[i], top + i - 1))
                                            for i in range(1, len(levels))]
        # From the leaves up: the log-probability of a node's data, mixed over depths.
        own = [_log_kt(a, b) for _, a, b in levels]
        self._rest, self._stop = [None] * (depth - top), [None] * (depth - top)
        weighted = own[-1] if weighted is None else weighted[at]
        for d in reversed(range(depth - top)):
            _, a, b = levels[d]
            up = parents[d + 1]
            ra, rb = (np.maximum(x - np.bincount(up, y, len(x)), 0) for x, y in zip((a, b), levels[d + 1][1:]))
            below = np.bincount(up, weighted, len(a)) + _log_kt(ra, rb)
            weighted = np.logaddexp(own[d], below) - math.log(2)
            self._stop[d] = np.exp(own[d] - math.log(2) - weighted)
            self._rest[d] = (rb + 0.5) / (ra + rb + 1)
        self.weighted = weighted
        if not top:
            self.enter(np.zeros(len(self.keys[0])), np.ones(len(self.keys[0])))

    def enter(self, above: np.ndarray, left: np.ndarray) -> None:
        """From the root down: what the depths above add, and the weight that is left."""
        self.ones = []
        for d, (_, a, b) in enumerate(self._levels):
            here = (b + 0.5) / (a + b + 1)
            if d == len(self._levels) - 1:
                self.ones.append(above + left * here)
            else:
                stop, up = self._stop[d], self._parents[d + 1]
                self.ones.append(above + left * (stop * here + (1 - stop) * self._rest[d]))
                above, left = (above + left * stop * here)[up], (left * (1 - stop))[up]
        self.entry = above, left
        del self._levels, self._parents, self._stop, self._rest

    def below(self, top: ContextTree) -> ContextTree:
        """This subtree entered from ``top``, whose nodes stand for the contexts that are not in it."""
        at = np.searchsorted(top.keys[-1], self.keys[0])
        self.enter(*(x[at] for x in top.entry))
        self.keys, self.ones = top.keys[:-1] + self.keys, top.ones[:-1] + self.ones
        return self

    def roots(self) -> list[np.ndarray]:
        """Keys, counts and weighted log-probabilities of the nodes at ``top``."""
        return [*self._levels[0], self.weighted]

    @staticmethod
    def _cut(keys: np.ndarray, depth: int) -> np.ndarray:
        """The node of the same bits ``depth`` bytes deep."""
        return (keys >> 8 & (1 << 8 * depth) - 1) << 8 | keys & 255

    def __getstate__(self) -> dict:
        return {k: v for k, v in vars(self).items() if k != "_table"}

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """Log-probability of the last byte of each code after the bytes before it."""
        if not hasattr(self, "_table"):
            self._table = _Table(np.concatenate([k | d << 56 for d, k in enumerate(self.keys)]), np.concatenate(self.ones))
        context, symbol = (codes >> np.uint64(8)).astype(np.int64), (codes & np.uint64(255)).astype(np.int64)
        out = np.zeros(len(codes))
        deepest = np.full(len(codes), self.depth)
        for k in range(8):
            prefix, bit = (1 << k) | (symbol >> (8 - k)), symbol >> (7 - k) & 1
            ones = np.full(len(codes), 0.5)
            open_ = np.arange(len(codes))
            for d in reversed(range(self.depth + 1)):
                reach = deepest[open_] >= d
                mine = open_[reach]
                value = self._table.get((context[mine] & (1 << 8 * d) - 1) << 8 | prefix[mine] | d << 56)
                found = ~np.isnan(value)
                ones[mine[found]] = value[found]
                # More bits of the same byte have no deeper node.
                deepest[mine[~found]] = d - 1
                open_ = np.concatenate([open_[~reach], mine[~found]])
                if not len(open_):
                    break
            out += np.log10(np.where(bit == 1, ones, 1 - ones))
        return out


class _Table:
    """Numbers by distinct keys of at least 0, found by linear probing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(5 * len(keys) // 2).bit_length())
        # A key and its value stand together, so that a look at both is one place of memory.
        self.cells = np.empty(1 << self.bits, _CELL)
        self.cells["key"], self.cells["value"] = -1, np.nan
        slot = self._slot(keys)
        while len(keys):
            new, first = np.unique(slot, return_index=True)
            first = first[self.cells["key"][new] < 0]
            self.cells["key"][slot[first]], self.cells["value"][slot[first]] = keys[first], values[first]
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, values, slot = keys[rest], values[rest], (slot[rest] + 1) & (1 << self.bits) - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys.astype(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, NaN where there is none."""
        out = np.empty(len(keys))
        for low in range(0, len(keys), LOOKED_UP):
            self._get(keys[low:low + LOOKED_UP], out[low:low + LOOKED_UP])
        return out

    def _get(self, keys: np.ndarray, out: np.ndarray) -> None:
        wide = self.cells.view(np.complex128)  # numpy takes these faster than records
        slot = self._slot(keys)
        cell = wide[slot].view(_CELL)
        there = cell["key"]
        out[:] = cell["value"]
        open_ = np.flatnonzero(there != keys)
        out[open_] = np.nan
        open_ = open_[there[open_] >= 0]
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (1 << self.bits) - 1
            cell = wide[slot[open_]].view(_CELL)
            there = cell["key"]
            hit = there == keys[open_]
            out[open_[hit]] = cell["value"][hit]
            open_ = open_[~hit & (there >= 0)]


class _Values:
    """Codes and their values as they travel; a worker makes its table of them once."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        self.codes, self.values = codes, values

    def table(self) -> _Table:
        if not hasattr(self, "_table"):
            self._table = _Table(self.codes, self.values)
        return self._table


class Scorer:
    """Remembers the log-probabilities of the codes it met, one per slot."""

    def __init__(self, tree: ContextTree):
        self.tree = tree
        self.keys = np.full(1 << CACHE_BITS, np.uint64(2**64 - 1))
        self.values = np.zeros(1 << CACHE_BITS)

    def score(self, texts: list[bytes]) -> np.ndarray:
        code, begins, ends = _codes(texts, self.tree.depth)
        slot = (mixed(code) >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
        value = self.values[slot]
        missed = np.flatnonzero(self.keys[slot] != code)
        new, place = np.unique(code[missed], return_inverse=True)
        found = self.tree.log10(new)
        value[missed] = found[place]
        at = (mixed(new) >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
        self.keys[at] = new
        # Two new codes of one slot: the later key stands, so its value must too.
        self.values[at] = found
        return np.add.reduceat(np.append(value, 0.0), np.stack([begins, ends], 1).ravel())[::2]


def fit(training: DataFrame, depth: int = DEPTH, nodes: int | None = None) -> ContextTree:
    """The tree of ``training`` (text) as one object in the driver, for small texts; ``nodes`` makes it smaller."""
    counts = count_contexts(training.select("text", F.lit(True).alias("training")), depth)
    kept = tree_nodes(written(counts, "contexts"), depth, nodes).toArrow()
    columns = [kept[n].to_numpy() for n in ("depth", "key", "n0", "n1")]
    return ContextTree(*columns, depth=depth)


def _subtree(codes: np.ndarray, n: np.ndarray, depth: int, top: int) -> ContextTree:
    """The nodes below ``top`` of codes with all their counts."""
    known = n > 0
    pairs, n = codes[known], n[known]
    parts = []
    for d in reversed(range(top, depth + 1)):
        pairs = pairs & (1 << 8 * d + 8) - 1
        order = np.argsort(pairs, kind="stable")
        pairs, n = pairs[order], n[order]
        first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])[:len(pairs)])
        if len(first):
            pairs, n = pairs[first], np.add.reduceat(n, first)
        for k in range(8):
            key = pairs >> 8 << 8 | 1 << k | (pairs & 255) >> 8 - k
            begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
            if len(begin):
                ones = np.add.reduceat(np.where(pairs >> 7 - k & 1, n, 0), begin)
                parts.append((np.full(len(begin), d), key[begin], np.add.reduceat(n, begin) - ones, ones))
    empty = (np.zeros(0, np.int64),) * 4
    return ContextTree(*map(np.concatenate, zip(empty, *parts)), depth=depth, top=top)


def _whole(batches: Iterator[pa.RecordBatch], top: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes and counts in runs that end where the ``top`` nearest bytes change."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size, limit = 0, SUBTREE_CODES
    for batch in batches:
        held.append((batch["code"].to_numpy(), batch["n"].to_numpy()))
        size += batch.num_rows
        if size > limit:
            code, n = (np.concatenate(x) for x in zip(*held))
            near = code >> 8 & (1 << 8 * top) - 1
            cut = int(np.searchsorted(near, near[-1]))
            if cut:
                yield code[:cut], n[:cut]
            held, size = [(code[cut:], n[cut:])], len(code) - cut
            limit = max(SUBTREE_CODES, 2 * size)
    if size:
        yield tuple(np.concatenate(x) for x in zip(*held))


def code_values(counts: DataFrame, depth: int = DEPTH, top: int = TOP) -> DataFrame:
    """(code, n, value): the log10 probability of the byte of each code of ``counts`` (code, n) after the bytes before it."""
    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, n in _whole(batches, top):
            key, n0, n1, weighted = _subtree(code, n, depth, top).roots()
            yield pa.record_batch({"key": pa.array(key), "n0": pa.array(n0), "n1": pa.array(n1), "weighted": pa.array(weighted)})

    def valued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, n in _whole(batches, top):
            value = _subtree(code, n, depth, top).below(shared.value).log10(code.view(np.uint64))
            yield pa.record_batch({"code": pa.array(code), "n": pa.array(n), "value": pa.array(value)})

    near = F.shiftright("code", 8).bitwiseAND((1 << 8 * top) - 1)
    dealt = counts.withColumn("near", near).repartition("near").sortWithinPartitions("near").select("code", "n")
    found = dealt.mapInArrow(released(roots), "key bigint, n0 double, n1 double, weighted double").toArrow()
    key, n0, n1, weighted = (found[n].to_numpy() for n in ("key", "n0", "n1", "weighted"))
    parts = [(np.full(len(key), top), key, n0, n1)]
    for d in range(top):
        own, at = np.unique(ContextTree._cut(key, d), return_inverse=True)
        parts.append((np.full(len(own), d), own, np.bincount(at, n0, len(own)), np.bincount(at, n1, len(own))))
    upper = ContextTree(*map(np.concatenate, zip(*parts)), depth=top,
                        weighted=np.append(weighted, np.zeros(sum(len(x[0]) for x in parts) - len(key))))
    shared = counts.sparkSession.sparkContext.broadcast(upper)
    return dealt.mapInArrow(released(valued), "code bigint, n bigint, value double")


def _frequent(values: DataFrame, most: int) -> tuple[_Values, DataFrame]:
    """The values of the most frequent codes, at most ``most``; the rows of all others."""
    rank = F.floor(F.log2(F.col("n") + 1) * 8).cast("int")
    bar, size = 0, 0
    for row in values.groupBy(rank.alias("rank")).count().orderBy(F.desc("rank")).collect():
        size += row["count"]
        if size > most:
            bar = row["rank"] + 1
            break
    kept = values.filter(rank >= bar).select("code", "value").toArrow()
    return _Values(kept["code"].to_numpy(), kept["value"].to_numpy()), values.filter(rank < bar).select("code", "value")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"did": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)), "th": F.xxhash64("text")})


def code_lengths(docs: DataFrame, values: DataFrame, frequent: int | None = None) -> DataFrame:
    """did, th (keys of id and text), n_bytes, n_tokens and ``score``, the log10 probability, of each row.

    ``values`` (code, n, value) has every code of ``docs``. ``frequent`` of them go to every task.
    """
    known, others = _frequent(values, FREQUENT if frequent is None else frequent)
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, table = TaskContext.get().partitionId() << 33, shared.value.table()
        for batch in batches:
            texts = as_bytes(batch["text"])
            for low, high in chunks(texts):
                spelt = [spelled(t) for t in texts[low:high]]
                code, begins, ends = _codes(spelt, DEPTH)
                code = code.view(np.int64)
                value = table.get(code)
                rare = np.flatnonzero(np.isnan(value))
                value[rare] = 0
                bounds = np.stack([begins, ends], 1).ravel()
                # Not those between texts.
                rare = rare[rare >= begins[np.searchsorted(ends, rare, "right")]]
                yield pa.record_batch({
                    "row": pa.array(np.arange(number, number + high - low)),
                    "did": batch["did"].slice(low, high - low), "th": batch["th"].slice(low, high - low),
                    "n_bytes": pa.array([len(t) for t in spelt], pa.int64()),
                    "n_tokens": pa.array([t.count(b" ") + (len(t) > 1) + 1 for t in spelt], pa.int64()),
                    "score": pa.array(np.add.reduceat(np.append(value, 0.0), bounds)[::2]),
                    "others": lists(code[rare], np.searchsorted(rare, ends), pa.int64())})
                number += high - low

    rows = written(_keyed(docs).select("did", "th", "text").mapInArrow(
        released(scored), "row bigint, did bigint, th bigint, n_bytes bigint, n_tokens bigint, score double, others array<bigint>"),
        "scored")
    added = (rows.select("row", F.explode("others").alias("code")).join(others, "code")
                 .groupBy("row").agg(F.sum("value").alias("added")))
    return (rows.drop("others").join(added, "row", "left")
                .withColumn("score", F.col("score") + F.coalesce("added", F.lit(0.0))).drop("row", "added"))


def word_sums(docs: DataFrame) -> tuple[DataFrame, int]:
    """Sum of log10(c + 1) and number of known tokens per (did, th); the number of distinct training tokens.

    ``docs`` has doc_id, text and ``training``.
    """
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            texts = as_bytes(batch["text"])
            keys = np.empty(batch.num_rows, _DOC)
            keys["did"], keys["th"] = batch["did"].to_numpy(), batch["th"].to_numpy()
            training = batch["training"].to_numpy(zero_copy_only=False)
            for low, high in chunks(texts, BLOCK_BYTES):
                # Arrow numbers the words; the end token has the number behind the last.
                split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts[low:high], pa.binary()).cast(pa.string())))
                coded = split.flatten().dictionary_encode()
                names = coded.dictionary.cast(pa.binary()).to_pylist()
                # Words and their documents as one number, sorted in place: few arrays of a number a word at a time.
                at = np.repeat(np.arange(high - low), np.diff(split.offsets.to_numpy()))
                at += coded.indices.to_numpy() * np.int64(high - low)
                if b"" in names:  # before the first and behind the last white space
                    at = at[coded.indices.to_numpy() != names.index(b"")]
                del split, coded
                at = np.append(at, np.arange(high - low) + len(names) * (high - low))
                at.sort()
                pair = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                posts = np.empty(len(pair), _POST)
                posts["n"] = np.diff(np.append(pair, len(at)))
                word, posts["doc"] = np.divmod(at[pair], high - low)
                del at, pair
                first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
                named = np.array([xxhash.xxh3_64_intdigest(w) for w in [*names, END]], np.uint64)[word[first]]
                own = keys[low:high]
                number += 1
                block = xxhash.xxh3_64_intdigest(f"{TaskContext.get().partitionId()} {number}") - 2**63
                learned = np.add.reduceat(np.where(training[low:high][posts["doc"]], posts["n"], 0).astype(np.int64), first)
                raw, ends = posts.tobytes(), np.append(first[1:], len(posts))
                yield pa.record_batch({
                    "word": pa.array(np.append(named.view(np.int64), block)),
                    "block": pa.array(np.full(len(first) + 1, block)), "n": pa.array(np.append(learned, -1)),
                    "posts": pa.array([raw[8 * a:8 * b] for a, b in zip(first.tolist(), ends.tolist())] + [own.tobytes()],
                                      pa.binary())})

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What this task's words add to the documents of each block; a block's list of documents; the words' number."""
        held: dict[int, list[np.ndarray]] = {}
        distinct = 0

        def sent(block: int) -> pa.RecordBatch:
            rows = np.concatenate(held.pop(block))
            doc, at = np.unique(rows["doc"], return_inverse=True)
            out = np.empty(len(doc), _SUM)
            out["doc"], out["add"], out["known"] = doc, np.bincount(at, rows["add"]), np.bincount(at, rows["known"])
            return pa.record_batch({"block": pa.array([block], pa.int64()), "sums": pa.array([out.tobytes()], pa.binary()),
                                    "docs": pa.nulls(1, pa.binary()), "distinct": pa.array([0], pa.int64())})

        size = 0
        for batch in batches:
            c, here, block = (batch[n].to_numpy() for n in ("c", "n", "block"))
            distinct += int(((batch["place"].to_numpy() == 1) & (c > 0) & (here >= 0)).sum())
            word = here >= 0
            posts = np.array(batch["posts"].to_pylist(), object)
            lists = np.flatnonzero(~word)
            yield pa.record_batch({"block": pa.array(block[lists]), "sums": pa.nulls(len(lists), pa.binary()),
                                   "docs": pa.array(posts[lists].tolist(), pa.binary()),
                                   "distinct": pa.array(np.zeros(len(lists), np.int64))})
            order = np.flatnonzero(word)
            order = order[np.argsort(block[order], kind="stable")]
            posts = posts[order]
            times = np.fromiter(map(len, posts), np.int64, len(posts)) // _POST.itemsize
            flat = np.frombuffer(b"".join(posts), _POST)
            rows = np.empty(len(flat), _SUM)
            many = np.repeat(c[order], times)
            rows["doc"], rows["add"], rows["known"] = flat["doc"], flat["n"] * np.log10(many + 1.0), flat["n"] * (many > 0)
            own = np.repeat(block[order], times)
            cuts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else []
            for a, b in zip(cuts, [*cuts[1:], len(own)]):
                held.setdefault(int(own[a]), []).append(rows[a:b])
            size += len(rows)
            if size > HELD:
                for key in list(held):
                    yield sent(key)
                size = 0
        for key in list(held):
            yield sent(key)
        yield pa.record_batch({"block": pa.array([None], pa.int64()), "sums": pa.nulls(1, pa.binary()),
                               "docs": pa.nulls(1, pa.binary()), "distinct": pa.array([distinct], pa.int64())})

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of a block, which come one after the other, added up per document."""
        block, add, known, docs = None, np.zeros(0), np.zeros(0, np.int64), None

        def row() -> pa.RecordBatch:
            return pa.record_batch({"did": pa.array(docs["did"].copy()), "th": pa.array(docs["th"].copy()),
                                    "add": pa.array(add[:len(docs)]), "known": pa.array(known[:len(docs)])})

        for batch in batches:
            for key, sums, listed in zip(*(batch[n].to_pylist() for n in ("block", "sums", "docs"))):
                if key != block:
                    if docs is not None:
                        yield row()
                    block, add, known, docs = key, np.zeros(0), np.zeros(0, np.int64), None
                if listed is not None:
                    docs = np.frombuffer(listed, _DOC)
                    more = len(docs)
                else:
                    rows = np.frombuffer(sums, _SUM)
                    more = int(rows["doc"].max()) + 1
                if more > len(add):
                    add, known = np.append(add, np.zeros(more - len(add))), np.append(known, np.zeros(more - len(known), np.int64))
                if listed is None:
                    add[rows["doc"]] += rows["add"]
                    known[rows["doc"]] += rows["known"]
        if docs is not None:
            yield row()

    same = Window.partitionBy("word")
    met = (_keyed(docs).select("did", "th", "text", "training")
           .mapInArrow(released(blocks), "word bigint, block bigint, n bigint, posts binary")
           .withColumns({"c": F.sum(F.greatest("n", F.lit(0))).over(same),
                         "place": F.row_number().over(same.orderBy("block"))}))
    parts = written(met.mapInArrow(released(sums), "block bigint, sums binary, docs binary, distinct bigint"), "words")
    distinct = parts.agg(F.sum("distinct")).first()[0] or 0
    rows = (parts.filter("block IS NOT NULL").select("block", "sums", "docs").repartition("block")
                 .sortWithinPartitions("block").mapInArrow(joined, "did bigint, th bigint, add double, known bigint"))
    # Rows of equal id and text have equal sums, whichever of them stays.
    return rows.dropDuplicates(["did", "th"]), distinct


def score(docs: DataFrame, training: str) -> DataFrame:
    """Both scores of every row of ``docs`` (doc_id, text); ``training`` is a condition on doc_id."""
    docs = docs.select("doc_id", "text")
    marked = docs.withColumn("training", F.coalesce(F.expr(training), F.lit(False)))
    values = written(code_values(written(count_contexts(marked), "contexts")), "values")
    lengths = written(code_lengths(docs, values), "lengths")
    sums, distinct = word_sums(marked)
    doc_id = F.nullif("did", F.lit(_NO_ID))
    lengths = lengths.withColumn("doc_id", doc_id).withColumn("training", F.coalesce(F.expr(training), F.lit(False)))
    total = lengths.filter("training").agg(F.sum("n_tokens")).first()[0] or 0
    return lengths.join(sums, ["did", "th"]).select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", F.col("known").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("add") - F.col("n_tokens") * F.lit(math.log10(total + distinct + 1))).alias("base_score"),
        "score", "n_bytes")
