"""Operator 11: ranked lexical search, best first over document intervals that range maxima bound.

``build_index`` takes documents apart into segments of some megabytes of text, a
row each: the documents that have terms, in ascending id, and for every term its
posting list (documents and occurrences), packed. ``search`` opens a segment for a block
of items. Every posting of an item's terms gets its impact, and a sparse table
over the list gives the largest impact between any two places in two look-ups.
The sum of an item's range maxima bounds the score of every document of an
interval. The intervals with the highest bounds are opened first: the document
with the largest single contribution is scored, and the rest of the interval
falls apart at it into two, which get bounds of their own from the same tables.
An item is done with a segment when no interval's bound can beat its k-th
document; a task carries those from segment to segment. Nothing is estimated or
left out: what remains unopened cannot reach the result.

Intervals of many items are opened together, ``AT_ONCE`` of each item, so that
the work runs in numpy; ``ENTRIES`` terms of items at a time, so that a task's
memory does not follow the size of a block. An interval keeps, for every term that still has
postings in it, where they begin and end in the list.

Documents, terms and lengths are counted over all segments, and document
frequencies for the terms that items have. The items are the query set: they
come in blocks of ``BLOCK_BYTES`` of text, each a pass over the index, so that
neither driver nor task holds more than a block. A task sends at most k rows an
item to the last step, which ranks them.

Rows: a null or empty text, and one without a term, is no document and is never
found; items without a term find nothing; item rows with equal ids are one item
with all their terms; a null item id is an id of its own. Equal scores rank by
ascending id, null ids last; rows that repeat are documents that repeat. A very
long text is a segment of its own. Other columns are ignored. Empty tables on
either side give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidemark.llm.common import ranged, released, small_batches, written

SEGMENT_BYTES = 8 << 20
BLOCK_BYTES = 4 << 20
#: The Parquet writer looks at its size after every row, as a segment is a large one: it holds a hundred before it
#: looks otherwise, and the reader takes all rows of a row group at once.
ROW_GROUPS = {"parquet.block.size": SEGMENT_BYTES, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}
#: Intervals of one item that are opened together.
AT_ONCE = 16
#: Terms of items that are searched together; each has up to ``2 * AT_ONCE`` entries made at a time, and more that wait.
ENTRIES = 1 << 13
#: Constants of the score: the impact's numerator, and the factors of occurrences and of length.
TOP, OCCURRENCES, LENGTH = 1_000_000_000, 1_000, 8
#: Percent of the length that counts relative to the mean.
RELATIVE = 75

#: A segment: its documents and their terms counted, and three packed tables of arrays: ``terms, ends`` (where each
#: term's list ends), ``doc_ids, lengths`` of the documents, and ``places, counts`` of the lists, one after the other.
INDEX = "n_docs bigint, n_terms bigint, vocabulary binary, documents binary, postings binary"

_KEPT = bytes(range(48, 58)) + bytes(range(97, 123)) + bytes(range(128, 256))
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c in _KEPT else 32 for c in range(256))
_LAST = np.iinfo(np.int64).max


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters (lower-cased), digits and non-ASCII characters."""
    return text.translate(_TERMS).split()


class _Codes(dict):
    def __missing__(self, term: bytes) -> int:
        value = self[term] = len(self)
        return value

    def of(self, terms: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, terms), np.int64, len(terms))


def _packed(**columns: pa.Array) -> pa.Array:
    """Equally long arrays as one compressed value: Spark's rows and readers take many times the room of long lists."""
    table, sink = pa.record_batch(columns), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(table)
    return pa.array([sink.getvalue().to_pybytes()], pa.binary())


def _unpacked(value: pa.Scalar) -> list[pa.Array]:
    with pa.ipc.open_stream(value.as_buffer()) as stream:
        return stream.read_next_batch().columns


def _segment(ids: np.ndarray, known: np.ndarray, texts: list[bytes]) -> pa.RecordBatch | None:
    codes = _Codes()
    own = [codes.of(terms_of(t)) for t in texts]
    lengths = np.fromiter(map(len, own), np.int64, len(own))
    # Ascending ids, those that are null last; documents without terms go.
    order = np.lexsort((ids, ~known))
    order = order[lengths[order] > 0]
    if not len(order):
        return None
    code = np.concatenate([own[i] for i in order.tolist()])
    del own
    place = np.repeat(np.arange(len(order)), lengths[order])
    code, place = np.divmod(np.sort(code * len(order) + place), len(order))
    first = np.flatnonzero(np.concatenate([[True], (np.diff(code) != 0) | (np.diff(place) != 0)]))
    ends = np.searchsorted(code[first], np.arange(len(codes)), side="right")
    return pa.record_batch({
        "n_docs": pa.array([len(order)], pa.int64()), "n_terms": pa.array([len(code)], pa.int64()),
        "vocabulary": _packed(terms=pa.array(list(codes), pa.binary()).cast(pa.string()), ends=pa.array(ends.astype(np.int64))),
        "documents": _packed(doc_ids=pa.array(ids[order], pa.int64(), mask=~known[order]), lengths=pa.array(lengths[order])),
        "postings": _packed(places=pa.array(place[first].astype(np.int32)),
                            counts=pa.array(np.diff(np.append(first, len(code))).astype(np.int32)))})


def build_index(docs: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The posting lists of ``docs`` (doc_id, text), a row per segment, written to the shared folder."""
    @released
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, known, texts, size = [], [], [], 0
        for batch in batches:
            column = batch["doc_id"]
            there = column.is_valid().to_numpy(zero_copy_only=False)
            number = column.fill_null(_LAST).to_numpy(zero_copy_only=False)
            for low, high, own in ranged(batch["text"], segment_bytes):
                more = sum(map(len, own))
                if texts and size + more > segment_bytes:
                    if (row := _segment(np.concatenate(ids), np.concatenate(known), texts)) is not None:
                        yield row
                    ids, known, texts, size = [], [], [], 0
                ids.append(number[low:high])
                known.append(there[low:high])
                texts += own
                size += more
        if texts and (row := _segment(np.concatenate(ids), np.concatenate(known), texts)) is not None:
            yield row

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    with small_batches(docs.sparkSession):
        return written(texts.mapInArrow(segments, INDEX), "postings", **ROW_GROUPS)


class Block:
    """The terms of a block of items: a vocabulary, and each item's terms with their repeats."""

    def __init__(self, items: dict):
        self.ids = list(items)
        codes = _Codes()
        terms, repeats, sizes = [], [], []
        for texts in items.values():
            own, n = np.unique(np.fromiter((codes[w] for t in texts for w in terms_of(t)), np.int64), return_counts=True)
            terms.append(own)
            repeats.append(n)
            sizes.append(len(own))
        self.vocabulary = [w.decode() for w in codes]
        self.terms = np.concatenate([*terms, np.zeros(0, np.int64)])
        self.repeats = np.concatenate([*repeats, np.zeros(0, np.int64)])
        self.ends = np.cumsum(sizes, dtype=np.int64)


def _blocks(items: DataFrame, limit: int) -> Iterator[Block]:
    held, size, before = {}, 0, ()
    for r in items.select("item_id", F.col("text").cast("string").alias("text")).orderBy("item_id").toLocalIterator():
        text = (r.text or "").encode()
        if held and r.item_id != before and size + len(text) > limit:
            yield Block(held)
            held, size = {}, 0
        held.setdefault(r.item_id, []).append(text)
        size, before = size + len(text), r.item_id
    if held:
        yield Block(held)


def _frequencies(index: DataFrame, block: Block) -> np.ndarray:
    """Documents that hold each term of the block, summed over the segments."""
    vocabulary = block.vocabulary

    @released
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for packed in batch["vocabulary"]:
                terms, ends = _unpacked(packed)
                at = _lists(terms, vocabulary)
                sizes = np.diff(ends.to_numpy(), prepend=0)
                total[at >= 0] += sizes[at[at >= 0]]
        here = np.flatnonzero(total)
        yield pa.record_batch({"term": pa.array(here, pa.int64()), "df": pa.array(total[here], pa.int64())})

    df = np.zeros(len(vocabulary), np.int64)
    counted = index.select("vocabulary").mapInArrow(found, "term bigint, df bigint").groupBy("term").agg(F.sum("df"))
    with small_batches(index.sparkSession):
        for r in counted.collect():
            df[r[0]] = r[1]
    return df


def _lists(terms: pa.Array, vocabulary: list[str]) -> np.ndarray:
    """Where each term of the vocabulary stands among ``terms``, or -1."""
    at = pc.index_in(pa.array(vocabulary, pa.string()), value_set=terms)
    return at.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices of all runs ``[start, start + size)``, one after the other."""
    total = int(sizes.sum())
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(total)


def impacts(counts: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What ``counts`` occurrences in documents of ``lengths`` terms are worth, before the term's weight."""
    if RELATIVE * int(lengths.max(initial=0)) * n_docs < 2**63:
        m = RELATIVE * lengths * n_docs // n_terms
    else:  # the product leaves 64 bits, the quotient does not
        m = np.array([RELATIVE * n * n_docs // n_terms for n in lengths.tolist()], np.int64)
    return TOP * counts // (OCCURRENCES * counts + LENGTH * (100 - RELATIVE + m))


class Postings:
    """The posting lists of one segment for a block's terms: impacts, and sparse tables of their maxima."""

    def __init__(self, places: np.ndarray, values: np.ndarray, sizes: np.ndarray):
        """Lists one after the other, longest first, so that a level of the tables is a prefix of them all."""
        self.places, self.values = places, values
        self.starts = np.cumsum(sizes) - sizes
        self.keys = np.repeat(np.arange(len(sizes)) << 32, sizes) + places
        levels, width = [np.arange(len(places), dtype=np.int32)], 1
        while 2 * width <= (sizes[0] if len(sizes) else 0):
            below = levels[-1]
            reach = int(sizes[sizes >= 2 * width].sum())
            # The last entries of a list reach into the next one; no look-up uses them.
            left, right = below[:reach], below[np.minimum(np.arange(width, width + reach), len(below) - 1)]
            levels.append(np.where(values[left] >= values[right], left, right))
            width *= 2
        self.bases = np.cumsum([0, *map(len, levels)])
        self.table = np.concatenate(levels)

    def best(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The posting with the largest impact in each ``[low, high)``, none of them empty."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        base = self.bases[level]
        left, right = self.table[base + low], self.table[base + high - (1 << level)]
        return np.where(self.values[left] >= self.values[right], left, right)

    def reach(self, lists: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The first posting of each list at ``place`` or behind it."""
        return np.searchsorted(self.keys, (lists << 32) + place)


class Leaders:
    """The k best documents of every item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.scores = np.zeros((items, k), np.int64)
        self.ids = np.full((items, k), _LAST)

    def beaten_by(self, item: np.ndarray, score: np.ndarray, doc_id: np.ndarray) -> np.ndarray:
        """Whether a document of ``score`` and an id of ``doc_id`` at least could still enter."""
        last, last_id = self.scores[item, -1], self.ids[item, -1]
        return (score > last) | ((score == last) & (score > 0) & (doc_id < last_id))

    def add(self, item: np.ndarray, score: np.ndarray, doc_id: np.ndarray) -> None:
        rows = np.unique(item)
        item = np.concatenate([np.repeat(rows, self.k), item])
        score = np.concatenate([self.scores[rows].ravel(), score])
        doc_id = np.concatenate([self.ids[rows].ravel(), doc_id])
        order = np.lexsort((doc_id, -score, item))
        item, score, doc_id = item[order], score[order], doc_id[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        item, score, doc_id, rank = (x[rank < self.k] for x in (item, score, doc_id, rank))
        self.scores[item, rank], self.ids[item, rank] = score, doc_id


class Search:
    """Opens the intervals of one segment, best first, for all items of a block."""

    def __init__(self, postings: Postings, ids: np.ndarray, leaders: Leaders):
        self.postings, self.ids, self.leaders = postings, ids, leaders
        self.opened = 0

    def _bounded(self, item, first, lists, low, high, repeats, sizes):
        """Intervals from their entries: bound and split document; entries without postings and empty intervals go."""
        full = high > low
        owner = np.repeat(np.arange(len(sizes)), sizes)[full]
        lists, low, high, repeats = lists[full], low[full], high[full], repeats[full]
        sizes = np.bincount(owner, minlength=len(sizes))
        kept = sizes > 0
        item, first, sizes = item[kept], first[kept], sizes[kept]
        if not len(sizes):
            return item, first, first, first, lists, low, high, repeats, sizes
        starts = np.cumsum(sizes) - sizes
        best = self.postings.best(low, high)
        worth = self.postings.values[best] * repeats
        bound = np.add.reduceat(worth, starts)
        most = np.repeat(np.maximum.reduceat(worth, starts), sizes)
        split = np.minimum.reduceat(np.where(worth == most, self.postings.places[best], np.iinfo(np.int32).max), starts)
        # The interval's smallest document decides ties; its postings' smallest place is as good and closer.
        first = np.minimum.reduceat(self.postings.places[low], starts).astype(np.int64)
        return item, first, bound, split.astype(np.int64), lists, low, high, repeats, sizes

    def run(self, item, lists, low, high, repeats, sizes) -> None:
        pool = self._bounded(item, np.zeros(len(item), np.int64), lists, low, high, repeats, sizes)
        while True:
            item, first, bound, split, lists, low, high, repeats, sizes = pool
            open_ = self.leaders.beaten_by(item, bound, self.ids[first]) if len(item) else np.zeros(0, bool)
            if not open_.any():
                return
            starts = np.cumsum(sizes) - sizes
            # The AT_ONCE highest bounds of each item.
            order = np.flatnonzero(open_)
            order = order[np.lexsort((first[order], -bound[order], item[order]))]
            rank = np.arange(len(order)) - np.searchsorted(item[order], item[order])
            now, later = order[rank < AT_ONCE], order[rank >= AT_ONCE]
            self.opened += len(now)

            size, e = sizes[now], _ragged(starts[now], sizes[now])
            own, a, b, times = lists[e], low[e], high[e], repeats[e]
            p = self.postings.reach(own, np.repeat(split[now], size))
            hit = (p < b) & (self.postings.keys[np.minimum(p, len(self.postings.keys) - 1)]
                             == (own << 32) + np.repeat(split[now], size))
            worth = np.where(hit, self.postings.values[np.minimum(p, len(self.postings.keys) - 1)] * times, 0)
            score, doc_id = np.add.reduceat(worth, np.cumsum(size) - size), self.ids[split[now]]
            enters = self.leaders.beaten_by(item[now], score, doc_id)
            self.leaders.add(item[now][enters], score[enters], doc_id[enters])

            # What lies before and behind the document, and the intervals that wait.
            halves = self._bounded(np.tile(item[now], 2), np.tile(first[now], 2), np.tile(own, 2), np.concatenate([a, p + hit]),
                                   np.concatenate([p, b]), np.tile(times, 2), np.tile(size, 2))
            e = _ragged(starts[later], sizes[later])
            waits = item[later], first[later], bound[later], split[later], lists[e], low[e], high[e], repeats[e], sizes[later]
            pool = tuple(map(np.concatenate, zip(halves, waits)))


def _opened(segment, block: Block, weights: np.ndarray, n_docs: int, n_terms: int, leaders: Leaders) -> Search | None:
    """Search one segment (its arrays) for the block's items."""
    ids, known, lengths, terms, ends, places, counts = segment
    at = _lists(terms, block.vocabulary)
    at[weights <= 0] = -1
    sizes = np.diff(ends, prepend=0)
    here = np.flatnonzero(at >= 0)
    here = here[np.argsort(-sizes[at[here]], kind="stable")]
    if not len(here):
        return None
    size = sizes[at[here]]
    e = _ragged(ends[at[here]] - size, size)
    worth = impacts(counts[e].astype(np.int64), lengths[places[e]], n_docs, n_terms) * np.repeat(weights[here], size)
    postings = Postings(places[e].astype(np.int64), worth, size)
    # The entries of each item's first interval, which is the whole segment.
    number = np.full(len(block.vocabulary), -1)
    number[here] = np.arange(len(here))
    own = number[block.terms]
    item = np.repeat(np.arange(len(block.ids)), np.diff(block.ends, prepend=0))[own >= 0]
    repeats, own = block.repeats[own >= 0], own[own >= 0]
    items, per = np.unique(item, return_counts=True)
    search = Search(postings, np.where(known, ids, _LAST), leaders)
    ends, done = np.cumsum(per), 0
    while done < len(per):
        low = ends[done] - per[done]
        more = max(done + 1, int(np.searchsorted(ends, low + ENTRIES, side="right")))
        e, n = slice(low, ends[more - 1]), slice(done, more)
        starts = postings.starts[own[e]]
        search.run(items[n], own[e], starts, starts + size[own[e]], repeats[e], per[n])
        done = more
    return search


def _found(index: DataFrame, block: Block, k: int, n_docs: int, n_terms: int, kind) -> DataFrame:
    """The best k documents of each item and task."""
    df = _frequencies(index, block).astype(np.float64)
    weights = np.array([int(1000 * np.log(x)) for x in (2.0 * n_docs + 2) / (2 * df + 1)], np.int64)

    @released
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaders = Leaders(len(block.ids), k)
        for batch in batches:
            for packed in zip(batch["documents"], batch["vocabulary"], batch["postings"]):
                ids, *rest = (x for table in packed for x in _unpacked(table))
                arrays = [x if pa.types.is_string(x.type) else x.to_numpy() for x in rest]
                _opened((ids.fill_null(_LAST).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False), *arrays),
                        block, weights, n_docs, n_terms, leaders)
        item, rank = np.nonzero(leaders.scores)
        ids = leaders.ids[item, rank]
        yield pa.record_batch({"item": pa.array(item, pa.int64()), "doc_id": pa.array(ids, pa.int64(), mask=ids == _LAST),
                               "score": pa.array(leaders.scores[item, rank], pa.int64())})

    rows = index.select("documents", "vocabulary", "postings").mapInArrow(best, "item bigint, doc_id bigint, score bigint")
    ranks = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    rows = rows.withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") <= k)
    names = index.sparkSession.createDataFrame([(i, name) for i, name in enumerate(block.ids)],
                                               StructType([StructField("item", LongType()), StructField("item_id", kind)]))
    return rows.join(names, "item").select("item_id", "rank", "doc_id", "score")


def search(index: DataFrame, items: DataFrame, k: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's ``k`` best documents of an index."""
    kind = items.schema["item_id"].dataType
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    parts = []
    for block in _blocks(items, block_bytes):
        if n_docs and len(block.vocabulary):
            # A block's result is written before the next one is read, so that the driver holds one.
            found = _found(index, block, k, n_docs, n_terms, kind)
            with small_batches(index.sparkSession):
                parts.append(written(found, "found"))
    if not parts:
        return index.sparkSession.createDataFrame([], StructType([
            StructField("item_id", kind), StructField("rank", IntegerType()), StructField("doc_id", LongType()),
            StructField("score", LongType())]))
    return reduce(DataFrame.unionByName, parts)
