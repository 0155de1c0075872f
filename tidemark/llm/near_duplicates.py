"""Operator 2: near duplicates by Order MinHash, verified by banded alignment.

Words are lower-cased runs of letters and digits. A text's k-mers are its runs
of five words, each labelled by how often it occurred before in the text. A sketch
holds the two labelled k-mers with the smallest hashes, in the order in which
they stand; there are ``SKETCHES`` of them, each under a hash of its own. Two
texts that share a sketch share k-mers in the same order, which is what edit
similarity asks for and a set similarity does not.

Texts with one sketch in common form a bucket. In it every text is compared with
the one before it by length, and with the bucket's head, the text that shares
most buckets. That joins most of a bucket at two candidates per member. Large
buckets that are still of several classes get further heads as long as these
halve what is left. In the end every pair of a bucket whose texts are of different
classes and whose lengths allow a link is compared, in cells of some
``CELL_TEXTS`` texts a side that go to different tasks. A pair is a link where an alignment of their k-mers matches at least ``SIMILARITY``
of all: matched / (n + m - matched). No alignment that good leaves a diagonal
band whose width follows from the two lengths, so the alignment keeps to it and
loses nothing. Classes are the connected components of the links.

A pair at the threshold shares one given sketch with a chance of some 0.64, and
no sketch at all with less than 1e-5.

Equal texts are one text from the start. Texts of under five words have one
k-mer, all their words; texts without a word (null, empty, only punctuation) and
rows with a null id are classes of their own. Rows with equal ids are one
document; the first by text stands for it. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WordHashes, mixed, pieces, ranged, released, window_hashes, written
from tidemark.llm.components import components

WORDS, SIMILARITY = 5, 0.8
SKETCHES = 16
#: Texts on a side of a cell of pairs. Larger buckets get more heads before all their pairs are compared.
CELL_TEXTS = 256
#: Numbers of 64 bits in which the k-mers of a text are marked.
MARKS = 16
#: Further heads of a bucket in one round.
HEADS = 4

_LETTERS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.decode().lower().encode().translate(_LETTERS).split()


def _kmers(texts: list[bytes], hashes: WordHashes, k: int) -> list[np.ndarray]:
    """The k-mer hashes of each text, in order; a shorter text with words has one."""
    out = []
    words = [words_of(t) for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = hashes.of((w for ws in words for w in ws), int(sizes.sum()))
    for a, b in zip(np.cumsum(sizes) - sizes, np.cumsum(sizes)):
        own = flat[a:b]
        out.append(window_hashes(own, min(k, len(own))) if len(own) else own)
    return out


def sketches(kmers: list[np.ndarray], count: int = SKETCHES) -> np.ndarray:
    """``count`` Order MinHash values per text (each with at least one k-mer)."""
    sizes = np.fromiter(map(len, kmers), np.int64, len(kmers))
    flat, begins = np.concatenate(kmers), np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(kmers)), sizes)
    # Occurrence labels: the place of a k-mer among its equals within the text.
    order = np.lexsort((flat, doc))
    same = np.concatenate([[False], (flat[order][1:] == flat[order][:-1]) & (doc[order][1:] == doc[order][:-1])])
    at = np.arange(len(flat))
    label = np.empty(len(flat), np.uint64)
    label[order] = at - np.maximum.accumulate(np.where(same, 0, at))
    labelled = flat + label * np.uint64(0xD6E8FEB86659FD93)
    place = at - begins[doc]
    out = np.empty((len(kmers), count), np.uint64)
    for j in range(count):
        h = mixed(labelled, 2 * j + 1)
        first = np.minimum.reduceat(h, begins)
        where = np.flatnonzero(h == first[doc])
        p1 = np.zeros(len(kmers), np.int64)
        p1[doc[where]] = where
        h[p1] = np.uint64(2**64 - 1)
        second = np.minimum.reduceat(h, begins)
        where = np.flatnonzero(h == second[doc])
        p2 = p1.copy()
        p2[doc[where]] = where
        swap = place[p2] < place[p1]
        low, high = np.where(swap, p2, p1), np.where(swap, p1, p2)
        out[:, j] = mixed(labelled[low], j) * np.uint64(0x9E3779B97F4A7C15) + mixed(labelled[high], j)
    return out


def matched(a: np.ndarray, b: np.ndarray, least: int) -> int:
    """Length of the longest common subsequence of ``a`` and ``b``, or 0 if it is under ``least``.

    Only cells within the band that such an alignment cannot leave are used. A
    row of the alignment is one integer with a bit per cell.
    """
    if min(len(a), len(b)) < least:
        return 0
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - n:][::-1] != b[len(b) - n:][::-1])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    least = least - head - tail
    if least <= 0 and not (len(a) and len(b)):
        return head + tail
    if len(np.intersect1d(a, b)) == 0:
        return head + tail if least <= 0 else 0
    band = max(len(a), len(b)) - max(least, 0)
    where: dict[int, int] = {}
    for j, x in enumerate(b.tolist()):
        where[x] = where.get(x, 0) | 1 << j
    width, full = (1 << 2 * band + 1) - 1, (1 << len(b)) - 1
    row = full
    for i, x in enumerate(a.tolist()):
        hits = where.get(x, 0)
        if hits:
            hits &= width << (i - band) if i >= band else width >> (band - i)
            if hits:
                both = row & hits
                row = (row + both | row - both) & full
    found = len(b) - row.bit_count()
    return head + tail + found if found >= least else 0


def similar(a: np.ndarray, b: np.ndarray, threshold: float = SIMILARITY) -> bool:
    """Whether an alignment matches ``threshold`` of the k-mers of both."""
    least = int(np.ceil(threshold * (len(a) + len(b)) / (1 + threshold) - 1e-9))
    return matched(a, b, least) >= least


def _sketched(texts: DataFrame, k: int, count: int) -> DataFrame:
    """(band, sketch, id, th, n): one row per sketch of each text (id, th, text) with words."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            ids, th = batch["id"].to_numpy(), batch["th"].to_numpy()
            for low, high, values in ranged(batch["text"]):
                kmers = _kmers(values, hashes, k)
                some = [i for i, x in enumerate(kmers) if len(x)]
                if not some:
                    continue
                own = sketches([kmers[i] for i in some], count)
                yield pa.record_batch({
                    "band": pa.array(np.tile(np.arange(count, dtype=np.int32), len(some))),
                    "sketch": pa.array(own.ravel().view(np.int64)),
                    "id": pa.array(np.repeat(ids[low:high][some], count)),
                    "th": pa.array(np.repeat(th[low:high][some], count)),
                    "n": pa.array(np.repeat([len(kmers[i]) for i in some], count))})

    return texts.mapInArrow(released(sketch), "band int, sketch bigint, id bigint, th bigint, n bigint")


def _neighbours(shared: DataFrame) -> DataFrame:
    """Pairs (a, b) of each text of a bucket with the one before it by length.

    The rows are dealt by ranges of (band, sketch, n, id), which cuts a large
    bucket into many tasks. A task pairs what it holds and names the first and
    last text of the buckets at its ends, which may go on in other tasks; those
    few are paired in a second step.
    """
    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(a, b, edge) -> dict:
            return dict(zip(names, (*key, *a, *b, edge)))

        names = ("band", "sketch", "an", "a", "bn", "b", "edge")
        schema = pa.schema([("band", pa.int32()), *((x, pa.int64()) for x in names[1:6]), ("edge", pa.bool_())])
        key = head = last = None
        opening = True
        for batch in batches:
            out = []
            for band, sketch, n, i in zip(*(c.to_pylist() for c in batch.columns)):
                if (band, sketch) != key:
                    if opening and key is not None:
                        out.append(row(head, last, True))
                        opening = False
                    key, head = (band, sketch), (n, i)
                else:
                    out.append(row(last, (n, i), False))
                last = (n, i)
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if key is not None:
            yield pa.RecordBatch.from_pylist([row(head, last, True)], schema=schema)

    dealt = (shared.select("band", "sketch", "n", "id").repartitionByRange("band", "sketch", "n", "id")
                   .sortWithinPartitions("band", "sketch", "n", "id"))
    paired = written(dealt.mapInArrow(
        pair, "band int, sketch bigint, an bigint, a bigint, bn bigint, b bigint, edge boolean"), "pairs")
    bucket = Window.partitionBy("band", "sketch").orderBy("bn", "b")
    met = paired.filter("edge").withColumn("before", F.lag("b").over(bucket)).filter("before is not null")
    return paired.filter(~F.col("edge")).select("a", "b").union(met.select("a", F.col("before").alias("b")))


def _candidates(sketched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b), a < b: each text of a bucket with the one before it by length, and with the bucket's head;
    and the rows of the buckets.

    The head is the text that shares most buckets, weighed by their sizes: among
    copies of one text that were edited apart, that is the text they come from.
    Tables of buckets are written before they are joined, so that both sides of
    the join are plain shuffles, which Spark splits at a large bucket.
    """
    bucket = ["band", "sketch"]
    sizes = written(sketched.groupBy(*bucket).agg(F.count("*").alias("size")).filter("size > 1"), "buckets")
    shared = written(sketched.join(sizes, bucket), "shared")
    weight = shared.groupBy("id").agg(F.sum("size").alias("weight"))
    weighed = written(shared.select(*bucket, "id").join(weight, "id"), "weighed")
    heads = written(weighed.groupBy(*bucket).agg(F.max(F.struct("weight", (-F.col("id")).alias("i"))).alias("head")), "heads")
    headed = weighed.join(heads, bucket).select(F.col("id").alias("a"), (-F.col("head.i")).alias("b"))
    return (_neighbours(shared).union(headed)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()), shared


def _open(rooted: DataFrame) -> DataFrame:
    """The rows of the buckets whose texts are not all of one class, with their buckets' ``size``."""
    bucket = ["band", "sketch"]
    open_ = written(rooted.groupBy(*bucket).agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"))
                          .filter("low <> high").drop("low", "high"), "open")
    return written(rooted.join(open_, bucket), "unjoined")


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return written(rows.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id")), "rooted")


def _unjoined(shared: DataFrame, roots: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(band, sketch, id, n, root, size, marks): the buckets whose texts are not all of one class."""
    unjoined = _open(_rooted(shared.select("band", "sketch", "id", "n"), roots))
    marks = _marked(texts.join(unjoined.select("id").distinct(), "id", "left_semi"), k)
    return written(unjoined.join(marks, "id"), "marked")


def _marked(texts: DataFrame, k: int) -> DataFrame:
    """(id, m0, m1, ...): per text (id, text) the bits to which its k-mers are dealt by hash."""
    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for low, high, values in ranged(batch["text"]):
                bits = np.zeros((high - low, 64 * MARKS), bool)
                for row, own in zip(bits, _kmers(values, hashes, k)):
                    row[own % np.uint64(64 * MARKS)] = True
                numbers = np.packbits(bits, axis=1).view(np.int64)
                yield pa.record_batch({"id": batch["id"].slice(low, high - low),
                                       **{f"m{i}": pa.array(numbers[:, i]) for i in range(MARKS)}})

    return texts.mapInArrow(released(marked), "id bigint, " + ", ".join(f"m{i} bigint" for i in range(MARKS)))


def _allowed(threshold: float):
    """Whether sides x and y are of different classes and can be a link.

    A bit that x has and y has not is at least one k-mer of x that no alignment matches.
    """
    least = F.ceil((F.col("x.n") + F.col("y.n")) * (threshold / (1 + threshold)) - 1e-6)
    fits = F.least("x.n", "y.n") >= least
    for a, b in (("x", "y"), ("y", "x")):
        alone = sum((F.bit_count(F.col(f"{a}.m{i}").bitwiseAND(F.bitwise_not(f"{b}.m{i}"))) for i in range(MARKS)), F.lit(0))
        fits = fits & (alone <= F.col(f"{a}.n") - least)
    return (F.col("x.root") != F.col("y.root")) & fits


def _pairs_of(joined: DataFrame, tried: DataFrame) -> DataFrame:
    pairs = joined.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    return pairs.join(tried, ["a", "b"], "left_anti")


def _headed(unjoined: DataFrame, tried: DataFrame, number: int, threshold: float) -> DataFrame:
    """Untried pairs of the texts of large unjoined buckets with ``HEADS`` of them, others for each ``number``."""
    bucket = ["band", "sketch"]
    large = unjoined.filter(F.col("size") > CELL_TEXTS)
    drawn = F.struct(F.xxhash64(F.lit(number), "id").alias("h"), "id", "n", "root", *[f"m{i}" for i in range(MARKS)])
    # Slices first, so that no task ranks a whole bucket.
    heads = large.withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(HEADS))).groupBy(*bucket, "slice").agg(F.min(drawn).alias("head"))
    heads = heads.select(*bucket, "head.*")
    joined = large.alias("x").join(heads.alias("y"), (F.col("x.band") == F.col("y.band")) & (
        F.col("x.sketch") == F.col("y.sketch")) & _allowed(threshold))
    return _pairs_of(joined, tried)


def _remaining(unjoined: DataFrame, tried: DataFrame, threshold: float) -> DataFrame:
    """All untried pairs of unjoined buckets, by cells (i, j) of a bucket: its texts i against its texts j."""
    parts = F.ceil(F.col("size") / CELL_TEXTS).cast("int")
    dealt = unjoined.withColumns({"parts": parts, "own": F.pmod(F.xxhash64("id"), parts).cast("int")})
    left = dealt.withColumns({"i": F.col("own"), "j": F.explode(F.sequence("own", F.col("parts") - 1))})
    right = dealt.withColumns({"j": F.col("own"), "i": F.explode(F.sequence(F.lit(0), "own"))})
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("band", "sketch", "i", "j")]
    once = (F.col("x.i") < F.col("x.j")) | (F.col("x.id") < F.col("y.id"))
    joined = left.alias("x").join(right.alias("y"), same[0] & same[1] & same[2] & same[3] & once & _allowed(threshold))
    return _pairs_of(joined, tried)


def _links(pairs: DataFrame, texts: DataFrame, k: int, threshold: float) -> DataFrame:
    """The candidates whose alignment is good enough."""
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            left, right = (chain.from_iterable(pieces(batch[side])) for side in ("left", "right"))
            good = []
            # The pairs of one left text stand together.
            held, own = None, None
            for i, (x, y) in enumerate(zip(left, right)):
                if x is not held and x != held:
                    held, own = x, _kmers([x], hashes, k)[0]
                if similar(own, _kmers([y], hashes, k)[0], threshold):
                    good.append(i)
            at = pa.array(good, pa.int64())
            yield pa.record_batch({"a": batch["a"].take(at), "b": batch["b"].take(at)})

    first = pairs.join(texts.toDF("a", "left"), "a")
    return first.join(texts.toDF("b", "right"), "b").select("a", "b", "left", "right").mapInArrow(
        released(verify), "a bigint, b bigint")


def classes(docs: DataFrame, k: int = WORDS, threshold: float = SIMILARITY, count: int = SKETCHES) -> DataFrame:
    """(doc_id, class_id) for every row of ``docs`` (doc_id, text): the smallest id of its class."""
    docs = docs.select(F.col("doc_id").cast("bigint"), "text", F.sha2("text", 256).alias("same"), F.xxhash64("text").alias("th"))
    known = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    own = known.groupBy("doc_id").agg(F.min(F.struct("same", "th")).alias("first")).select("doc_id", "first.*")
    firsts = written(own.groupBy("same").agg(F.min("doc_id").alias("id"), F.first("th").alias("th")), "firsts")
    # Texts are sketched where they are read; of equal texts all but one are left out after that, without their texts.
    texts = known.select(F.col("doc_id").alias("id"), "th", "text")
    sketched = _sketched(texts, k, count).join(firsts.select("id", "th"), ["id", "th"], "left_semi")
    pairs, shared = _candidates(written(sketched, "sketches"))
    pairs = written(pairs, "candidates")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(firsts.select("id", "th"), "id")
    chosen = written(texts.join(wanted, ["id", "th"], "left_semi").select("id", "text"), "texts")
    roots = components(_links(pairs, chosen, k, threshold))

    def linked(candidates: DataFrame) -> tuple[DataFrame, DataFrame, bool]:
        """All pairs tried, the classes with these candidates' links, and whether there was a link."""
        candidates = written(candidates, "candidates")
        found = written(_links(candidates, chosen, k, threshold), "found")
        if found.isEmpty():
            return pairs.union(candidates), roots, False
        return pairs.union(candidates), components(found.union(roots.toDF("a", "b"))), True

    unjoined, number, before = _unjoined(shared, roots, chosen, k), 0, None
    while now := unjoined.filter(F.col("size") > CELL_TEXTS).select("id").distinct().count():
        # More heads only while they halve what is left; the pairs of all others are compared below.
        if before is not None and now * 2 > before:
            break
        before, number = now, number + 1
        pairs, roots, joins = linked(_headed(unjoined, pairs, number, threshold))
        if not joins:
            break
        # Classes only grow, so a bucket of one class stays so, and the marks are known.
        unjoined = _open(_rooted(unjoined.drop("root", "size"), roots))
    if not unjoined.isEmpty():
        pairs, roots, _ = linked(_remaining(unjoined, pairs, threshold))
    of_text = (firsts.join(roots, "id", "left")
                     .select("same", F.coalesce("root", "id").alias("class_id")))
    wordless = F.col("text").isNull() | ~F.col("text").rlike(r"[\p{L}\p{N}]")
    of_doc = (own.join(of_text, "same").select("doc_id", "class_id"))
    return (docs.select("doc_id", wordless.alias("wordless")).join(of_doc, "doc_id", "left")
                .select("doc_id", F.when(F.col("wordless"), F.col("doc_id"))
                        .otherwise(F.coalesce("class_id", "doc_id")).alias("class_id")))


def keep_first(docs: DataFrame, k: int = WORDS, threshold: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stand for their class, with their own columns.

    Rows that repeat an id and text count once; rows with a null id all stay.
    """
    chosen = classes(docs, k, threshold).filter("doc_id = class_id").select(F.col("doc_id").alias("id")).distinct()
    carried = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("id"), F.sha2("text", 256).alias("same"))
    alone = carried.filter("id IS NULL").select("row")
    kept = carried.join(chosen, "id", "left_semi")
    # Of rows with one id the first by text stands for the document.
    kept = kept.groupBy("id").agg(F.min_by("row", F.coalesce("same", F.lit("~"))).alias("row")).select("row")
    return kept.unionByName(alone).select("row.*")
