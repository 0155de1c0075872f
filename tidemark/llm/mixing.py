"""Operator 3: sampling to target shares of source, language and topic, by iterative proportional fitting.

Documents are described by source, language, topic and token (word) count. The
tokens of each cell (source, language, topic) are raked: dimension by dimension
the weights are scaled so that the weighted tokens have the target shares, and
again until no share is off by more than ``TOLERANCE``. A target share is a
value's natural share raised to a power and normalised: 1 keeps it, 0 makes all
values equal.

What is drawn is raked as well. Probabilities start at the weights, scaled to
``fraction`` of all tokens, and none may exceed 1: cells at 1 stand with all
their tokens, and the others are scaled to what the marginals still lack, until
that is stable. A value that has fewer tokens than its target gives all it has,
and the other values of its dimension share out the rest in proportion
(``shortfalls`` lists such values), so that the expected tokens are ``fraction``
of all. Targets that contradict each other, as where a source has one language
only, are met as nearly as ``MAX_SWEEPS`` allow, the last dimension exactly.
A document is taken if its hash, a number from 0 to 1, is below its probability.

The topic is the class of words the text has most too many of: words are dealt to
``TOPICS`` classes by hash, and the class with the largest excess over its share
of the whole corpus, in standard deviations, wins (the first of equals). It
stands in for a trained topic; a column ``topic`` of the input is used instead.

Up to ``CELLS`` cells are raked by one task, in numpy; a table of more is raked by
sweeps of joins and aggregations with map-side combination. Both take the same
steps.

Rows: null sources, languages and topics are values of their own (shown as '');
null and empty texts have no tokens, are of topic 0 and are sampled like their
cell; rows of equal id and text are taken or left together; a very long text is
counted whole, and taken or left as a whole; other columns are carried as they
are. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tidemark.llm.common import CACHE_WORDS, place, ranged, released, written

TOPICS = 8
#: Powers of the natural shares.
TARGETS = {"source": 0.5, "lang": 0.7, "topic": 0.5}
TOLERANCE = 1e-6
#: Contradictory targets never meet; after so many sweeps the nearest weights stand.
MAX_SWEEPS = 200
#: Cells that one task rakes: some 100 bytes each.
CELLS = 1 << 20
CELL = ["source", "lang", "topic"]


class _Classes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = zlib.crc32(word) % TOPICS
        return value


def _described(docs: DataFrame, seed: int) -> DataFrame:
    """``row``, source, lang, given topic, u (0 to 1), n_tokens and the words of each class."""
    given = F.coalesce(F.col("topic").cast("string"), F.lit("")) if "topic" in docs.columns else F.lit(None).cast("string")
    text = place(docs, "text")
    docs = docs.select(
        F.struct("*").alias("row"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), given.alias("given"),
        ((F.xxhash64(F.lit(seed), "doc_id", "text") / F.lit(2.0**64)) + 0.5).alias("u"))
    names = ["row", "source", "lang", "given", "u"]

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = _Classes()
        for batch in batches:
            for low, high, texts in ranged(batch["row"].field(text)):
                if len(classes) > CACHE_WORDS:
                    classes.clear()
                words = [t.lower().split() for t in texts]
                sizes = np.fromiter(map(len, words), np.int64, len(words))
                own = np.fromiter(map(classes.__getitem__, (w for ws in words for w in ws)), np.int64, int(sizes.sum()))
                cell = np.repeat(np.arange(len(words)) * TOPICS, sizes) + own
                counts = np.bincount(cell, minlength=len(words) * TOPICS)
                offsets = pa.array(np.arange(len(words) + 1, dtype=np.int32) * TOPICS)
                yield pa.RecordBatch.from_arrays(
                    [*(batch[n].slice(low, high - low) for n in names), pa.array(sizes),
                     pa.ListArray.from_arrays(offsets, pa.array(counts))],
                    names=[*names, "n_tokens", "classes"])

    return docs.mapInArrow(released(described), StructType([
        *(docs.schema[n] for n in names), StructField("n_tokens", LongType()),
        StructField("classes", ArrayType(LongType()))]))


def _topic(shares: list[float]) -> Column:
    """The class with the largest excess, as text."""
    n = F.col("n_tokens")
    excess = F.array(*[
        F.when(n == 0, 0.0).otherwise((F.get("classes", F.lit(k)) - n * s) / F.sqrt(n * max(s * (1 - s), 1e-12)))
        for k, s in enumerate(shares)])
    return F.coalesce("given", (F.array_position(excess, F.array_max(excess)) - 1).cast("string")).alias("topic")


def _reachable(have: np.ndarray, share: np.ndarray, goal: float) -> np.ndarray:
    """``goal`` tokens by ``share``, no value more than it has; what one lacks the others take over."""
    want, full = np.zeros(len(have)), share <= 0
    while (~full).any():
        rest = goal - have[full & (share > 0)].sum()
        want = np.where(share <= 0, 0.0, np.where(full, have, share * (rest / share[~full].sum())))
        over = ~full & (want >= have)
        if not over.any():
            break
        want[over] = have[over]
        full |= over
    return want


def _factors(tokens, weight, code, want, most):
    """For each value the factor at which its weights, cut at ``most``, hold the tokens it should have."""
    factor = np.ones(len(want))
    full = np.zeros(len(tokens), bool)
    while True:
        fixed = np.bincount(code, np.where(full, tokens * most, 0.0), len(want))
        free = np.bincount(code, np.where(full, 0.0, tokens * weight), len(want))
        factor = np.where(free > 0, np.maximum(want - fixed, 0.0) / np.where(free > 0, free, 1.0), factor)
        over = ~full & (weight * factor[code] > most) & (tokens > 0)
        if not over.any():
            return factor
        full |= over


def rake_arrays(codes: list[np.ndarray], tokens: np.ndarray, wants: list[np.ndarray], weight: np.ndarray,
                most: float = np.inf) -> np.ndarray:
    """Weights, at most ``most``, whose weighted tokens are ``wants`` by each of ``codes``."""
    for _ in range(MAX_SWEEPS):
        off = 0.0
        for code, want in zip(codes, wants):
            have = np.bincount(code, tokens * np.minimum(weight, most), len(want))
            off = max(off, np.abs(have / np.where(want > 0, want, 1.0) - 1)[want > 0].max(initial=0.0))
            weight = weight * _factors(tokens, weight, code, want, min(most, 1e300))[code]
        if off <= TOLERANCE:
            break
    return np.minimum(weight, most)


def _shares(have: np.ndarray, power: float) -> np.ndarray:
    share = np.where(have > 0, np.power(np.maximum(have, 1e-300), power), 0.0)
    return share / (share.sum() or 1.0)


def _rake_in_task(cells: DataFrame, targets: dict[str, float], fraction: float) -> DataFrame:
    def raked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if rows is None or not rows.num_rows:
            return
        tokens = rows["tokens"].to_numpy().astype(np.float64)
        codes = [rows[d].combine_chunks().dictionary_encode().indices.to_numpy() for d in targets]
        have = [np.bincount(c, tokens) for c in codes]
        shares = [_shares(h, p) for h, p in zip(have, targets.values())]
        total = tokens.sum()
        weight = rake_arrays(codes, tokens, [s * total for s in shares], np.ones(len(tokens)))
        chance = rake_arrays(codes, tokens, [_reachable(h, s, fraction * total) for h, s in zip(have, shares)],
                             weight * fraction, 1.0)
        yield pa.record_batch([*(rows[d].combine_chunks() for d in CELL), rows["tokens"].combine_chunks(),
                               pa.array(weight), pa.array(chance)], [*CELL, "tokens", "weight", "probability"])

    return cells.select(*CELL, "tokens").coalesce(1).sortWithinPartitions(*CELL).mapInArrow(
        raked, "source string, lang string, topic string, tokens bigint, weight double, probability double")


def _wanted(cells: DataFrame, dim: str, power: float, goal: float | None) -> DataFrame:
    """``dim``, ``want``: the tokens that each value should have, by shares of ``goal`` that no value exceeds."""
    natural = cells.groupBy(dim).agg(F.sum("tokens").cast("double").alias("t"))
    natural = written(natural.withColumn("p", F.when(F.col("t") > 0, F.pow("t", F.lit(power))).otherwise(0.0)), "natural")
    scale, before = 0.0, -1.0
    full = F.lit(False)
    while scale != before:
        before = scale
        fixed, open_, total = natural.agg(F.sum(F.when(full, F.col("t")).otherwise(0.0)),
                                          F.sum(F.when(full, 0.0).otherwise(F.col("p"))), F.sum("t")).first()
        if not open_:
            break
        scale = max(scale, ((total if goal is None else goal * total) - fixed) / open_)
        if goal is None:
            break
        full = F.col("p") * scale >= F.col("t")
    return natural.select(dim, F.when(full, F.col("t")).otherwise(F.col("p") * scale).alias(f"want_{dim}"))


def _rake_by_joins(cells: DataFrame, targets: dict[str, float], start: Column, goal: float | None, out: str) -> DataFrame:
    """``cells`` with ``out``, raked by sweeps; with ``goal``, to that part of all tokens and at most 1."""
    for dim, power in targets.items():
        cells = cells.join(_wanted(cells, dim, power, goal), dim)
    columns = [*cells.columns, out]
    cells = written(cells.withColumn(out, start), "cells")
    at_most = F.col(out) >= 1 if goal is not None else F.lit(False)
    for _ in range(MAX_SWEEPS):
        raked = cells
        for dim in targets:
            own = raked.groupBy(dim).agg(F.sum(F.when(at_most, F.col("tokens")).otherwise(0.0)).alias("fixed"),
                                         F.sum(F.when(at_most, 0.0).otherwise(F.col("tokens") * F.col(out))).alias("free"),
                                         F.sum(F.col("tokens") * F.col(out)).alias("all"))
            want = F.col(f"want_{dim}")
            lacks = (F.col("free") > 0) & (want > F.col("fixed"))
            factor = F.when(lacks, (want - F.col("fixed")) / F.col("free")) \
                .when((F.col("all") > 0) & (want < F.col("fixed")), want / F.col("all")).otherwise(1.0)
            have = F.col("fixed") + F.col("free")
            raked = raked.join(own, dim).withColumns({
                out: F.col(out) * factor, f"off_{dim}": F.when(want > 0, F.abs(have / want - 1)).otherwise(0.0)}) \
                .drop("fixed", "free", "all")
        seen = Observation()
        raked = raked.observe(seen, F.max(F.greatest(*[F.col(f"off_{d}") for d in targets], F.lit(0.0))).alias("off")).select(*columns)
        cells = written(raked, "cells")
        if (seen.get["off"] or 0.0) <= TOLERANCE:
            break
    least = F.least(F.lit(1.0), F.col(out)) if goal is not None else F.col(out)
    return cells.withColumn(out, least).drop(*[f"want_{d}" for d in targets])


def rake(cells: DataFrame, targets: dict[str, float] = TARGETS, fraction: float = 0.5, most_cells: int = CELLS) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``weight``, raked to the targets, and ``probability``, at most 1."""
    cells = written(cells, "cells")
    if cells.count() <= most_cells:
        return written(_rake_in_task(cells, targets, fraction), "raked")
    cells = _rake_by_joins(cells, targets, F.lit(1.0), None, "weight")
    return _rake_by_joins(cells, targets, F.col("weight") * fraction, fraction, "probability")


def shortfalls(weights: DataFrame, fraction: float = 0.5, targets: dict[str, float] = TARGETS) -> DataFrame:
    """dimension, value, wanted, expected (tokens): what the sample of :func:`sample_weights` cannot reach."""
    out = None
    for dim, power in targets.items():
        values = weights.groupBy(F.lit(dim).alias("dimension"), F.col(dim).alias("value")).agg(
            F.sum("n_tokens").alias("t"), F.sum(F.col("n_tokens") * F.col("probability")).alias("expected"))
        share = F.when(F.col("t") > 0, F.pow(F.col("t").cast("double"), F.lit(power))).otherwise(0.0)
        sums = values.agg(F.sum(share).alias("p"), F.sum("t").alias("all"))
        rows = values.withColumn("share", share).join(F.broadcast(sums)).select(  # one row
            "dimension", "value", (F.try_divide("share", "p") * F.col("all") * fraction).alias("wanted"), "expected")
        out = rows if out is None else out.unionByName(rows)
    return out.filter(F.col("expected") < F.col("wanted") * (1 - 10 * TOLERANCE))


def _weighed(small: DataFrame, fraction: float, targets: dict[str, float]) -> tuple[list[float], DataFrame]:
    """Corpus shares of the word classes, and cells with weight and probability."""
    sums = small.agg(F.sum("n_tokens"), *[F.sum(F.get("classes", F.lit(k))) for k in range(TOPICS)]).first()
    shares = [(x or 0) / max(sums[0] or 0, 1) for x in sums[1:]]
    cells = small.select("source", "lang", _topic(shares), "n_tokens").groupBy(*CELL).agg(F.sum("n_tokens").alias("tokens"))
    return shares, rake(cells, targets, fraction)


def sample_weights(docs: DataFrame, fraction: float = 0.5, targets: dict[str, float] = TARGETS, seed: int = 1) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, weight, probability and ``sampled`` for every row of ``docs``."""
    small = written(_described(docs, seed).selectExpr("row.doc_id", "source", "lang", "given", "u", "n_tokens", "classes"),
                    "described")
    shares, cells = _weighed(small, fraction, targets)
    return (small.withColumn("topic", _topic(shares)).join(cells.drop("tokens"), CELL)
                 .select("doc_id", *CELL, "n_tokens", "weight", "probability", (F.col("u") < F.col("probability")).alias("sampled")))


def sample(docs: DataFrame, fraction: float = 0.5, targets: dict[str, float] = TARGETS, seed: int = 1) -> DataFrame:
    """The sampled rows of ``docs``, with their own columns."""
    small = written(_described(docs, seed).select("source", "lang", "given", "n_tokens", "classes"), "described")
    shares, cells = _weighed(small, fraction, targets)
    rows = _described(docs, seed).withColumn("topic", _topic(shares))
    return rows.join(cells.select(*CELL, "probability"), CELL).filter("u < probability").select("row.*")
