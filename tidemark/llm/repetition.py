"""Operator 6: quality rules on repetition, from suffix arrays over words.

The suffixes of a text's words are sorted; neighbours in that order share the
longest common prefixes, and the longest prefix that a suffix shares with either
neighbour is the longest repeat starting there (the deepest interval of common
prefixes that holds it). Repeats of at least ``MIN_REPEAT`` words count: their
spans are united, and a text fails where they cover too much of it or one of them
is too long for the text. All texts of a chunk are sorted at once; words of
different texts are different symbols, so no repeat leaves its text.

The base figures are those every text gets: code points in words, symbols,
repeated lines, and words in three-word windows found twice.

Rows: null and empty texts have no words and fail the base rule; every input row
gives one row and carries its columns, of any names, in ``row``; rows with equal
ids are judged each by its own text. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import place, ranged, released
from tidemark.llm.suffixes import common_prefixes, suffix_array

#: Words from which on a repeat counts as copied and not as a turn of phrase.
MIN_REPEAT = 10
#: Largest share of a text that such repeats may cover, and that one repeat may have.
MAX_COVERED, MAX_LONGEST = 0.30, 0.20
#: A repeat of up to so many words never fails a text by its length alone.
FREE_LONGEST = 50

FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")


def _covered(at: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """Which of ``n`` places lie in a span."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + lengths, -1)
    return np.cumsum(edge)[:n] > 0


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def figures(texts: list[bytes], min_repeat: int = MIN_REPEAT) -> list[np.ndarray]:
    """The columns of :data:`FIGURES` for a chunk of texts."""
    words = [t.split() for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    n = int(counts.sum())
    number: dict[bytes, int] = defaultdict(count().__next__)
    symbols = np.fromiter((number[w] for ws in words for w in ws), np.int64, n)
    doc = np.repeat(np.arange(len(texts)), counts)
    sa, levels = suffix_array((doc << 32) | symbols)
    shared = common_prefixes(sa, levels)
    longest = np.zeros(n, np.int64)
    longest[sa] = np.maximum(shared, np.append(shared[1:], 0)[:n])

    def per_text(values: np.ndarray) -> np.ndarray:
        return np.bincount(doc, values, len(texts)).astype(np.int64)

    three, copied = np.flatnonzero(longest >= 3), np.flatnonzero(longest >= min_repeat)
    most = np.zeros(len(texts), np.int64)
    np.maximum.at(most, doc, longest)
    return [counts,
            np.array([len(b"".join(ws).decode()) for ws in words], np.int64),
            np.array([len(t) - len(t.translate(None, b"#*$%&|<>")) for t in texts], np.int64),
            np.array([_dup_lines(t) for t in texts], np.int64),
            per_text(_covered(three, 3, n)), per_text(_covered(copied, longest[copied], n)), most]


def measure(docs: DataFrame, min_repeat: int = MIN_REPEAT) -> DataFrame:
    """``row`` (all columns of ``docs``), the figures, ``base_failed`` and ``kept``."""
    text, docs = place(docs, "text"), docs.select(F.struct("*").alias("row"))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, texts in ranged(batch["row"].field(text)):
                yield pa.RecordBatch.from_arrays(
                    [batch["row"].slice(low, high - low), *map(pa.array, figures(texts, min_repeat))],
                    names=["row", *FIGURES])

    schema = StructType([docs.schema["row"], *(StructField(n, LongType()) for n in FIGURES)])
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    repeats = ((F.col("covered_words") > MAX_COVERED * F.col("n_words"))
               | ((F.col("longest_repeat") > FREE_LONGEST)
                  & (F.col("longest_repeat") > MAX_LONGEST * F.col("n_words"))))
    return (docs.mapInArrow(released(measured), schema).withColumn("base_failed", base)
                .withColumn("kept", ~base & ~repeats))


def clean(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    return measure(docs).filter("kept").select("row.*")
