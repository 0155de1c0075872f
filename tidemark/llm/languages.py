"""Operator 10: the languages of a text, as a mixture fitted by expectation-maximisation.

Each language has the smoothed frequencies of byte trigrams in its words (hashed
to ``2 ** BUCKET_BITS``), counted over all training texts. The likelihood of a
word under a language is the product over its trigrams. A text is a mixture: its
language shares are fitted by EM over its words, then the languages in order of
their shares form nested sets, and the set with the best log-likelihood less
``PENALTY * log(words)`` per language is taken. The prediction is the largest
share in that set, fitted again within it; that share is the score.

The model is a table of (languages x 2 ** BUCKET_BITS) floats, whatever the size
of the corpus; counts are combined per task before they are shuffled.

Rows: texts that are null or have no letter are ``und`` with score 0; if no
training text has a language, all are. Training rows with a null text or
language are ignored. Equal shares go to the language that sorts first. Every
row gives one row and carries its columns in ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, MapType, StringType, StructField, StructType

from tidemark.llm.common import CACHE_WORDS, as_bytes, chunks

BUCKET_BITS = 16
SMOOTHING = 0.5
ROUNDS, LAST_ROUNDS = 10, 4
PENALTY = 3.0

_LETTERS = bytes(c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def _words(texts: list[bytes]) -> list[list[bytes]]:
    return [t.decode().lower().encode().translate(_LETTERS).split() for t in texts]


def _trigrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all trigrams of `` word ``, whether each lies within a word, and where words begin."""
    raw = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    code = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
    bucket = (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    inside = np.ones(len(bucket), bool)
    inside[starts[1:] - 1] = False
    return bucket, inside, starts


class _Numbers(dict):
    """Words to numbers, in the order they are met."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def count_trigrams(training: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all texts of ``training`` (text, lang)."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = as_bytes(batch["text"]), batch["lang"].to_pylist()
            for low, high in chunks(texts):
                words, own = _words(texts[low:high]), langs[low:high]
                for lang in set(own):
                    numbers = _Numbers()
                    ids = np.array([numbers[w] for ws, x in zip(words, own) if x == lang for w in ws], np.int64)
                    if not len(ids):
                        continue
                    bucket, inside, starts = _trigrams(list(numbers))
                    times = np.repeat(np.bincount(ids), np.diff(np.append(starts, len(bucket))))
                    total = totals.setdefault(lang, np.zeros(1 << BUCKET_BITS))
                    total += np.bincount(bucket[inside], times[inside], 1 << BUCKET_BITS)
        for lang, total in totals.items():
            found = np.flatnonzero(total)
            yield pa.record_batch({"lang": pa.array([lang] * len(found), pa.string()),
                                   "bucket": pa.array(found, pa.int32()),
                                   "n": pa.array(total[found].astype(np.int64))})

    return (training.select("text", "lang").dropna().mapInArrow(counted, "lang string, bucket int, n bigint")
                    .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))


class Model:
    """Log-probabilities of trigram buckets, a column per language."""

    def __init__(self, counts: DataFrame):
        rows = counts.toPandas()
        self.langs = sorted(rows["lang"].unique())
        table = np.zeros((1 << BUCKET_BITS, len(self.langs)))
        column = rows["lang"].map({x: i for i, x in enumerate(self.langs)}).to_numpy(np.int64)
        table[rows["bucket"].to_numpy(np.int64), column] = rows["n"].to_numpy(np.float64)
        table += SMOOTHING
        self.logs = np.log(table / table.sum(0)).astype(np.float32)

    def of_words(self, words: list[bytes]) -> np.ndarray:
        bucket, inside, starts = _trigrams(words)
        values = self.logs[bucket]
        values[~inside] = 0
        return np.add.reduceat(values, starts, axis=0)


def _shares(likely: np.ndarray, doc: np.ndarray, begins: np.ndarray, sizes: np.ndarray,
            shares: np.ndarray, rounds: int) -> np.ndarray:
    for _ in range(rounds):
        each = likely * shares[doc]
        each /= each.sum(1, keepdims=True)
        shares = np.add.reduceat(each, begins, axis=0) / sizes[:, None]
    return shares


def mixtures(logs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Language shares of texts with ``sizes`` words (all over 0) whose word log-likelihoods are ``logs``.

    Languages outside the chosen set have share 0.
    """
    n, k = len(sizes), logs.shape[1]
    likely = np.exp(logs - logs.max(1, keepdims=True)) + np.float32(1e-30)
    begins = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(n), sizes)
    shares = _shares(likely, doc, begins, sizes, np.full((n, k), 1 / k, np.float32), ROUNDS)
    place = np.argsort(np.argsort(-shares, axis=1, kind="stable"), axis=1)
    best, chosen = np.full(n, -np.inf), np.zeros(n, np.int64)
    for size in range(1, k + 1):
        part = np.where(place < size, shares + np.float32(1e-6), 0)
        part /= part.sum(1, keepdims=True)
        fit = np.add.reduceat(np.log((likely * part[doc]).sum(1) + 1e-37, dtype=np.float64), begins)
        fit -= PENALTY * size * np.log(sizes + 1)
        better = fit > best
        best[better], chosen[better] = fit[better], size
    shares = np.where(place < chosen[:, None], shares + np.float32(1e-6), 0)
    shares /= shares.sum(1, keepdims=True)
    return _shares(likely, doc, begins, sizes, shares.astype(np.float32), LAST_ROUNDS)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """For every row of ``docs`` (text): ``row``, lang_pred, score and ``shares`` (language to share)."""
    docs = docs.select(F.struct("*").alias("row"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        numbers, known = _Numbers(), np.zeros((0, len(model.langs)), np.float32)
        for batch in batches:
            texts = as_bytes(batch["text"])
            for low, high in chunks(texts):
                if len(numbers) > CACHE_WORDS:
                    numbers, known = _Numbers(), known[:0]
                words = [ws if any(map(str.isalpha, t.decode())) else [] for ws, t in
                         zip(_words(texts[low:high]), texts[low:high])]
                sizes = np.fromiter(map(len, words), np.int64, len(words))
                before = len(numbers)
                ids = np.fromiter(map(numbers.__getitem__, (w for ws in words for w in ws)), np.int64, int(sizes.sum()))
                if len(numbers) > before:
                    known = np.concatenate([known, model.of_words(list(numbers)[before:])])
                shares = np.zeros((len(words), len(model.langs)), np.float32)
                some = sizes > 0
                if some.any() and model.langs:
                    shares[some] = mixtures(known[ids], sizes[some])
                top = shares.argmax(1) if model.langs else np.zeros(len(words), np.int64)
                ok = some & bool(model.langs)
                yield pa.RecordBatch.from_arrays(
                    [batch["row"].slice(low, high - low),
                     pa.array([model.langs[i] if s else "und" for i, s in zip(top, ok)], pa.string()),
                     pa.array([min(1.0, float(x[i])) if s else 0.0 for x, i, s in zip(shares, top, ok)], pa.float64()),
                     pa.array([[(a, float(v)) for a, v in zip(model.langs, x) if v > 0] for x in shares],
                              pa.map_(pa.string(), pa.float64()))],
                    names=["row", "lang_pred", "score", "shares"])

    return docs.mapInArrow(identified, StructType([
        docs.schema["row"], StructField("lang_pred", StringType()), StructField("score", DoubleType()),
        StructField("shares", MapType(StringType(), DoubleType()))]))
