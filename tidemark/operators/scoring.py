"""Sentiment scoring: a common contract and three scorers.

A scorer adds one ``SENTIMENT`` struct column to a frame with a text column.
Blank texts never reach a model; they get the neutral fallback.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import preprocess_text, tokens
from tidemark.schemas import SENTIMENT
from tidemark.session import staged

#: Result for blank texts, a missing model or a failed job (fixed values).
NEUTRAL = {"label": "neutral", "confidence": 0.5, "positive": 0.33, "negative": 0.33,
           "neutral": 0.34}

#: Scores given to one text whose own call failed; its confidence is then 0.34 (fixed values).
FAILED_SCORES = {"neutral": 0.34, "positive": 0.33, "negative": 0.33}

#: Class order, which decides ties: the first class listed wins.
CLASSES = ["positive", "negative", "neutral"]


def neutral_struct() -> Column:
    return F.struct(*[F.lit(NEUTRAL[f.name]).cast(f.dataType).alias(f.name) for f in SENTIMENT])


def sentiment_struct(scores: dict[str, Column], order: list[str] | None = None) -> Column:
    """Scores per class to label, confidence and the three probabilities.

    A class without a score counts 0.0; the first class in ``order`` wins ties.
    """
    order = order or CLASSES
    filled = {c: F.coalesce(scores[c], F.lit(0.0)).cast("double") if c in scores else F.lit(0.0)
              for c in CLASSES}
    best = F.greatest(*filled.values())
    label = F.lit(order[-1])
    for name in reversed(order[:-1]):
        label = F.when(filled[name] == best, name).otherwise(label)
    return F.struct(label.alias("label"), best.alias("confidence"),
                    *[filled[c].alias(c) for c in CLASSES])


def argmax_of_map(scores: Column, order: list[str] | None = None) -> Column:
    """The same for a MAP of class to score; class names are lower-cased first."""
    lowered = F.transform_keys(scores, lambda k, v: F.lower(k))
    return sentiment_struct({c: F.try_element_at(lowered, F.lit(c)) for c in CLASSES}, order)


class Scorer(Protocol):
    def add(self, df: DataFrame, text: str, out: str) -> DataFrame:
        """``df`` with a SENTIMENT struct column ``out`` read from column ``text``."""


class LexiconScorer:
    """Word counting against a (token, polarity) table.

    A token counts by the sign of its polarities' sum, so a token that is listed
    twice counts once, and one whose polarities cancel, or are null, not at all.
    A table of at most ``inline_rows`` such tokens becomes literals in the
    expression, so scoring needs no shuffle at all. The size is checked by
    reading one row more than the bound; a larger table is joined instead, with
    the same answers.
    """

    def __init__(self, lexicon: DataFrame, inline_rows: int = 20_000, decimals: int = 6):
        self.lexicon = (lexicon.groupBy("token").agg(
            F.signum(F.sum(F.signum(F.col("polarity")))).cast("int").alias("polarity"))
            .filter("polarity <> 0 AND token IS NOT NULL"))
        self.inline_rows = inline_rows
        self.decimals = decimals

    def _probabilities(self, pos: Column, neg: Column) -> dict[str, Column]:
        whole = pos + neg + F.lit(1.0)
        return {"positive": F.round(pos / whole, self.decimals),
                "negative": F.round(neg / whole, self.decimals),
                "neutral": F.round(F.lit(1.0) / whole, self.decimals)}

    def _result(self, blank: Column, pos: Column, neg: Column) -> Column:
        return F.when(blank, neutral_struct()) \
            .otherwise(sentiment_struct(self._probabilities(pos, neg)))

    def add(self, df: DataFrame, text: str, out: str) -> DataFrame:
        head = self.lexicon.limit(self.inline_rows + 1).collect()
        if len(head) > self.inline_rows:
            return self._joined(df, text, out)
        pos = [r.token for r in head if r.polarity > 0]
        known = [r.token for r in head if r.polarity != 0]

        # One pass finds the few tokens that count; only those are looked at again.
        found = F.filter(tokens(F.col(text)), lambda t: t.isin(known))
        counted = df.withColumn("__found", found).withColumn(
            "__pos", F.size(F.filter("__found", lambda t: t.isin(pos))))
        return counted.select(*df.columns, self._result(
            F.col(text) == "", F.col("__pos"), F.size("__found") - F.col("__pos")).alias(out))

    def _joined(self, df: DataFrame, text: str, out: str) -> DataFrame:
        counts = {"__pos": F.col("polarity") > 0, "__neg": F.col("polarity") < 0}
        joined = _with_token_sums(df, text, self.lexicon, "token", tokens, counts)
        zero = F.lit(0)
        return joined.select(*df.columns, self._result(
            F.col("__blank"), F.coalesce(F.col("__pos"), zero), F.coalesce(F.col("__neg"), zero)).alias(out))


#: Bytes of text whose words meet their rows of a table together.
BLOCK_BYTES = 8 << 20


def _with_token_sums(df: DataFrame, text: str, table: DataFrame, key: str,
                     parts: Callable[[Column], Column], values: dict[str, Column]) -> DataFrame:
    """``df`` with sums of whole-number ``values`` of ``table`` over its texts' tokens, and ``__blank``.

    Distinct texts, named by their hash, are dealt to blocks of some
    ``BLOCK_BYTES``. Only a block's distinct tokens are joined to the table by
    ``key``; what they are worth comes back to the block, where each text's
    tokens are added up. So tokens of single texts are never shuffled, and what
    a task holds does not grow with the corpus. The rows meet their sums by the
    hash, in a join that adaptive execution can split, as one text can be in
    most of them.
    """
    named = df.withColumns({"__hash": F.sha2(text, 256), "__blank": F.col(text) == ""})
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    words = (
        named.filter(F.col(text) != "").groupBy("__hash").agg(F.first(text).alias("__text"))
        .withColumn("__block", F.pmod(F.xxhash64("__hash"), F.lit(blocks)).cast("int"))
        .repartition(blocks, "__block")
        .select("__block", "__hash", parts(F.col("__text")).alias("__words"))
    )
    used = words.select("__block", F.explode("__words").alias(key)).distinct()
    worth = used.join(table.select(key, *[c.cast("bigint").alias(n) for n, c in values.items()]), key) \
        .withColumnRenamed("__block", "__of")

    names = list(values)

    def summed(texts: pa.Table, worth: pa.Table) -> pa.Table:
        lists = texts["__words"].combine_chunks()
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        at = pc.index_in(lists.flatten(), value_set=worth[key].combine_chunks()).fill_null(len(worth)).to_numpy()
        out = {"__hash": texts["__hash"]}
        for name in names:
            total = np.append(0, np.cumsum(np.append(worth[name].to_numpy(), 0)[at]))
            out[name] = pa.array(total[ends[1:]] - total[ends[:-1]])
        return pa.table(out)

    sums = words.groupBy("__block").cogroup(worth.groupBy("__of")).applyInArrow(
        summed, ", ".join(["__hash string", *[f"{n} bigint" for n in names]]))
    return named.join(sums, "__hash", "left")


class TrainedScorer:
    """Multinomial naive Bayes, fitted by :func:`fit_trained_scorer`.

    ``model`` has a row per token with its log-likelihood in each class, rounded
    to ``DIGITS`` decimals, so that sums do not depend on their order; ``priors``
    are the classes' log-priors. Tokens that the training rows did not have say
    nothing; a class that none of them had scores 0.0.
    """

    def __init__(self, model: DataFrame, priors: dict[str, float], parts: Callable[[Column], Column]):
        self.model, self.priors, self.parts = model, priors, parts

    def add(self, df: DataFrame, text: str, out: str) -> DataFrame:
        # In units of the last decimal, so that whole numbers are added.
        values = {f"__s_{c}": F.col(f"log_{c}") * F.lit(10**DIGITS) for c in self.priors}
        joined = _with_token_sums(df, text, self.model, "token", self.parts, values)
        unit = F.lit(Decimal(1).scaleb(-DIGITS))
        logs = {c: F.lit(p) + F.coalesce((F.col(f"__s_{c}").cast("decimal(20,0)") * unit).cast("double"), F.lit(0.0))
                for c, p in self.priors.items()}
        best = F.greatest(*logs.values()) if len(logs) > 1 else next(iter(logs.values()), F.lit(0.0))
        weights = {c: F.exp(x - best) for c, x in logs.items()}
        whole = sum(weights.values(), F.lit(0.0))
        return joined.select(*df.columns, F.when(F.col("__blank"), neutral_struct()).otherwise(
            sentiment_struct({c: w / whole for c, w in weights.items()})).alias(out))


#: Decimals of a log-likelihood.
DIGITS = 9


def fit_trained_scorer(labelled: DataFrame, text: str = "text", label: str = "label",
                       features: int | None = None) -> TrainedScorer:
    """Multinomial naive Bayes with add-one smoothing, by aggregation alone.

    Tokens are counted per class with map-side combine; with ``features`` they
    are first dealt to so many buckets by hash. The model is written to the
    shared folder; only the classes' totals come to the driver.
    """
    def parts(column: Column) -> Column:
        found = F.filter(tokens(column), lambda t: t != "")
        return F.transform(found, lambda t: F.pmod(F.xxhash64(t), F.lit(features))) if features else found

    rows = labelled.filter(F.col(label).isin(CLASSES)).select(F.col(label).alias("__label"), F.col(text).alias("__text"))
    docs = {r[0]: r[1] for r in rows.groupBy("__label").count().collect()}
    classes = [c for c in CLASSES if docs.get(c)]
    counted = staged(rows.select("__label", F.explode(parts(F.col("__text"))).alias("token")).groupBy("token").agg(
        *[F.count_if(F.col("__label") == c).alias(f"n_{c}") for c in classes]), "tokens")
    size, *totals = counted.agg(F.count(F.lit(1)), *[F.sum(f"n_{c}") for c in classes]).first()
    model = counted.select("token", *[
        F.round(F.log((F.col(f"n_{c}") + 1) / F.lit(float((n or 0) + size))), DIGITS).cast(f"decimal(18,{DIGITS})").alias(f"log_{c}")
        for c, n in zip(classes, totals)])
    seen = sum(docs.get(c, 0) for c in classes)
    priors = {c: round(math.log((docs[c] + 1) / (seen + len(classes))), DIGITS) for c in classes}
    return TrainedScorer(model, priors, parts)



class BatchModelScorer:
    """An external model called on Arrow batches.

    ``load`` runs once per Python worker and returns a function from a list of
    texts to a list of {class: score}. Texts go out in lists of ``batch_size``.
    If a list fails, its texts are retried one by one, and a text that fails
    alone gets :data:`FAILED_SCORES` and ``<out>_error`` = true. If the model
    cannot be loaded every text is neutral.
    """

    def __init__(self, load: Callable[[], Callable[[list[str]], list[dict[str, float]]]],
                 batch_size: int = 8, partitions: int | None = None):
        self.load, self.batch_size, self.partitions = load, batch_size, partitions

    def add(self, df: DataFrame, text: str, out: str) -> DataFrame:
        load, size = self.load, self.batch_size
        schema = ("label string, confidence double, positive double, negative double, "
                  "neutral double, error boolean")

        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            try:
                model = load()
            except Exception:
                model = None
            for batch in batches:
                yield _score_batch(model, batch, size)

        udf = F.pandas_udf(run, schema)
        if self.partitions:
            df = df.repartition(self.partitions)
        fields = [f"__s.{f.name}" for f in SENTIMENT]
        scored = df.withColumn("__s", udf(F.col(text)))
        return scored.select(*df.columns, F.struct(*fields).alias(out),
                             F.col("__s.error").alias(f"{out}_error"))


def _score_batch(model, texts: pd.Series, size: int) -> pd.DataFrame:
    """Score one Arrow batch; see :class:`BatchModelScorer` for the failure rules."""
    rows = [{**NEUTRAL, "error": model is None and bool(t)} for t in texts]
    todo = [i for i, t in enumerate(texts) if t and model is not None]
    for start in range(0, len(todo), size):
        part = todo[start:start + size]
        try:
            results = [(r, False) for r in model([texts.iloc[i] for i in part])]
            if len(results) != len(part):
                raise ValueError("model returned another number of results")
        except Exception:
            results = []
            for i in part:
                try:
                    results.append((model([texts.iloc[i]])[0], False))
                except Exception:
                    results.append((FAILED_SCORES, True))
        for i, (scores, failed) in zip(part, results):
            lowered = {k.lower(): float(v) for k, v in scores.items()}
            label = max(lowered, key=lowered.get)
            rows[i] = {"label": label, "confidence": lowered[label], "error": failed,
                       **{c: lowered.get(c, 0.0) for c in CLASSES}}
    return pd.DataFrame(rows, columns=[*[f.name for f in SENTIMENT], "error"])


def score(df: DataFrame, text: str, scorer: Scorer | None, out: str = "sentiment") -> DataFrame:
    """Preprocess ``text`` and add the SENTIMENT struct; no scorer means neutral."""
    if scorer is None:
        return df.withColumn(out, neutral_struct())
    ready = df.withColumn("__ready", preprocess_text(F.col(text)))
    return scorer.add(ready, "__ready", out).drop("__ready")
