"""The scheduled run: read, drop duplicates, score, write, remember."""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import compose_text
from tidemark.operators.dedup import (
    dedup_against,
    dedup_first_wins,
    dedup_strict,
    insert_if_absent,
    store_rows,
    with_hash,
)
from tidemark.operators.scoring import CLASSES, Scorer, score
from tidemark.schemas import SCORED_COLUMNS, SCORED_POST
from tidemark.sources.posts import by_community, hottest, normalize_posts, read_posts, write_csv
from tidemark.sources.store import SeenStore

log = logging.getLogger(__name__)


def default_run_id() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")


@dataclass
class RunConfig:
    """One run. ``limit`` takes the best posts per community; None takes all."""

    sink: str
    store: SeenStore
    posts: DataFrame | None = None
    source: str | None = None
    fmt: str = "parquet"
    communities: list[str] | None = None
    limit: int | None = None
    scorer: Scorer | None = None
    run_id: str = field(default_factory=default_run_id)
    csv: str | None = None
    strict: bool = False


@dataclass
class RunResult:
    """Figures of a run; ``reason`` names why it ended early, and is None where posts were written."""

    run_id: str
    reason: str | None
    fetched: int = 0
    unique: int = 0
    duplicates: int = 0
    processed: int = 0
    labels: dict[str, int] = field(default_factory=dict)
    duration_s: float = 0.0
    error: str | None = None


def scored_posts(unique: DataFrame, scorer: Scorer | None, run_id: str) -> DataFrame:
    """Unique posts as rows of the written table."""
    text = unique.withColumn("__text", compose_text(F.col("title"), F.col("content")))
    done = score(text, "__text", scorer, "__sentiment")
    s = F.col("__sentiment")
    return done.select(
        *SCORED_COLUMNS[:8], s["label"].alias("sentiment_label"),
        s["confidence"].alias("sentiment_confidence"), s["positive"].alias("sentiment_positive"),
        s["negative"].alias("sentiment_negative"), s["neutral"].alias("sentiment_neutral"),
        s["confidence"].alias("sentiment_score"), F.lit(run_id).alias("run_id"))


def arrivals(posts: DataFrame, communities: list[str] | None, limit: int | None) -> DataFrame:
    """Posts with ``arrival_seq``: communities in their configured order, then rank or age."""
    if communities is not None:
        posts = by_community(posts, communities)
    if "arrival_seq" in posts.columns:
        return posts if limit is None else hottest(posts, limit=limit).drop("rank")
    place = F.lit(0)
    for i, name in enumerate(communities or []):
        place = F.when(F.col("subreddit") == name, F.lit(i)).otherwise(place)
    if limit is None:
        return posts.withColumn("arrival_seq", F.struct(
            place.alias("place"), F.col("created_utc"), F.col("post_id")))
    return hottest(posts, limit=limit).withColumn("arrival_seq", F.struct(
        place.alias("place"), F.col("rank"), F.col("post_id"))).drop("rank")


def _fetched(posts: DataFrame, limit: int | None) -> int:
    """Rows a run takes in, from per-community counts only."""
    counts = posts.groupBy("subreddit").agg(F.count(F.lit(1)).alias("n"))
    taken = F.col("n") if limit is None else F.least(F.col("n"), F.lit(limit))
    return counts.agg(F.coalesce(F.sum(taken), F.lit(0))).first()[0]


def run(spark: SparkSession, config: RunConfig) -> RunResult:
    """One run. The sink is written first and the store after it, so a crash in
    between loses nothing: the repeated run replaces its own output.

    What was written is counted while it is written, so the sink is not read
    back; a run that writes nothing says whether nothing was fetched, nothing
    was new, or nothing was left after scoring.
    """
    began = time.monotonic()
    result = RunResult(config.run_id, None)
    posts = config.posts if config.posts is not None else \
        read_posts(spark, config.source, config.fmt)
    posts = normalize_posts(posts)
    chosen = by_community(posts, config.communities) if config.communities is not None else posts
    result.fetched = _fetched(chosen, config.limit)
    if result.fetched == 0:
        result.reason = "no_posts_fetched"
        return result
    taken = with_hash(arrivals(posts, config.communities, config.limit))
    store = config.store.read(excluding=config.run_id)
    stored = None
    if config.strict:
        unique, stored = dedup_strict(taken, store)
    else:
        unique = dedup_against(dedup_first_wins(taken), store)
    seen = Observation()
    rows = scored_posts(unique, config.scorer, config.run_id).observe(
        seen, F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("sentiment_label") == c).alias(c) for c in CLASSES])
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").parquet(config.sink))
    counts = seen.get
    result.labels = {c: counts[c] for c in CLASSES if counts.get(c)}
    result.processed = result.unique = counts.get("n", 0)
    result.duplicates = result.fetched - result.unique
    if result.processed == 0:
        result.reason = "no_unique_posts" if unique.isEmpty() else "empty_dataframe"
        return result
    if config.csv:
        write_csv(_written(spark, config).select(*SCORED_COLUMNS), config.csv)
    if stored is not None:
        # The emitted row of a stored hash at its own arrival is the stored one.
        pairs = stored.select("post_id", "content_hash", "arrival_seq")
        rows = store_rows(taken.withColumn("post_id", F.coalesce("post_id", F.lit("")))
                          .join(pairs, ["post_id", "content_hash", "arrival_seq"], "left_semi"))
    else:
        rows = insert_if_absent(unique, store)
    config.store.commit(rows, config.run_id)
    result.duration_s = time.monotonic() - began
    return result


def run_reporting(spark: SparkSession, config: RunConfig) -> RunResult:
    """:func:`run` for a scheduler: a run that fails is logged and reported as ``execution_failed``."""
    began = time.monotonic()
    try:
        return run(spark, config)
    except Exception as err:
        log.exception("run %s failed", config.run_id)
        return RunResult(config.run_id, "execution_failed", duration_s=time.monotonic() - began, error=f"{type(err).__name__}: {err}"[:500])


def _written(spark: SparkSession, config: RunConfig) -> DataFrame:
    return spark.read.schema(SCORED_POST).parquet(config.sink) \
        .filter(F.col("run_id") == config.run_id)
