"""What a run reports as metric samples."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.labels import label_text
from tidemark.operators.aggregates import BUCKETS, INFINITY
from tidemark.plans.batch import RunResult

_SCHEMA = "metric STRING, labels MAP<STRING, STRING>, value DOUBLE"

#: Metric names of a run (fixed values).
FETCHED = "reddit_posts_fetched_total"
DEDUPLICATED = "reddit_posts_deduplicated_total"
PROCESSED = "reddit_posts_processed_total"
DISTRIBUTION = "sentiment_distribution_total"
ERRORS = "pipeline_errors_total"
STATUS = "pipeline_status"
LAST_RUN = "pipeline_last_successful_run_timestamp"
DURATION = "pipeline_total_duration_seconds"


def fetched_samples(posts: DataFrame, limit: int | None = None) -> DataFrame:
    """Posts taken in per community."""
    counts = posts.groupBy("subreddit").agg(F.count(F.lit(1)).alias("n"))
    taken = F.col("n") if limit is None else F.least(F.col("n"), F.lit(limit))
    return counts.select(F.lit(FETCHED).alias("metric"),
                         F.create_map(F.lit("subreddit"), F.coalesce("subreddit", F.lit("")))
                         .alias("labels"), taken.cast("double").alias("value"))


def run_samples(spark: SparkSession, result: RunResult, ended: float | None = None) -> DataFrame:
    """Counters, status and duration histogram of one run.

    A run that stopped early counts an error and leaves the status at 0.
    """
    rows = [(DEDUPLICATED, {}, result.duplicates), (PROCESSED, {}, result.processed)]
    rows += [(DISTRIBUTION, {"label": k}, n) for k, n in sorted(result.labels.items())]
    if result.reason:
        rows += [(ERRORS, {"component": "pipeline", "error_type": result.reason}, 1),
                 (STATUS, {}, 0)]
    else:
        d = result.duration_s
        rows += [(STATUS, {}, 1), (LAST_RUN, {}, ended if ended is not None else time.time()),
                 (f"{DURATION}_sum", {}, d), (f"{DURATION}_count", {}, 1)]
        rows += [(f"{DURATION}_bucket", {"le": "+Inf" if b == INFINITY else str(b)}, int(d <= b))
                 for b in [*BUCKETS[DURATION], INFINITY]]
    return spark.createDataFrame([(m, x, float(v)) for m, x, v in rows], _SCHEMA)


def counter_totals(samples: DataFrame) -> DataFrame:
    """Samples of many runs added up per metric and label set."""
    return (samples.groupBy("metric", label_text(F.col("labels")).alias("__key"))
            .agg(F.any_value("labels").alias("labels"), F.sum("value").alias("value"))
            .drop("__key"))
