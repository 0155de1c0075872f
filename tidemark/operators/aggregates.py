"""Counts, ratios, histograms and quality figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import row_place

#: Histogram bounds (fixed values).
BUCKETS = {
    "sentiment_analysis_duration_seconds": [0.1, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0],
    "sentiment_batch_size": [1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 200.0],
    "pipeline_total_duration_seconds": [10.0, 30.0, 60.0, 120.0, 300.0, 600.0, 1200.0],
    "model_load_duration_seconds": [1.0, 5.0, 10.0, 30.0, 60.0, 120.0],
}

INFINITY = float("inf")


def count_rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` rounded to six places; null where nothing was counted."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 100.0, 6)


def label_distribution(df: DataFrame, label: str = "sentiment_label") -> DataFrame:
    """Rows per label, most frequent first; a null label is not counted."""
    return (df.filter(F.col(label).isNotNull()).groupBy(label).agg(count_rows("posts"))
            .orderBy(F.desc("posts"), label))


def label_ratios(df: DataFrame, label: str = "sentiment_label") -> DataFrame:
    """Share of each class among all rows, in one pass."""
    def share(name: str) -> Column:
        return F.round(F.try_divide(F.count_if(F.col(label) == name).cast("double"),
                                    F.count(F.lit(1)).cast("double")), 6).alias(name)
    return df.agg(share("positive"), share("negative"), share("neutral"))


def sentiment_over_time(df: DataFrame, created: str = "created_utc", width_s: int = 3600,
                        by: str = "subreddit", label: str = "sentiment_label") -> DataFrame:
    """Counts per time slot and community with one column per class."""
    slot = (F.col(created) - F.pmod(F.col(created), F.lit(width_s))).alias("slot")
    counts = [F.count_if(F.col(label) == c).alias(c) for c in ("positive", "negative", "neutral")]
    return df.groupBy(slot, by).agg(*counts)


def count_by(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows per key, most frequent first."""
    return df.groupBy(*keys).agg(count_rows(name)).orderBy(F.desc(name), *keys)


def run_summary(tagged: DataFrame, label: str = "sentiment_label",
                flag: str = "is_duplicate") -> DataFrame:
    """Figures of one run from the tagged frame, in a single aggregation.

    ``reason`` names the early exit, or is null when rows were processed.
    """
    unique = ~F.col(flag)
    out = tagged.agg(
        count_rows("fetched"),
        F.count_if(unique).alias("unique"),
        F.count_if(unique & F.col(label).isNotNull()).alias("processed"),
        *[F.count_if(unique & (F.col(label) == c)).alias(c)
          for c in ("positive", "negative", "neutral")])
    return out.select(
        "fetched", "unique", (F.col("fetched") - F.col("unique")).alias("duplicates"),
        "processed", "positive", "negative", "neutral",
        F.when(F.col("fetched") == 0, "no_posts_fetched")
        .when(F.col("unique") == 0, "no_unique_posts")
        .when(F.col("processed") == 0, "empty_dataframe").alias("reason"))


def duplicate_rate(tagged: DataFrame, created: str = "created_utc", width_s: int = 86400,
                   flag: str = "is_duplicate") -> DataFrame:
    """Duplicates per hundred fetched rows, per time slot."""
    slot = (F.col(created) - F.pmod(F.col(created), F.lit(width_s))).alias("slot")
    out = tagged.groupBy(slot).agg(count_rows("fetched"), F.count_if(flag).alias("duplicates"))
    return out.withColumn("duplicate_percent", percent(F.col("duplicates"), F.col("fetched")))


def histogram_buckets(df: DataFrame, value: str, bounds: list[float],
                      by: list[str]) -> DataFrame:
    """Cumulative counts per bound and ``+Inf``, as rows ``(by, le, cumulative)``.

    All bounds are counted in one pass and turned into rows afterwards, so the
    input is never multiplied by the number of bounds.
    """
    counts = [F.count_if(F.col(value) <= b).alias(f"b{i}") for i, b in enumerate(bounds)]
    wide = df.groupBy(*by).agg(*counts, F.count(value).alias("b_inf"))
    pairs = [F.struct(F.lit(b).alias("le"), F.col(f"b{i}").alias("cumulative"))
             for i, b in enumerate(bounds)]
    pairs.append(F.struct(F.lit(INFINITY).alias("le"), F.col("b_inf").alias("cumulative")))
    return wide.select(*by, F.inline(F.array(*pairs)))


def histogram_totals(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """The ``_sum`` and ``_count`` rows of a histogram and their mean.

    Sums run over DECIMAL so that they do not depend on the order of rows.
    """
    total = F.sum(F.col(value).cast("decimal(28,6)"))
    out = df.groupBy(*by).agg(F.round(total.cast("double"), 6).alias("sum"),
                              F.count(value).alias("count"))
    return out.withColumn("mean", F.round(F.try_divide(F.col("sum"),
                                                       F.col("count").cast("double")), 6))


def gauge_latest(df: DataFrame, keys: list[str], value: str, t: str, tie: str) -> DataFrame:
    """Last write per gauge."""
    return df.groupBy(*keys).agg(F.max_by(value, row_place(df, t, [tie])).alias(value),
                                 F.max(t).alias(t))


def status_writes(events: DataFrame, kind: str) -> DataFrame:
    """Events that write the status gauge, with the value they write.

    Errors write 0, a successful run or a reset writes 1; an API error is
    counted elsewhere and leaves the gauge alone.
    """
    value = (F.when(F.col(kind) == "error", F.lit(0.0))
             .when(F.col(kind).isin("success", "reset"), F.lit(1.0)))
    return events.withColumn("status", value).filter(F.col("status").isNotNull())


def last_success(df: DataFrame, keys: list[str], ok: Column, t: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(F.when(ok, F.col(t))).alias("last_success_t"))


def health_rollup(checks: DataFrame, by: list[str], component: str = "component",
                  healthy: str = "healthy") -> DataFrame:
    """AND over components with the failing ones listed; the list holds each name once."""
    failing = F.collect_set(F.when(~F.col(healthy), F.col(component)))
    return checks.groupBy(*by).agg(
        F.when(F.bool_and(healthy), "healthy").otherwise("unhealthy").alias("overall"),
        F.array_join(F.array_sort(failing), ",").alias("failing"))


def quality_counts(df: DataFrame, score: str = "sentiment_score",
                   confidence: str = "sentiment_confidence", low: float = 0.5) -> DataFrame:
    return df.agg(count_rows("total_posts"), F.count_if(F.col(score).isNull())
                  .alias("missing_sentiment"),
                  F.count_if(F.col(confidence) < low).alias("low_confidence"))


def daily_volume(df: DataFrame, created: str = "created_utc", content: str = "content") -> DataFrame:
    """Rows and characters per day; the day is its first epoch second."""
    day = (F.col(created) - F.pmod(F.col(created), F.lit(86400))).alias("day")
    return df.groupBy(day).agg(count_rows("posts_per_day"),
                               F.coalesce(F.sum(F.length(content)), F.lit(0)).alias("data_size")) \
        .orderBy("day")


def heavy_clients(df: DataFrame, client: str, t: str, as_of: int, days: int = 30,
                  more_than: int = 10_000) -> DataFrame:
    """Clients with more than ``more_than`` requests in the window, busiest first."""
    return (
        df.filter(F.col(t) > as_of - days * 86400)
        .groupBy(client)
        .agg(count_rows("request_count"), F.min(t).alias("first_request"),
             F.max(t).alias("last_request"))
        .filter(F.col("request_count") > more_than)
        .orderBy(F.desc("request_count"), client)
    )


def recent_count(df: DataFrame, t: str, as_of: int, seconds: int) -> DataFrame:
    """Rows newer than ``as_of - seconds``."""
    return df.filter(F.col(t) > as_of - seconds).agg(count_rows("recent"))


def export_filtered(df: DataFrame, start: int, end: int, communities: list[str],
                    label: str) -> DataFrame:
    """Rows of a date range, some communities and one label, in the export columns."""
    return df.filter(
        (F.col("created_utc") >= start) & (F.col("created_utc") < end)
        & F.col("subreddit").isin(communities) & (F.col("sentiment_label") == label)
    ).select("post_id", "subreddit", "title", "sentiment_label", "sentiment_score", "created_utc")


def top_scored(df: DataFrame, community: str, after: int, k: int = 100,
               score: str = "sentiment_score", tie: str = "post_id") -> DataFrame:
    """The ``k`` best scores of one community after a time."""
    return (df.filter((F.col("subreddit") == community) & (F.col("created_utc") > after))
            .orderBy(F.desc(score), tie).limit(k))


def snapshot_reconcile(original: DataFrame, copy: DataFrame, t: str,
                       columns: list[str]) -> DataFrame:
    """Row count, latest time and checksum of a copy beside those of its original.

    Both sides are tagged, read once and reduced together to one row.
    """
    both = original.select(F.lit(True).alias("__o"), t, *[c for c in columns if c != t]) \
        .unionByName(copy.select(F.lit(False).alias("__o"), t, *[c for c in columns if c != t]))
    digest = F.xxhash64(*columns).cast("decimal(38,0)")
    is_original = F.col("__o")
    out = both.agg(
        F.count_if(is_original).alias("original_rows"),
        F.count_if(~is_original).alias("copy_rows"),
        F.max(F.when(is_original, F.col(t))).alias("original_latest"),
        F.max(F.when(~is_original, F.col(t))).alias("copy_latest"),
        F.sum(F.when(is_original, digest)).alias("__od"),
        F.sum(F.when(~is_original, digest)).alias("__cd"))
    same_content = F.col("__od").eqNullSafe(F.col("__cd"))
    return out.select("original_rows", "copy_rows", "original_latest", "copy_latest",
                      same_content.alias("same_content"),
                      ((F.col("original_rows") == F.col("copy_rows"))
                       & F.col("original_latest").eqNullSafe(F.col("copy_latest"))
                       & same_content).alias("matches"))


def confusion_matrix(predicted: DataFrame, labelled: DataFrame, key: str, label: str,
                     prediction: str) -> DataFrame:
    """Rows per (label, prediction); accuracy is the diagonal over the total."""
    return (predicted.select(key, prediction).join(labelled.select(key, label), key)
            .groupBy(label, prediction).agg(count_rows("n")))


def accuracy(matrix: DataFrame, label: str, prediction: str) -> DataFrame:
    right = F.sum(F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0))
    return matrix.agg(F.round(F.try_divide(right.cast("double"), F.sum("n").cast("double")), 6)
                      .alias("accuracy"))
