"""The given tables as posts, samples, alerts, logs and manifests.

Each function is the Spark form of the view of the same name in ``oracles``.
Every one follows its table as it grows; none has a window over a whole series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import MAX_CHARS, compose_text, content_hash, preprocess_text
from tidemark.functions.times import epoch_of_ntz
from tidemark.operators.dedup import dedup_first_wins
from tidemark.operators.ordered import ordered_scan
from tidemark.operators.timeseries import full_grid
from tidemark.session import values_frame

#: Creation time of the first post, and the fixed "now" of clock-dependent operators.
START = 1704067200
AS_OF = 1706745600

#: Test lexicon: frequent words of the corpus with a fixed polarity.
LEXICON = [("of", 1), ("to", 1), ("is", 1), ("et", 1), ("les", 1), ("und", 1), ("von", 1),
           ("que", 1), ("and", -1), ("in", -1), ("that", -1), ("le", -1), ("un", -1),
           ("die", -1), ("los", -1)]

BOUNDS = [1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 200.0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_posts(documents: DataFrame) -> DataFrame:
    """Documents as posts: the first line is the title, the rest the body."""
    title = F.substring_index("text", "\n", 1)
    return documents.select(
        F.col("doc_id").alias("arrival_seq"),
        F.concat(F.lit("p"), F.col("doc_id").cast("string")).alias("post_id"),
        title.alias("title"),
        F.substr("text", F.length(title) + 2).alias("content"),
        F.col("n_chars").alias("score"),
        (F.lit(START) + F.col("doc_id") * 60).alias("created_utc"),
        F.col("source").alias("subreddit"), "lang",
        F.concat(F.lit("https://example.test/p/"), F.col("doc_id").cast("string")).alias("url"),
        (F.col("doc_id") % 50).alias("num_comments"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_posts(table(spark, sf_dir, "documents"))


def posts_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts(spark, sf_dir).withColumn(
        "content_hash", content_hash(F.col("title"), F.col("content")))


def posts_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that repeat, so that one id has several texts."""
    return posts_hashed(spark, sf_dir).select(
        "arrival_seq",
        F.concat(F.lit("p"), (F.col("arrival_seq") % 70).cast("string")).alias("post_id"),
        "content_hash")


def seen_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth arrival, first wins."""
    fifth = posts_hashed(spark, sf_dir).filter(F.col("arrival_seq") % 5 == 0)
    return dedup_first_wins(fifth).select(
        "post_id", "content_hash", "title", "subreddit", "created_utc",
        F.col("created_utc").alias("first_seen_utc"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts(spark, sf_dir).select(
        "arrival_seq", "subreddit", "lang",
        preprocess_text(compose_text(F.col("title"), F.col("content")), MAX_CHARS).alias("text"))


def lexicon(spark: SparkSession) -> DataFrame:
    return values_frame(spark, "token STRING, polarity INT", LEXICON)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``t`` in whole seconds and their short instance name."""
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", epoch_of_ntz("ts").alias("t"), "user_id", "event_type", "value", "props",
        F.concat(F.lit("i"), (F.col("user_id") % 3).cast("string")).alias("instance"))


def span(spark: SparkSession, sf_dir: str, step_s: int) -> tuple[int, int]:
    """First and last grid time such that every sample lies in the grid."""
    low, high = events(spark, sf_dir).agg(F.min("t"), F.max("t")).first()
    if low is None:
        return 0, 0
    last = high // 60 * 60 + 60
    return low // step_s * step_s, -(-last // step_s) * step_s


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scraped counter per event type and instance, restarting after 300 events.

    Each minute with events is one scrape. Counting per minute comes first, so
    the running total sees one row per minute however many events there are.
    """
    scraped = events(spark, sf_dir).groupBy(
        F.col("event_type").alias("series"), "instance",
        ((F.floor(F.col("t") / 60) + 1) * 60).cast("bigint").alias("t")
    ).agg(F.count(F.lit(1)).alias("n"))
    total = ordered_scan(scraped, ["series", "instance"], "t", running={"total": F.col("n")},
                         chunk_s=86400)
    return total.select(F.lit("app_events_total").alias("metric"), "series", "instance", "t",
                        (F.col("total") % 300).cast("double").alias("value"))


def bucket_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scraped bucket counters of event values per event type and instance, a row per bound.

    They restart every 40 hours, ten minutes past the hour, so that restarts
    fall into windows; every seventh scrape lacks the bound 25.
    """
    bounds = [*BOUNDS, float("inf")]
    minute = ((F.floor(F.col("t") / 60) + 1) * 60).cast("bigint").alias("t")
    made = events(spark, sf_dir).groupBy(F.col("event_type").alias("series"), "instance", minute).agg(
        *[F.count_if(F.col("value") <= b).alias(f"n{i}") for i, b in enumerate(bounds)])
    life = F.floor((F.col("t") - 600) / F.lit(144000)).alias("life")
    lived = ordered_scan(made.select("*", life), ["series", "instance", "life"], "t",
                         running={f"b{i}": F.col(f"n{i}") for i in range(len(bounds))}, chunk_s=86400)
    rows = F.inline(F.array(*[F.struct(F.lit(b).alias("le"), F.col(f"b{i}").cast("double").alias("value"))
                              for i, b in enumerate(bounds)]))
    return lived.select("series", "instance", "t", rows).filter(
        (F.col("le") != 25.0) | (F.col("t") / 60 % 7 != 0))


def duration_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scraped ``_sum`` and ``_count`` counters of event values, restarting like :func:`bucket_samples`."""
    minute = ((F.floor(F.col("t") / 60) + 1) * 60).cast("bigint").alias("t")
    made = events(spark, sf_dir).groupBy(F.col("event_type").alias("series"), "instance", minute).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"))
    life = F.floor((F.col("t") - 600) / F.lit(144000)).alias("life")
    lived = ordered_scan(made.select("*", life), ["series", "instance", "life"], "t",
                         running={"c": F.col("n"), "s": F.col("cents")}, chunk_s=86400)
    return lived.select("series", "instance", "t", (F.col("s") / 100.0).alias("sum"), F.col("c").cast("double").alias("count"))


def gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total and free memory of an instance, from the ``view`` counter."""
    view = samples(spark, sf_dir).filter(F.col("series") == "view")
    return view.select("instance", "t", F.inline(F.array(
        F.struct(F.lit("mem_total").alias("metric"), F.lit(300.0).alias("value")),
        F.struct(F.lit("mem_free").alias("metric"), (F.lit(300.0) - F.col("value")).alias("value")))))


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters under the names that the recording rules read."""
    v = F.col("value")

    def one(name: str, value) -> F.Column:
        return F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"))

    by_series = {
        "view": [one("posts_processed_total", v), one("node_memory_MemTotal_bytes", F.lit(300)),
                 one("node_memory_MemAvailable_bytes", 300 - v)],
        "click": [one("sentiment_analyses_total", v), one("node_filesystem_size_bytes", F.lit(400)),
                  one("node_filesystem_free_bytes", 400 - v)],
        "error": [one("reddit_api_errors_total", v)],
        "signup": [one("duplicates_found_total", v)],
        "purchase": [one("posts_fetched_total", v), one("node_cpu_seconds_total", v * 16)],
    }
    rows = F.array().cast("array<struct<metric:string,value:double>>")
    for name, made in by_series.items():
        rows = F.when(F.col("series") == name, F.array(*made)).otherwise(rows)
    return samples(spark, sf_dir).select("instance", "t", F.inline(rows))


def rule_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples under the names that alert rules read, with job and service; some names have none."""
    v, t = F.col("value"), F.col("t")

    def one(name: str, value) -> F.Column:
        return F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"))

    by_series = {
        "view": [one("posts_processed_total", v), one("node_memory_MemTotal_bytes", F.lit(300)),
                 one("node_memory_MemAvailable_bytes", 300 - v), one("up", F.when(v % 50 >= 2, 1).otherwise(0)),
                 one("cpu_usage_percent", v / 3)],
        "click": [one("node_filesystem_size_bytes", F.lit(300)), one("node_filesystem_free_bytes", 300 - v),
                  one("memory_usage_percent", v / 3), one("log_errors_total", F.floor(v / 2))],
        "error": [one("reddit_api_errors_total", v), one("sentiment_analysis_errors_total", F.floor(v / 4)),
                  one("errors_total", v * 40)],
        "signup": [one("duplicates_found_total", v), one("backup_last_success_timestamp", t - v * 600)],
        "purchase": [one("posts_fetched_total", v), one("disk_usage_percent", v / 3),
                     one("database_connection_errors_total", F.floor(v / 250)),
                     one("kube_job_status_start_time", t - v * 20)],
    }
    rows = F.array().cast("array<struct<metric:string,value:double>>")
    for name, made in by_series.items():
        rows = F.when(F.col("series") == name, F.array(*made)).otherwise(rows)
    i = F.col("instance")
    return samples(spark, sf_dir).select(
        F.when(i == "i2", "other").otherwise("pipeline").alias("job"), F.when(i == "i1", "other").otherwise("pipeline").alias("service"),
        "instance", "t", F.inline(rows))


def hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type and hour, hours with events only."""
    hour = (F.col("t") - F.pmod(F.col("t"), F.lit(3600))).alias("t")
    return events(spark, sf_dir).groupBy(F.col("event_type").alias("series"), hour).agg(
        F.count(F.lit(1)).alias("n"))


def hourly_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type and hour, silent hours included."""
    counts = hourly_counts(spark, sf_dir)
    start, end = counts.agg(F.min("t"), F.max("t")).first()
    grid = full_grid(counts, ["series"], start or 0, end or 0, 3600)
    return grid.join(counts, ["series", "t"], "left").withColumn(
        "n", F.coalesce("n", F.lit(0)).cast("bigint"))


def alert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("int")
    return events(spark, sf_dir).select(
        "event_id", "t", F.concat(F.lit("alert_"), "event_type").alias("alertname"),
        F.when(user % 3 == 0, "critical").when(user % 3 == 1, "warning").otherwise("info")
        .alias("severity"),
        F.concat(F.lit("svc"), (user % 5).cast("string")).alias("service"),
        F.concat(F.lit("i"), (user % 7).cast("string")).alias("instance"),
        F.when(k % 2 == 0, "firing").otherwise("resolved").alias("status"))


def health_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("event_type").alias("component"), "event_id", "t",
        (F.col("value") <= 20).alias("healthy"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = (F.when(F.col("event_type") == "error", "ERROR")
             .when(F.col("event_type") == "signup", "WARNING").otherwise("INFO"))
    user = F.col("user_id").cast("string")
    return events(spark, sf_dir).select(
        F.col("event_id").alias("seq"), "ts", "t",
        F.concat(F.lit("file"), (F.col("user_id") % 3).cast("string")).alias("file"),
        F.concat(level, F.lit(" user="), user, F.lit(" "), "props").alias("line"))


def manifest_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"),
        F.col("n_chars").alias("size"), F.md5("text").alias("checksum"))


def manifest_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files later: some gone, some moved, some changed."""
    d = F.col("doc_id")
    moved = F.when(d % 13 == 0, d + 1000000).otherwise(d)
    return table(spark, sf_dir, "documents").filter(d % 7 != 0).select(
        F.concat_ws("/", "source", moved.cast("string")).alias("path"),
        F.col("n_chars").alias("size"),
        F.when(d % 11 == 0, F.md5(F.concat("text", F.lit("!")))).otherwise(F.md5("text"))
        .alias("checksum"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    kind = F.when(d % 4 == 0, "daily").when(d % 4 == 1, "weekly").when(d % 4 == 2, "monthly") \
        .otherwise("manual")
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("s"), d.cast("string")).alias("name"), kind.alias("type"),
        (F.lit(AS_OF) - (d % 500) * 86400 - 3600).alias("created_t"))
