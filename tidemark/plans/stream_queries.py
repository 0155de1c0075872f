"""Streaming queries, run over what is there and read back from their sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.labels import label_columns
from tidemark.functions.times import epoch_of_ntz
from tidemark.operators.rules import AUTO_RESOLVE_S, by_severity
from tidemark.operators.scoring import LexiconScorer
from tidemark.plans import fixtures as fx
from tidemark.plans.alert_queries import rule_points
from tidemark.plans.registry import query
from tidemark.schemas import SCORED_COLUMNS
from tidemark.session import DEFAULTS, scratch_path, staged, values_frame
from tidemark.sources.store import SeenStore
from tidemark.sources.telemetry import exposition_lines, metric_types, scrape_lines, stream_exposition, with_types
from tidemark.streaming import jobs
from tidemark.streaming.alerts import alert_stream


def _stream(spark, sf, name):
    """A table as a file stream; the bracket makes a pattern, which fits a file or a folder."""
    return jobs.read_files(spark, f"{sf}/{name}.parque[t]", fx.table(spark, sf, name).schema)


@query("stream_incremental", """
SELECT post_id, subreddit, created_utc FROM posts""")
def stream_incremental(spark, sf):
    base = scratch_path(spark, "incremental")
    posts = fx.as_posts(_stream(spark, sf, "documents"))
    rows = posts.select("post_id", "subreddit", "created_utc")
    for _ in range(2):
        jobs.run_available(rows, f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(rows.schema).parquet(f"{base}/out")


@query("stream_dedup", "SELECT DISTINCT content_hash FROM posts_hashed")
def stream_dedup(spark, sf):
    base = scratch_path(spark, "dedup")
    rows = jobs.stream_dedup(fx.as_posts(_stream(spark, sf, "documents"))).select("content_hash")
    jobs.run_available(rows, f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(rows.schema).parquet(f"{base}/out")


@query("stream_window_counts", """
SELECT start_t, event_type, count(*) AS n FROM (
  SELECT event_type, unnest([t - t % 300, t - t % 300 - 300, t - t % 300 - 600]) AS start_t
  FROM evs) w
WHERE start_t + 900 <= (SELECT epoch_ms(max(ts)) - 3600000 FROM events) / 1000 GROUP BY 1, 2""")
def stream_window_counts(spark, sf):
    """Windows that the watermark has closed."""
    base = scratch_path(spark, "windows")
    counts = jobs.window_counts(_stream(spark, sf, "events"), "ts", ["event_type"],
                                "15 minutes", "5 minutes")
    start = epoch_of_ntz(F.col("window.start").cast("timestamp_ntz"))
    rows = counts.select(start.alias("start_t"), "event_type", "n")
    jobs.run_available(rows, f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(rows.schema).parquet(f"{base}/out")


@query("scrape_ingestion", """
SELECT 'app_events_total' AS metric, 'counter' AS type, series, instance, t, value FROM samples""")
def scrape_ingestion(spark, sf):
    """Samples written as scrape files in three parts, each read by a run of one checkpointed stream."""
    base, samples = scratch_path(spark, "scrapes"), fx.samples(spark, sf)
    labelled = samples.select("metric", "t", "value", F.create_map(
        F.lit("series"), "series", F.lit("instance"), "instance").alias("labels"))
    labelled = staged(labelled, "samples")
    start, end = fx.span(spark, sf, 3600)
    part = (end - start) // 3 + 1
    types = values_frame(spark, "line STRING", [("# TYPE app_events_total counter",)])
    for i in range(3):
        low = start + i * part
        mine = labelled.filter((F.col("t") >= low) & (F.col("t") < low + part))
        exposition_lines(mine, t="t").unionByName(types).write.mode("append").text(f"{base}/in")
        stream = stream_exposition(spark, f"{base}/in").select("metric", "labels", "t", "value")
        jobs.run_available(stream, f"{base}/out", f"{base}/checkpoint")
    read = spark.read.schema(stream.schema).parquet(f"{base}/out")
    typed = with_types(read, metric_types(scrape_lines(spark.read.text(f"{base}/in"))))
    return typed.select("metric", "type", *label_columns(F.col("labels"), ["series", "instance"]), "t", "value")


@query("stream_late_rows", """
SELECT count(*) FILTER (WHERE t >= low + (high - low) // 2) AS kept,
       count(*) FILTER (WHERE t < low + (high - low) // 2) AS late
FROM evs CROSS JOIN (SELECT min(t) AS low, max(t) AS high FROM evs) s""")
def stream_late_rows(spark, sf):
    """The later half of the events arrives first; the watermark then drops the other half, and counts it."""
    base, events = scratch_path(spark, "late"), fx.table(spark, sf, "events")
    t = epoch_of_ntz("ts")
    low, high = events.agg(F.min(t), F.max(t)).first()
    middle = (low or 0) + ((high or 0) - (low or 0)) // 2
    for part in (events.filter(t >= middle), events.filter(t < middle)):
        part.write.mode("append").parquet(f"{base}/in")
        rows = jobs.read_files(spark, f"{base}/in", events.schema).withColumn("ts", F.col("ts").cast("timestamp"))
        unique = rows.withWatermark("ts", jobs.WATERMARK).dropDuplicatesWithinWatermark(["event_id"])
        last = jobs.run_available(unique.select("event_id"), f"{base}/out", f"{base}/checkpoint")
    kept = spark.read.schema("event_id bigint").parquet(f"{base}/out")
    return kept.agg(F.count(F.lit(1)).alias("kept")).withColumn("late", F.lit(jobs.late_rows(last)).cast("bigint"))


#: Hours without evaluation every fifth day; infos are no longer evaluated in the last five days.
_OUTAGE = "(t // 3600) % 120 BETWEEN 40 AND 43"
_NO_DATA_S = 9000


@query("stream_alert_states", f"""
WITH pts AS (
  SELECT b.*, CASE severity WHEN 'info' THEN 86400 END AS resolve_s FROM breaches b CROSS JOIN span
  WHERE NOT ({_OUTAGE}) AND (severity <> 'info' OR t < high - 432000)),
steps AS (
  SELECT *, lag(breach) OVER w AS pb, lag(t) OVER w AS pt, lead(t) OVER w AS nt FROM pts
  WINDOW w AS (PARTITION BY rule ORDER BY t)),
runs AS (
  SELECT *, max(CASE WHEN breach AND (NOT coalesce(pb, false) OR t - pt > 3600) THEN t END) OVER (
           PARTITION BY rule ORDER BY t) AS s FROM steps)
SELECT rule AS alert, t, CASE WHEN NOT breach THEN 'ok' WHEN t - s >= for_s THEN 'firing' ELSE 'pending' END AS state,
       CASE WHEN breach THEN s END AS since FROM runs
UNION ALL
SELECT rule, t + {_NO_DATA_S}, 'NoData', NULL FROM steps
WHERE t + {_NO_DATA_S} < nt OR (nt IS NULL AND t + {_NO_DATA_S} < (SELECT max(t) FROM pts) - 3600)
UNION ALL
SELECT rule, t + resolve_s, 'resolved', NULL FROM steps
WHERE t + resolve_s < nt OR (nt IS NULL AND t + resolve_s < (SELECT max(t) FROM pts) - 3600)""")
def stream_alert_states(spark, sf):
    """Evaluated points of all rules, arriving in five parts, each a run that goes on from the checkpoint."""
    base = scratch_path(spark, "alerts")
    _, high = fx.events(spark, sf).agg(F.min("t"), F.max("t")).first()
    high = (high or 0) // 60 * 60 + 60
    outage = (F.floor(F.col("t") / 3600) % 120).between(40, 43)
    points = rule_points(spark, sf).filter(~outage & ((F.col("severity") != "info") | (F.col("t") < high - 432000))).select(
        F.col("rule").alias("alert"), "t", "breach", "for_s", by_severity(AUTO_RESOLVE_S).alias("resolve_s"))
    points = staged(points, "points")
    start, end = fx.span(spark, sf, 3600)
    part = (end - start) // 5 + 1
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, DEFAULTS[provider])
    try:
        for i in range(5):
            low = start + i * part
            points.filter((F.col("t") >= low) & (F.col("t") < low + part)).write.mode("append").parquet(f"{base}/in")
            stream = jobs.read_files(spark, f"{base}/in", points.schema)
            states = alert_stream(stream, None, 3600, 7200, _NO_DATA_S).select("alert", "t", "state", "since")
            jobs.run_available(states, f"{base}/out", f"{base}/checkpoint")
    finally:
        spark.conf.set(provider, before)
    return spark.read.schema(states.schema).parquet(f"{base}/out")


_SCORED = [c for c in SCORED_COLUMNS if c != "run_id"]


@query("stream_scored_posts", f"SELECT {', '.join(_SCORED)} FROM written")
def stream_scored_posts(spark, sf):
    base = scratch_path(spark, "scored")
    store = SeenStore(spark, f"{base}/store")
    store.commit(fx.seen_store(spark, sf), "earlier")
    write = jobs.score_and_store(store, f"{base}/out", LexiconScorer(fx.lexicon(spark)))
    for _ in range(2):
        jobs.each_available(fx.as_posts(_stream(spark, sf, "documents")), write,
                            f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select(*_SCORED)
