"""Queries on metric samples: text form, histograms, gauges, ranges, grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.labels import label_columns, select_labels
from tidemark.functions.status import KPI_BANDS, firing_text, health_text, kpi_band, resource_level
from tidemark.functions.times import parse_duration
from tidemark.operators import aggregates as agg
from tidemark.operators import timeseries as ts
from tidemark.plans import fixtures as fx
from tidemark.plans.registry import query
from tidemark.sources.telemetry import exposition_lines, histogram_samples, parse_exposition

_KEYS = ["series", "instance"]
_HOUR, _WINDOW = 3600, 14400


def _fetched_samples(spark, sf):
    """Posts fetched per community and language, as samples."""
    counts = fx.posts(spark, sf).groupBy("subreddit", "lang").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        F.lit("posts_fetched_total").alias("metric"),
        F.create_map(F.lit("subreddit"), "subreddit", F.lit("lang"), "lang").alias("labels"),
        F.col("n").cast("double").alias("value"))


@query("metrics_exposition", """
SELECT concat('posts_fetched_total{lang="', lang, '",subreddit="', subreddit, '"} ',
              CAST(count(*)::DOUBLE AS VARCHAR)) AS line FROM posts GROUP BY subreddit, lang
UNION ALL
SELECT concat('event_value_bucket{le="', le, '",series="', series, '"} ',
              CAST(c::DOUBLE AS VARCHAR))
FROM (SELECT series, CASE WHEN le = 'Infinity'::DOUBLE THEN '+Inf' ELSE CAST(le AS VARCHAR) END
               AS le, sum(cumulative) AS c FROM buckets GROUP BY series, buckets.le) b
UNION ALL
SELECT concat('event_value_count{series="', event_type, '"} ', CAST(count(*)::DOUBLE AS VARCHAR))
FROM events GROUP BY event_type
UNION ALL
SELECT concat('event_value_sum{series="', event_type, '"} ', CAST(round(sum(value), 2) AS VARCHAR))
FROM events GROUP BY event_type""")
def metrics_exposition(spark, sf):
    ev = fx.events(spark, sf).withColumnRenamed("event_type", "series")
    rows = histogram_samples(
        agg.histogram_buckets(ev, "value", fx.BOUNDS, ["series"]),
        agg.histogram_totals(ev, "value", ["series"]), "event_value", ["series"])
    # Sums depend on the order of addition in their last digits, so hundredths are shown.
    rows = rows.withColumn("value", F.when(F.col("metric") == "event_value_sum", F.round("value", 2))
                           .otherwise(F.col("value")))
    return exposition_lines(_fetched_samples(spark, sf).unionByName(rows))


@query("metrics_parse", """
SELECT 'posts_fetched_total' AS metric, subreddit, lang, count(*)::DOUBLE AS value
FROM posts GROUP BY subreddit, lang""")
def metrics_parse(spark, sf):
    parsed = parse_exposition(exposition_lines(_fetched_samples(spark, sf)))
    return parsed.select("metric", *label_columns(F.col("labels"), ["subreddit", "lang"]), "value")


@query("label_select", """
SELECT subreddit, lang, count(*)::DOUBLE AS value FROM posts
WHERE lang = 'en' AND regexp_full_match(subreddit, 'src1.') GROUP BY subreddit, lang""")
def label_select(spark, sf):
    labels = F.col("labels")
    chosen = _fetched_samples(spark, sf).filter(
        select_labels(labels, {"lang": "en"}, {"subreddit": "src1."}))
    return chosen.select(*label_columns(labels, ["subreddit", "lang"]), "value")


@query("parse_duration", """
SELECT event_id, user_id * (CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 60 WHEN 2 THEN 3600
       ELSE 86400 END) AS seconds FROM events""")
def parse_duration_query(spark, sf):
    unit = F.element_at(F.array(*[F.lit(u) for u in "smhd"]),
                        (F.col("event_id") % 4 + 1).cast("int"))
    text = F.concat(F.col("user_id").cast("string"), unit)
    return fx.events(spark, sf).select("event_id", parse_duration(text).alias("seconds"))


@query("status_map", """
SELECT series, instance, t,
       CASE CAST(value AS BIGINT) % 3 WHEN 0 THEN 'Unhealthy' WHEN 1 THEN 'Healthy' END AS health,
       CASE WHEN value = 0 THEN 'Healthy' WHEN value BETWEEN 1 AND 999 THEN 'Alerting' END
         AS alerts FROM samples""")
def status_map(spark, sf):
    v = F.col("value")
    return fx.samples(spark, sf).select("series", "instance", "t", health_text(v % 3).alias("health"),
                                        firing_text(v).alias("alerts"))


@query("kpi_bands", """
SELECT event_id, kpi, value, CASE
  WHEN kpi = 'posts_per_hour' THEN CASE WHEN value > 50 THEN 'good' WHEN value < 20 THEN 'critical'
       ELSE 'warning' END
  WHEN kpi = 'api_response_seconds' THEN CASE WHEN value < 2 THEN 'good'
       WHEN value > 5 THEN 'critical' ELSE 'warning' END
  WHEN kpi = 'sentiment_seconds' THEN CASE WHEN value < 1 THEN 'good'
       WHEN value > 3 THEN 'critical' ELSE 'warning' END
  WHEN kpi = 'error_rate_percent' THEN CASE WHEN value < 1 THEN 'good'
       WHEN value > 5 THEN 'critical' ELSE 'warning' END
  WHEN kpi = 'cpu_percent' THEN CASE WHEN value < 50 THEN 'good' WHEN value > 80 THEN 'critical'
       ELSE 'warning' END
  WHEN kpi = 'memory_percent' THEN CASE WHEN value < 60 THEN 'good' WHEN value > 85 THEN 'critical'
       ELSE 'warning' END
  WHEN kpi = 'disk_percent' THEN CASE WHEN value < 70 THEN 'good' WHEN value > 90 THEN 'critical'
       ELSE 'warning' END END AS band,
  CASE kpi WHEN 'cpu_percent' THEN CASE WHEN value > 85 THEN 'critical'
       WHEN value > 70 THEN 'warning' ELSE 'ok' END
       WHEN 'memory_percent' THEN CASE WHEN value > 90 THEN 'critical'
       WHEN value > 80 THEN 'warning' ELSE 'ok' END
       WHEN 'disk_percent' THEN CASE WHEN value > 95 THEN 'critical'
       WHEN value > 85 THEN 'warning' ELSE 'ok' END END AS level
FROM (SELECT event_id, value, CASE user_id % 8 WHEN 0 THEN 'posts_per_hour'
        WHEN 1 THEN 'api_response_seconds' WHEN 2 THEN 'sentiment_seconds'
        WHEN 3 THEN 'error_rate_percent' WHEN 4 THEN 'cpu_percent' WHEN 5 THEN 'memory_percent'
        WHEN 6 THEN 'disk_percent' ELSE 'other' END AS kpi FROM events) e""")
def kpi_bands(spark, sf):
    """Every KPI of the table, and one that it does not have."""
    kpi = F.get(F.array(*[F.lit(k) for k in (*KPI_BANDS, "other")]), (F.col("user_id") % 8).cast("int"))
    resource = F.regexp_extract("kpi", "^(cpu|memory|disk)_percent$", 1)
    return fx.events(spark, sf).select("event_id", kpi.alias("kpi"), "value").select(
        "*", kpi_band(F.col("kpi"), F.col("value")).alias("band"),
        resource_level(resource, F.col("value")).alias("level"))


@query("histogram_buckets", "SELECT series, day, le, cumulative FROM buckets")
def histogram_buckets(spark, sf):
    return agg.histogram_buckets(_observations(spark, sf), "value", fx.BOUNDS, ["series", "day"])


def _observations(spark, sf):
    day = (F.col("t") - F.pmod(F.col("t"), F.lit(86400))).alias("day")
    return fx.events(spark, sf).select(F.col("event_type").alias("series"), day, "value")


@query("mean_from_histogram", """
SELECT series, day, round(s, 6) AS sum, n AS count, round(round(s, 6) / n, 6) AS mean FROM (
  SELECT event_type AS series, t - t % 86400 AS day,
         CAST(sum(CAST(value AS DECIMAL(28, 6))) AS DOUBLE) AS s, count(*) AS n
  FROM evs GROUP BY 1, 2) a""")
def mean_from_histogram(spark, sf):
    return agg.histogram_totals(_observations(spark, sf), "value", ["series", "day"])


@query("errors_by_component", """
SELECT component, error_type, count(*) AS errors FROM (
  SELECT instance AS component, concat('code', CAST(user_id % 4 AS VARCHAR)) AS error_type
  FROM evs WHERE event_type = 'error') a GROUP BY 1, 2""")
def errors_by_component(spark, sf):
    errors = fx.events(spark, sf).filter(F.col("event_type") == "error").select(
        F.col("instance").alias("component"),
        F.concat(F.lit("code"), (F.col("user_id") % 4).cast("string")).alias("error_type"))
    return agg.count_by(errors, ["component", "error_type"], "errors")


@query("gauge_latest", """
SELECT instance, arg_max(CASE kind WHEN 'error' THEN 0.0::DOUBLE ELSE 1.0 END, event_id) AS status,
       max(t) AS t
FROM (SELECT instance, event_id, t, CASE event_type WHEN 'error' THEN 'error'
        WHEN 'purchase' THEN 'success' WHEN 'signup' THEN 'reset' ELSE 'api_error' END AS kind
      FROM evs) e WHERE kind <> 'api_error' GROUP BY 1""")
def gauge_latest(spark, sf):
    e = F.col("event_type")
    kind = (F.when(e == "error", "error").when(e == "purchase", "success")
            .when(e == "signup", "reset").otherwise("api_error"))
    writes = agg.status_writes(fx.events(spark, sf).withColumn("kind", kind), "kind")
    return agg.gauge_latest(writes, ["instance"], "status", "t", "event_id")


@query("last_success", """
SELECT instance, max(t) FILTER (WHERE event_type = 'purchase') AS last_success_t
FROM evs GROUP BY 1""")
def last_success(spark, sf):
    return agg.last_success(fx.events(spark, sf), ["instance"],
                            F.col("event_type") == "purchase", "t")


@query("duration_rate", """
WITH totals AS (
  SELECT series, instance, t, sum(cents) OVER w / 100.0::DOUBLE AS s, (sum(n) OVER w)::DOUBLE AS c
  FROM (SELECT event_type AS series, instance, (t // 60 + 1) * 60 AS t, count(*) AS n,
               sum(CAST(round(value * 100) AS BIGINT)) AS cents FROM evs GROUP BY 1, 2, 3) a
  WINDOW w AS (PARTITION BY series, instance, (t - 600) // 144000 ORDER BY t)),
grew AS (
  SELECT series, instance, t, CASE WHEN ps IS NULL THEN 0 WHEN s < ps THEN s ELSE s - ps END AS ds,
         CASE WHEN pc IS NULL THEN 0 WHEN c < pc THEN c ELSE c - pc END AS dc
  FROM (SELECT *, lag(s) OVER w AS ps, lag(c) OVER w AS pc FROM totals
        WINDOW w AS (PARTITION BY series, instance ORDER BY t)) a)
SELECT series, instance, t, round(s / 3600.0::DOUBLE, 6) AS seconds_per_second,
       CASE WHEN c > 0 THEN round(s / c, 6) END AS mean
FROM (SELECT series, instance, t, sum(ds) OVER w AS s, sum(dc) OVER w AS c FROM grew
      WINDOW w AS (PARTITION BY series, instance ORDER BY t RANGE BETWEEN 3599 PRECEDING AND CURRENT ROW)) b""")
def duration_rate(spark, sf):
    """Rate of a histogram's sum and the mean over the last hour, at every scrape."""
    return ts.duration_rate(fx.duration_samples(spark, sf), _KEYS, 3600)


# Ranges ---------------------------------------------------------------------------------------

_RANGE = "sum(delta) OVER (PARTITION BY series, instance ORDER BY t RANGE BETWEEN {} PRECEDING " \
         "AND CURRENT ROW)"


@query("counter_increase", f"SELECT series, instance, t, {_RANGE.format(14399)} AS increase "
                           "FROM deltas")
def counter_increase(spark, sf):
    return ts.counter_increase(fx.samples(spark, sf).drop("metric", ), _KEYS, _WINDOW) \
        .select(*_KEYS, "t", "increase")


@query("counter_rate", f"SELECT series, instance, t, round({_RANGE.format(899)} / 900.0::DOUBLE, 9)"
                       " AS rate FROM deltas")
def counter_rate(spark, sf):
    return ts.counter_rate(fx.samples(spark, sf), _KEYS, 900).select(*_KEYS, "t", "rate")


@query("posts_per_hour", f"""
SELECT series, instance, t, round(round({_RANGE.format(3599)} / 3600.0::DOUBLE, 9)
       * 3600.0::DOUBLE, 6) AS per_hour FROM deltas""")
def posts_per_hour(spark, sf):
    rates = ts.counter_rate(fx.samples(spark, sf), _KEYS, 3600)
    return rates.select(*_KEYS, "t", ts.per_hour(F.col("rate")).alias("per_hour"))


def _grid_increase(spark, sf):
    return ts.increase_on_grid(fx.samples(spark, sf), _KEYS, _WINDOW, *fx.span(spark, sf, _HOUR), _HOUR)


@query("grid_increase", "SELECT series, instance, t, increase FROM grid_increase")
def grid_increase(spark, sf):
    return _grid_increase(spark, sf)


@query("rate_ratio", """
SELECT instance, t, round(sum(increase) FILTER (WHERE series = 'error')
       / nullif(sum(increase) FILTER (WHERE series IN ('view', 'click')), 0) * 100.0::DOUBLE, 6)
       AS error_percent FROM grid_increase GROUP BY 1, 2""")
def rate_ratio(spark, sf):
    s = F.col("series")
    return ts.ratio_of(_grid_increase(spark, sf), s == "error", s.isin("view", "click"),
                       ["instance", "t"], "increase", "error_percent", 100.0)


@query("histogram_quantile", """
SELECT series, day, round(arg_min(q, le), 6) AS quantile FROM (
  SELECT series, day, le, CASE WHEN le = 'Infinity'::DOUBLE THEN low
         ELSE coalesce(low, 0) + (le - coalesce(low, 0)) * (0.95::DOUBLE * total
              - coalesce(below, 0)) / (cumulative - coalesce(below, 0)) END AS q
  FROM (SELECT *, lag(le) OVER w AS low, lag(cumulative) OVER w AS below,
               max(cumulative) OVER (PARTITION BY series, day) AS total
        FROM buckets WINDOW w AS (PARTITION BY series, day ORDER BY le)) a
  WHERE cumulative >= 0.95::DOUBLE * total AND total > 0) b GROUP BY 1, 2""")
def histogram_quantile(spark, sf):
    buckets = agg.histogram_buckets(_observations(spark, sf), "value", fx.BOUNDS,
                                    ["series", "day"])
    return ts.histogram_quantile(buckets, 0.95, ["series", "day"])


def _rate_quantile_oracle(by, q):
    own = f"{by}, " if by else ""
    same = " AND ".join(f"d.{k} = g.{k}" for k in by.split(", ")) if by else "true"
    return f"""
WITH grid AS (
  SELECT s.*, h.t, b.le FROM (SELECT DISTINCT {by or "0 AS one"} FROM bucket_samples) s CROSS JOIN hours h
  CROSS JOIN (SELECT DISTINCT le FROM bucket_samples) b),
grown AS (
  SELECT {"g." + by.replace(", ", ", g.") + ", " if by else ""}g.t, g.le, coalesce(sum(d.delta), 0.0)::DOUBLE AS n
  FROM grid g LEFT JOIN bucket_growth d ON {same} AND d.le = g.le AND d.t > g.t - 14400 AND d.t <= g.t
  GROUP BY ALL),
raised AS (
  SELECT *, max(n) OVER (PARTITION BY {own}t ORDER BY le) AS c FROM grown),
placed AS (
  SELECT *, lag(le) OVER w AS low, coalesce(lag(c) OVER w, 0) AS below, max(c) OVER (PARTITION BY {own}t) AS total
  FROM raised WINDOW w AS (PARTITION BY {own}t ORDER BY le))
SELECT {own}t, round(arg_min(CASE WHEN le = 'Infinity'::DOUBLE THEN low ELSE coalesce(low, 0) + (le - coalesce(low, 0))
       * ({q}::DOUBLE * total - below) / (c - below) END, le), 6) AS quantile
FROM placed WHERE total > 0 AND c >= {q}::DOUBLE * total GROUP BY {own}t"""


@query("histogram_quantile_rate", _rate_quantile_oracle("series, instance", 0.95))
def histogram_quantile_rate(spark, sf):
    """The 95th percentile over the last four hours, at every hour, per series."""
    return ts.quantile_of_rates(fx.bucket_samples(spark, sf), 0.95, _KEYS, [*fx.BOUNDS, float("inf")],
                                _WINDOW, *fx.span(spark, sf, _HOUR), _HOUR)


@query("histogram_quantile_rate_by", _rate_quantile_oracle("series", 0.5))
def histogram_quantile_rate_by(spark, sf):
    """The median per event type: growth of all instances summed before the quantile."""
    return ts.quantile_of_rates(fx.bucket_samples(spark, sf), 0.5, _KEYS, [*fx.BOUNDS, float("inf")],
                                _WINDOW, *fx.span(spark, sf, _HOUR), _HOUR, by=["series"])


@query("usage_percent", """
SELECT instance, t, round((max(value) FILTER (WHERE metric = 'mem_total')
         - max(value) FILTER (WHERE metric = 'mem_free'))
       / max(value) FILTER (WHERE metric = 'mem_total') * 100.0::DOUBLE, 6) AS used_percent
FROM gauges GROUP BY 1, 2""")
def usage_percent(spark, sf):
    return ts.used_percent(fx.gauges(spark, sf), ["instance", "t"], "metric", "mem_total",
                           "mem_free", "value")


@query("cpu_usage", """
SELECT t, round(100.0::DOUBLE - avg(CAST(round(increase / 14400.0::DOUBLE, 9) AS DECIMAL(28, 9)))
       ::DOUBLE * 100.0::DOUBLE, 6) AS busy_percent FROM grid_increase GROUP BY 1""")
def cpu_usage(spark, sf):
    rates = ts.rate_on_grid(fx.samples(spark, sf), _KEYS, _WINDOW, *fx.span(spark, sf, _HOUR), _HOUR)
    return ts.busy_percent(rates, ["t"])


@query("asof_grid", """
SELECT series, instance, g.t, max(s.t) AS sample_t, arg_max(s.value, s.t) AS value
FROM (SELECT unnest(range(low // 60 * 60, high + 1, 60)) AS t FROM span) g
JOIN samples s ON s.t <= g.t AND s.t > g.t - 300 GROUP BY 1, 2, 3""")
def asof_grid(spark, sf):
    return ts.asof_grid(fx.samples(spark, sf), _KEYS, *fx.span(spark, sf, 60), step_s=60)


@query("recording_rules", """
SELECT record, instance, t, value FROM (
  SELECT CASE metric WHEN 'posts_processed_total' THEN 'reddit:posts_processed_rate'
         WHEN 'sentiment_analyses_total' THEN 'reddit:sentiment_analysis_rate'
         ELSE 'reddit:api_error_rate' END AS record, instance, t, rate AS value FROM named_rates
  WHERE metric IN ('posts_processed_total', 'sentiment_analyses_total', 'reddit_api_errors_total')
  UNION ALL
  SELECT 'reddit:duplication_rate', instance, t,
         round(sum(rate) FILTER (WHERE metric = 'duplicates_found_total')
               / nullif(sum(rate) FILTER (WHERE metric = 'posts_fetched_total'), 0), 6)
  FROM named_rates WHERE metric IN ('duplicates_found_total', 'posts_fetched_total') GROUP BY 2, 3
  UNION ALL
  SELECT 'system:cpu_usage', '', t, round(100.0::DOUBLE
         - (sum(CAST(rate AS DECIMAL(28, 9)))::DOUBLE / count(*)) * 100.0::DOUBLE, 6)
  FROM named_rates WHERE metric = 'node_cpu_seconds_total' GROUP BY 3
  UNION ALL
  SELECT CASE metric WHEN 'node_memory_MemTotal_bytes' THEN 'system:memory_usage'
              ELSE 'system:disk_usage' END, instance, t,
         round((a.value - f.value) / a.value * 100.0::DOUBLE, 6)
  FROM named_asof a JOIN (SELECT t, instance, metric AS free, value FROM named_asof) f
    USING (t, instance)
  WHERE (metric = 'node_memory_MemTotal_bytes' AND free = 'node_memory_MemAvailable_bytes')
     OR (metric = 'node_filesystem_size_bytes' AND free = 'node_filesystem_free_bytes')) r""")
def recording_rules(spark, sf):
    return ts.recording_rules(fx.metric_samples(spark, sf), ts.RECORDINGS, ["instance"],
                              *fx.span(spark, sf, _HOUR), _HOUR, _WINDOW)


@query("staleness", """
SELECT series, instance, max(t) AS last_t, 1706745600 - max(t) AS age_s,
       1706745600 - max(t) > 86400 AS stale FROM samples GROUP BY 1, 2""")
def staleness(spark, sf):
    return ts.staleness(fx.samples(spark, sf), _KEYS, "t", fx.AS_OF, 86400)


@query("no_activity", "SELECT series, instance, t, increase FROM grid_increase WHERE increase = 0")
def no_activity(spark, sf):
    return ts.no_activity(_grid_increase(spark, sf))
