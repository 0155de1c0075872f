"""The fixture views in DuckDB's dialect, to check results against.

``sql(body)`` puts the views a query names in front of it.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}

VIEWS["posts"] = """
SELECT doc_id AS arrival_seq, concat('p', CAST(doc_id AS VARCHAR)) AS post_id,
       split_part(text, chr(10), 1) AS title,
       substring(text, length(split_part(text, chr(10), 1)) + 2) AS content,
       n_chars AS score, 1704067200 + doc_id * 60 AS created_utc, source AS subreddit, lang,
       concat('https://example.test/p/', CAST(doc_id AS VARCHAR)) AS url,
       doc_id % 50 AS num_comments
FROM documents"""

VIEWS["posts_hashed"] = """
SELECT *, sha256(concat(coalesce(title, ''), chr(10), coalesce(content, ''))) AS content_hash
FROM posts"""

VIEWS["posts_edited"] = """
SELECT arrival_seq, concat('p', CAST(arrival_seq % 70 AS VARCHAR)) AS post_id, content_hash
FROM posts_hashed"""

VIEWS["seen_store"] = """
SELECT post_id, content_hash, title, subreddit, created_utc, created_utc AS first_seen_utc
FROM posts_hashed WHERE arrival_seq % 5 = 0
QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY arrival_seq) = 1"""

VIEWS["tagged"] = """
SELECT p.*, (s.content_hash IS NOT NULL OR row_number() OVER (
           PARTITION BY p.content_hash ORDER BY p.arrival_seq) > 1) AS is_duplicate
FROM posts_hashed p LEFT JOIN (SELECT DISTINCT content_hash FROM seen_store) s
  ON p.content_hash = s.content_hash"""

VIEWS["texts"] = r"""
SELECT arrival_seq, subreddit, lang,
       substring(regexp_replace(CASE WHEN content <> '' THEN concat(title, '. ', content)
                                     ELSE title END,
         '^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$', '', 'g'), 1, 400) AS text
FROM posts"""

VIEWS["whole_texts"] = r"""
SELECT arrival_seq, subreddit, lang,
       regexp_replace(CASE WHEN content <> '' THEN concat(title, '. ', content) ELSE title END,
         '^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$', '', 'g') AS text
FROM posts"""

VIEWS["lexicon"] = """
SELECT * FROM (VALUES ('of', 1), ('to', 1), ('is', 1), ('et', 1), ('les', 1), ('und', 1),
  ('von', 1), ('que', 1), ('and', -1), ('in', -1), ('that', -1), ('le', -1), ('un', -1),
  ('die', -1), ('los', -1)) AS t(token, polarity)"""

VIEWS["scored"] = r"""
SELECT arrival_seq, subreddit, lang,
       round(pos / (pos + neg + 1.0::DOUBLE), 6) AS positive,
       round(neg / (pos + neg + 1.0::DOUBLE), 6) AS negative,
       round(1 / (pos + neg + 1.0::DOUBLE), 6) AS neutral,
       CASE WHEN pos >= neg AND pos >= 1 THEN 'positive' WHEN neg >= 1 THEN 'negative'
            ELSE 'neutral' END AS label
FROM (SELECT t.arrival_seq, t.subreddit, t.lang,
             sum(CASE WHEN l.polarity = 1 THEN 1 ELSE 0 END) AS pos,
             sum(CASE WHEN l.polarity = -1 THEN 1 ELSE 0 END) AS neg
      FROM (SELECT arrival_seq, subreddit, lang,
                   unnest(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS token
            FROM whole_texts) t
      LEFT JOIN lexicon l ON t.token = l.token
      GROUP BY t.arrival_seq, t.subreddit, t.lang) c"""

VIEWS["written"] = """
SELECT p.post_id, p.title, p.content, p.score, p.created_utc, p.subreddit, p.url, p.num_comments,
       s.label AS sentiment_label, greatest(s.positive, s.negative, s.neutral)
         AS sentiment_confidence,
       s.positive AS sentiment_positive, s.negative AS sentiment_negative,
       s.neutral AS sentiment_neutral,
       greatest(s.positive, s.negative, s.neutral) AS sentiment_score, 'run-1' AS run_id
FROM tagged p JOIN scored s ON p.arrival_seq = s.arrival_seq WHERE NOT p.is_duplicate"""

VIEWS["scored_posts"] = """
SELECT p.arrival_seq, p.post_id, p.title, p.content, p.created_utc, p.subreddit, p.content_hash,
       s.label AS sentiment_label, greatest(s.positive, s.negative, s.neutral) AS sentiment_score
FROM posts_hashed p JOIN scored s ON p.arrival_seq = s.arrival_seq"""

VIEWS["evs"] = """
SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS t, concat('i', CAST(user_id % 3 AS VARCHAR))
       AS instance
FROM events"""

VIEWS["samples"] = """
SELECT 'app_events_total' AS metric, series, instance, t,
       CAST(sum(n) OVER (PARTITION BY series, instance ORDER BY t) % 300 AS DOUBLE) AS value
FROM (SELECT event_type AS series, instance, (t // 60 + 1) * 60 AS t, count(*) AS n
      FROM evs GROUP BY 1, 2, 3) a"""

VIEWS["deltas"] = """
SELECT *, CASE WHEN prev IS NULL THEN 0.0 WHEN value < prev THEN value
               ELSE value - prev END::DOUBLE AS delta
FROM (SELECT *, lag(value) OVER (PARTITION BY series, instance ORDER BY t) AS prev
      FROM samples) a"""

VIEWS["span"] = "SELECT min(t) AS low, max(t) // 60 * 60 + 60 AS high FROM evs"

VIEWS["hours"] = """
SELECT unnest(range(low // 3600 * 3600, (high + 3599) // 3600 * 3600 + 1, 3600)) AS t FROM span"""

VIEWS["grid_increase"] = """
SELECT g.series, g.instance, g.t, coalesce(sum(d.delta), 0.0)::DOUBLE AS increase
FROM (SELECT s.series, s.instance, h.t FROM (SELECT DISTINCT series, instance FROM samples) s
      CROSS JOIN hours h) g
LEFT JOIN deltas d ON d.series = g.series AND d.instance = g.instance
  AND d.t > g.t - 14400 AND d.t <= g.t
GROUP BY g.series, g.instance, g.t"""

VIEWS["gauges"] = """
SELECT instance, t, 'mem_total' AS metric, 300.0::DOUBLE AS value FROM samples
WHERE series = 'view'
UNION ALL
SELECT instance, t, 'mem_free', 300.0::DOUBLE - value FROM samples WHERE series = 'view'"""

VIEWS["named"] = """
SELECT instance, t, m.metric, CASE m.how WHEN 'v' THEN value WHEN 'c' THEN m.k ELSE
         CASE m.how WHEN 'x' THEN value * m.k ELSE m.k - value END END::DOUBLE AS value
FROM samples JOIN (VALUES
  ('view', 'posts_processed_total', 'v', 0), ('view', 'node_memory_MemTotal_bytes', 'c', 300),
  ('view', 'node_memory_MemAvailable_bytes', 'r', 300),
  ('click', 'sentiment_analyses_total', 'v', 0), ('click', 'node_filesystem_size_bytes', 'c', 400),
  ('click', 'node_filesystem_free_bytes', 'r', 400),
  ('error', 'reddit_api_errors_total', 'v', 0), ('signup', 'duplicates_found_total', 'v', 0),
  ('purchase', 'posts_fetched_total', 'v', 0), ('purchase', 'node_cpu_seconds_total', 'x', 16)
) AS m(series, metric, how, k) ON samples.series = m.series"""

VIEWS["rule_samples"] = """
SELECT CASE instance WHEN 'i2' THEN 'other' ELSE 'pipeline' END AS job,
       CASE instance WHEN 'i1' THEN 'other' ELSE 'pipeline' END AS service, instance, t, name AS metric,
       CASE name WHEN 'node_memory_MemTotal_bytes' THEN 300 WHEN 'node_filesystem_size_bytes' THEN 300
         WHEN 'node_memory_MemAvailable_bytes' THEN 300 - value
         WHEN 'node_filesystem_free_bytes' THEN 300 - value
         WHEN 'up' THEN CASE WHEN value % 50 >= 2 THEN 1 ELSE 0 END
         WHEN 'cpu_usage_percent' THEN value / 3 WHEN 'memory_usage_percent' THEN value / 3
         WHEN 'disk_usage_percent' THEN value / 3 WHEN 'log_errors_total' THEN floor(value / 2)
         WHEN 'sentiment_analysis_errors_total' THEN floor(value / 4) WHEN 'errors_total' THEN value * 40
         WHEN 'backup_last_success_timestamp' THEN t - value * 600
         WHEN 'database_connection_errors_total' THEN floor(value / 250)
         WHEN 'kube_job_status_start_time' THEN t - value * 20 ELSE value END::DOUBLE AS value
FROM samples JOIN (VALUES
  ('view', 'posts_processed_total'), ('view', 'node_memory_MemTotal_bytes'),
  ('view', 'node_memory_MemAvailable_bytes'), ('view', 'up'), ('view', 'cpu_usage_percent'),
  ('click', 'node_filesystem_size_bytes'), ('click', 'node_filesystem_free_bytes'),
  ('click', 'memory_usage_percent'), ('click', 'log_errors_total'), ('error', 'reddit_api_errors_total'),
  ('error', 'sentiment_analysis_errors_total'), ('error', 'errors_total'),
  ('signup', 'duplicates_found_total'), ('signup', 'backup_last_success_timestamp'),
  ('purchase', 'posts_fetched_total'), ('purchase', 'disk_usage_percent'),
  ('purchase', 'database_connection_errors_total'), ('purchase', 'kube_job_status_start_time')
) AS m(series, name) ON samples.series = m.series"""

VIEWS["named_rates"] = """
SELECT g.metric, g.instance, g.t, round(coalesce(sum(d.delta), 0.0) / 14400.0::DOUBLE, 9) AS rate
FROM (SELECT s.metric, s.instance, h.t FROM (SELECT DISTINCT metric, instance FROM named) s
      CROSS JOIN hours h) g
LEFT JOIN (SELECT *, CASE WHEN prev IS NULL THEN 0.0 WHEN value < prev THEN value
                          ELSE value - prev END::DOUBLE AS delta
           FROM (SELECT *, lag(value) OVER (PARTITION BY metric, instance ORDER BY t) AS prev
                 FROM named) a) d
  ON d.metric = g.metric AND d.instance = g.instance AND d.t > g.t - 14400 AND d.t <= g.t
GROUP BY g.metric, g.instance, g.t"""

VIEWS["named_asof"] = """
SELECT h.t, d.metric, d.instance, max_by(d.value, d.t) AS value
FROM hours h JOIN named d ON d.t > h.t - 300 AND d.t <= h.t
GROUP BY h.t, d.metric, d.instance"""

VIEWS["buckets"] = """
SELECT series, day, b.le, CAST(sum(CASE WHEN value <= b.le THEN 1 ELSE 0 END) AS BIGINT)
       AS cumulative
FROM (SELECT event_type AS series, t - t % 86400 AS day, value FROM evs) o
CROSS JOIN (VALUES (1.0::DOUBLE), (5.0), (10.0), (25.0), (50.0), (100.0), (200.0),
            ('Infinity'::DOUBLE)) AS b(le)
GROUP BY series, day, b.le"""

VIEWS["bucket_samples"] = """
SELECT series, instance, t, le, CAST(sum(n) OVER (
         PARTITION BY series, instance, le, (t - 600) // 144000 ORDER BY t) AS DOUBLE) AS value
FROM (SELECT event_type AS series, instance, (t // 60 + 1) * 60 AS t, b.le,
             sum(CASE WHEN value <= b.le THEN 1 ELSE 0 END) AS n
      FROM evs CROSS JOIN (VALUES (1.0::DOUBLE), (5.0), (10.0), (25.0), (50.0), (100.0), (200.0),
                           ('Infinity'::DOUBLE)) AS b(le) GROUP BY ALL) a
QUALIFY le <> 25 OR t // 60 % 7 <> 0"""

VIEWS["bucket_growth"] = """
SELECT series, instance, le, t, CASE WHEN prev IS NULL THEN 0.0 WHEN value < prev THEN value
       ELSE value - prev END::DOUBLE AS delta
FROM (SELECT *, lag(value) OVER (PARTITION BY series, instance, le ORDER BY t) AS prev
      FROM bucket_samples) a"""

VIEWS["hourly_grid"] = """
SELECT s.series, h.t, CAST(coalesce(n, 0) AS BIGINT) AS n
FROM (SELECT DISTINCT event_type AS series FROM evs) s
CROSS JOIN (SELECT unnest(range(min(t) // 3600 * 3600, max(t) // 3600 * 3600 + 1, 3600)) AS t
            FROM evs) h
LEFT JOIN (SELECT event_type AS series, t - t % 3600 AS t, count(*) AS n FROM evs GROUP BY 1, 2) c
  ON c.series = s.series AND c.t = h.t"""

VIEWS["rules"] = """
SELECT * FROM (VALUES ('ErrorsBusy', 'error_per_hour', '>', 2.0::DOUBLE, 7200, 'warning'),
  ('ErrorsFlood', 'error_per_hour', '>=', 5.0, 0, 'critical'),
  ('ViewsBusy', 'view_per_hour', '>', 2.0, 7200, 'warning'),
  ('ClicksFew', 'click_per_hour', '<=', 1.0, 7200, 'warning'),
  ('SignupsSome', 'signup_per_hour', '!=', 0.0, 3600, 'info'),
  ('PurchasesSilent', 'purchase_per_hour', '==', 0.0, 3600, 'warning'),
  ('PurchasesLow', 'purchase_per_hour', '<', 3.0, 10800, 'warning'))
  AS t(rule, metric, comparator, threshold, for_s, severity)"""

VIEWS["breaches"] = """
SELECT r.rule, g.series, g.t, CAST(g.n AS DOUBLE) AS value, r.for_s, r.severity,
       CASE r.comparator WHEN '>' THEN g.n > r.threshold WHEN '>=' THEN g.n >= r.threshold
            WHEN '<' THEN g.n < r.threshold WHEN '<=' THEN g.n <= r.threshold
            WHEN '!=' THEN g.n <> r.threshold ELSE g.n = r.threshold END AS breach
FROM hourly_grid g JOIN rules r ON r.metric = concat(g.series, '_per_hour')"""

VIEWS["held"] = """
SELECT *, CASE WHEN breach THEN min(CASE WHEN breach THEN t END) OVER (
           PARTITION BY rule, series, grp) END AS since
FROM (SELECT *, sum(CASE WHEN breach AND NOT coalesce(pb, false) THEN 1 ELSE 0 END) OVER (
               PARTITION BY rule, series ORDER BY t) AS grp
      FROM (SELECT *, lag(breach) OVER (PARTITION BY rule, series ORDER BY t) AS pb
            FROM breaches) a) b"""

VIEWS["states"] = """
SELECT *, CASE WHEN NOT breach THEN 'ok' WHEN t - since >= for_s THEN 'firing'
               ELSE 'pending' END AS state FROM held"""

VIEWS["alert_events"] = """
SELECT event_id, t, concat('alert_', event_type) AS alertname,
       CASE WHEN user_id % 3 = 0 THEN 'critical' WHEN user_id % 3 = 1 THEN 'warning'
            ELSE 'info' END AS severity,
       concat('svc', CAST(user_id % 5 AS VARCHAR)) AS service,
       concat('i', CAST(user_id % 7 AS VARCHAR)) AS instance,
       CASE WHEN CAST(props->>'$.k' AS INT) % 2 = 0 THEN 'firing' ELSE 'resolved' END AS status
FROM evs"""

VIEWS["identified"] = """
SELECT *, substring(md5(concat(alertname, '-', service, '-', instance)), 1, 8) AS alert_id
FROM alert_events"""

VIEWS["changes"] = """
SELECT * FROM (
  SELECT *, lag(status) OVER (PARTITION BY alertname, service, instance, severity
                              ORDER BY t, event_id) AS was
  FROM alert_events) a
WHERE (status = 'firing') <> (coalesce(was, 'resolved') = 'firing')"""

VIEWS["episodes"] = """
SELECT alertname, service, instance, severity, event_id AS incident_no, t AS start_t, end_t FROM (
  SELECT *, lead(t) OVER (PARTITION BY alertname, service, instance, severity
                          ORDER BY t, event_id) AS end_t FROM changes) a
WHERE status = 'firing'"""

VIEWS["policy"] = """
SELECT * FROM (VALUES ('critical', 1, 0), ('critical', 2, 300), ('critical', 3, 900),
  ('warning', 1, 0), ('warning', 2, 1800), ('warning', 3, 7200),
  ('info', 1, 0), ('info', 2, 86400)) AS t(severity, step, delay_s)"""

VIEWS["health_checks"] = """
SELECT event_type AS component, event_id, t, value <= 20 AS healthy FROM evs"""

VIEWS["log_lines"] = """
SELECT event_id AS seq, ts, t, concat('file', CAST(user_id % 3 AS VARCHAR)) AS file,
       concat(CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'signup' THEN 'WARNING'
              ELSE 'INFO' END, ' user=', CAST(user_id AS VARCHAR), ' ', props) AS line
FROM evs"""

VIEWS["manifest_old"] = """
SELECT concat(source, '/', CAST(doc_id AS VARCHAR)) AS path, n_chars AS size,
       md5(text) AS checksum
FROM documents"""

VIEWS["manifest_new"] = """
SELECT concat(source, '/', CAST(CASE WHEN doc_id % 13 = 0 THEN doc_id + 1000000 ELSE doc_id END
              AS VARCHAR)) AS path,
       n_chars AS size, CASE WHEN doc_id % 11 = 0 THEN md5(concat(text, '!')) ELSE md5(text) END
       AS checksum
FROM documents WHERE doc_id % 7 <> 0"""

VIEWS["snapshots"] = """
SELECT concat('s', CAST(doc_id AS VARCHAR)) AS name,
       CASE doc_id % 4 WHEN 0 THEN 'daily' WHEN 1 THEN 'weekly' WHEN 2 THEN 'monthly'
            ELSE 'manual' END AS type,
       1706745600 - (doc_id % 500) * 86400 - 3600 AS created_t
FROM documents"""


def sql(body: str) -> str:
    """``body`` with every view it needs in front, each after the views it reads."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in VIEWS:
            if name not in order and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                need(VIEWS[name])
                if name not in order:
                    order.append(name)

    need(body)
    if not order:
        return body.strip()
    views = ",\n".join(f"{n} AS MATERIALIZED ({VIEWS[n].strip()})" for n in order)
    body = body.strip()
    for start in ("WITH RECURSIVE", "WITH"):
        if body.startswith(start):
            return f"{start} {views},\n{body[len(start):].strip()}"
    return f"WITH {views}\n{body}"
