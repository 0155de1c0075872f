"""Queries on alerts, incidents, health and logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.incidents import alert_fingerprint, incident_labels, incident_title
from tidemark.functions.status import log_classes
from tidemark.operators import aggregates as agg
from tidemark.operators import alerting as al
from tidemark.operators import logs
from tidemark.operators import timeseries as ts
from tidemark.operators.rules import (
    APPLICATION_RULES,
    CHANNEL_CAPS,
    COOLDOWN_S,
    DASHBOARD_RULES,
    DEFAULT_CHANNEL,
    DEFAULT_RECEIVER,
    ESCALATION,
    ESCALATION_CAPS,
    ESCALATION_SCHEMA,
    GROUP_BY,
    GROUP_INTERVAL_S,
    GROUP_WAIT_DEFAULT_S,
    GROUP_WAIT_S,
    INHIBIT_BY_ALERT,
    INHIBIT_BY_SERVICE,
    JOB_RULES,
    METRIC_RULES,
    REPEAT_DEFAULT_S,
    REPEAT_S,
    RESOLVE_TIMEOUT_S,
    RULE_SCHEMA,
    THROTTLE_S,
    by_severity,
    channel_routes,
    for_service,
    log_thresholds,
    receiver_routes,
)
from tidemark.plans import fixtures as fx
from tidemark.plans.registry import query
from tidemark.session import scratch_path, values_frame
from tidemark.sources.telemetry import explode_payloads, parse_log_lines, write_status

_ALERT = ["alertname", "service", "instance"]
_SERIES = ["rule", "series"]

#: Rules on the events of an hour.
_RULES = [
    ("ErrorsBusy", "error_per_hour", "value", 0, ">", 2.0, 7200, "warning"),
    ("ErrorsFlood", "error_per_hour", "value", 0, ">=", 5.0, 0, "critical"),
    ("ViewsBusy", "view_per_hour", "value", 0, ">", 2.0, 7200, "warning"),
    ("ClicksFew", "click_per_hour", "value", 0, "<=", 1.0, 7200, "warning"),
    ("SignupsSome", "signup_per_hour", "value", 0, "!=", 0.0, 3600, "info"),
    ("PurchasesSilent", "purchase_per_hour", "value", 0, "==", 0.0, 3600, "warning"),
    ("PurchasesLow", "purchase_per_hour", "value", 0, "<", 3.0, 10800, "warning"),
]


def rule_points(spark, sf):
    series = fx.hourly_grid(spark, sf).select(
        F.concat("series", F.lit("_per_hour")).alias("metric"), F.lit("value").alias("func"),
        F.lit(0).cast("bigint").alias("window_s"), "series", "t",
        F.col("n").cast("double").alias("value"))
    return al.evaluate_rules(series, values_frame(spark, RULE_SCHEMA, _RULES))


def _states(spark, sf):
    return al.hold_for(rule_points(spark, sf), _SERIES)


def _episodes(spark, sf):
    return al.incident_episodes(fx.alert_events(spark, sf), [*_ALERT, "severity"])


# Rules ----------------------------------------------------------------------------------------

@query("rule_breaches", "SELECT rule, series, t, value, breach FROM breaches")
def rule_breaches(spark, sf):
    return rule_points(spark, sf).select(*_SERIES, "t", "value", "breach")


def _configured():
    """Every rule of the four configurations, for the service ``pipeline``."""
    return for_service([*METRIC_RULES, *APPLICATION_RULES, *DASHBOARD_RULES, *JOB_RULES], "pipeline")


def _configured_oracle():
    def text(v):
        return "NULL" if v is None else f"{v!r}::DOUBLE" if isinstance(v, float) else repr(v)

    rows = ",\n  ".join(f"({', '.join(text(v) for v in r[:10])})" for r in _configured())
    return f"""
WITH configured AS (
  SELECT * FROM (VALUES {rows}) AS c(rule, metric, func, width, cmp, threshold, for_s, severity, label, label_is)),
quarters AS (
  SELECT unnest(range(low // 900 * 900, (high + 899) // 900 * 900 + 1, 900)) AS t FROM span),
growth AS (
  SELECT *, CASE WHEN prev IS NULL THEN 0.0 WHEN value < prev THEN value ELSE value - prev END::DOUBLE AS delta
  FROM (SELECT *, lag(value) OVER (PARTITION BY metric, instance ORDER BY t) AS prev FROM rule_samples) a),
latest AS (
  SELECT d.metric, d.job, d.service, d.instance, g.t, arg_max(d.value, d.t) AS value
  FROM quarters g JOIN rule_samples d ON d.t > g.t - 300 AND d.t <= g.t GROUP BY ALL),
grew AS (
  SELECT s.metric, s.job, s.service, s.instance, w.width, g.t, coalesce(sum(d.delta), 0.0)::DOUBLE AS n
  FROM (SELECT DISTINCT metric, job, service, instance FROM rule_samples) s
  JOIN (SELECT DISTINCT metric, width FROM configured WHERE func IN ('increase', 'rate') UNION
        SELECT unnest(['duplicates_found_total', 'posts_fetched_total']), 300) w ON w.metric = s.metric
  CROSS JOIN quarters g
  LEFT JOIN growth d ON d.metric = s.metric AND d.instance = s.instance AND d.t > g.t - w.width AND d.t <= g.t
  GROUP BY ALL),
series AS (
  SELECT c.rule, job, service, instance, t, CASE func WHEN 'age' THEN t - value ELSE value END AS value
  FROM configured c JOIN latest USING (metric) WHERE func IN ('value', 'age')
  UNION ALL
  SELECT c.rule, job, service, instance, t, CASE func WHEN 'rate' THEN round(n / c.width::DOUBLE, 9) ELSE n END
  FROM configured c JOIN grew USING (metric, width) WHERE func IN ('increase', 'rate')
  UNION ALL
  SELECT c.rule, a.job, a.service, a.instance, a.t, round((a.value - f.value) / a.value * 100.0::DOUBLE, 6)
  FROM configured c JOIN latest a ON a.metric = CASE c.metric WHEN 'system:memory_usage' THEN 'node_memory_MemTotal_bytes'
         WHEN 'system:disk_usage' THEN 'node_filesystem_size_bytes' END
  JOIN latest f ON f.t = a.t AND f.instance = a.instance AND f.metric = CASE c.metric WHEN 'system:memory_usage'
         THEN 'node_memory_MemAvailable_bytes' ELSE 'node_filesystem_free_bytes' END
  UNION ALL
  SELECT c.rule, a.job, a.service, a.instance, a.t,
         round(round(a.n / 300.0::DOUBLE, 9) / round(b.n / 300.0::DOUBLE, 9) * 100.0::DOUBLE, 6)
  FROM configured c JOIN grew a ON a.metric = 'duplicates_found_total' AND a.width = 300
  JOIN grew b ON b.metric = 'posts_fetched_total' AND b.width = 300 AND b.t = a.t AND b.instance = a.instance
  WHERE c.metric = 'duplication_percent' AND b.n > 0),
points AS (
  SELECT s.*, c.for_s, CASE cmp WHEN '>' THEN value > threshold WHEN '==' THEN value = threshold END AS breach
  FROM series s JOIN configured c USING (rule)
  WHERE c.label IS NULL OR c.label_is = CASE c.label WHEN 'job' THEN s.job WHEN 'service' THEN s.service END),
marked AS (
  SELECT *, breach AND (NOT coalesce(lag(breach) OVER w, false) OR t - lag(t) OVER w > 900) AS begins
  FROM points WINDOW w AS (PARTITION BY rule, instance ORDER BY t)),
since AS (
  SELECT *, max(CASE WHEN begins THEN t END) OVER (PARTITION BY rule, instance ORDER BY t) AS since FROM marked)
SELECT rule, instance, t, value, breach, CASE WHEN NOT breach THEN 'ok' WHEN t - since >= for_s THEN 'firing'
       ELSE 'pending' END AS state FROM since
UNION ALL
SELECT rule, NULL, t, NULL, false, 'NoData' FROM configured CROSS JOIN quarters
WHERE NOT EXISTS (FROM points p WHERE p.rule = configured.rule AND p.t = quarters.t)"""


@query("configured_rules", _configured_oracle())
def configured_rules(spark, sf):
    """All 35 rules from one table of the series they read."""
    keys, grid = ["job", "service", "instance"], fx.span(spark, sf, 900)
    rules = values_frame(spark, RULE_SCHEMA, _configured())
    series = ts.rule_series(fx.rule_samples(spark, sf), _configured(), keys, *grid, 900,
                            recordings=[*ts.RECORDINGS, ts.DUPLICATION])
    series = series.withColumn("labels", F.create_map(*[x for k in keys for x in (F.lit(k), F.col(k))]))
    return al.rule_states(series, rules, keys, *grid, 900).select("rule", "instance", "t", "value", "breach", "state")


@query("alert_for_duration", "SELECT rule, series, t, since, state FROM states")
def alert_for_duration(spark, sf):
    return _states(spark, sf).select(*_SERIES, "t", "since", "state")


@query("alert_intervals", """
SELECT rule, series, since AS start_t, max(t) AS end_t, max(value) AS peak FROM states
WHERE since IS NOT NULL GROUP BY 1, 2, 3 HAVING bool_or(state = 'firing')""")
def alert_intervals(spark, sf):
    return al.alert_intervals(_states(spark, sf), _SERIES)


@query("alert_nodata", """
SELECT series, t, CASE WHEN n = 0 THEN NULL ELSE n END AS n,
       CASE WHEN n = 0 THEN 'NoData' ELSE 'Normal' END AS data_state FROM hourly_grid""")
def alert_nodata(spark, sf):
    grid = fx.hourly_grid(spark, sf).select("series", "t")
    return al.no_data(grid, fx.hourly_counts(spark, sf), ["series"], "t", "n")


# Notification flow ----------------------------------------------------------------------------

def _inhibit_oracle(equal):
    same = " AND ".join(f"c.{k} = e.{k}" for k in equal)
    return f"""
SELECT e.event_id, e.severity FROM alert_events e
WHERE e.status = 'firing' AND NOT (e.severity = 'warning' AND EXISTS (
  SELECT 1 FROM episodes c WHERE c.severity = 'critical' AND {same}
    AND c.start_t <= e.t AND (c.end_t IS NULL OR c.end_t > e.t)))"""


@query("alert_inhibit", _inhibit_oracle(INHIBIT_BY_SERVICE))
def alert_inhibit(spark, sf):
    return al.inhibit(fx.alert_events(spark, sf), INHIBIT_BY_SERVICE, _ALERT).select(
        "event_id", "severity")


@query("alert_inhibit_same_alert", _inhibit_oracle(INHIBIT_BY_ALERT))
def alert_inhibit_same_alert(spark, sf):
    return al.inhibit(fx.alert_events(spark, sf), INHIBIT_BY_ALERT, _ALERT).select(
        "event_id", "severity")


@query("alert_route", """
SELECT event_id, CASE WHEN severity = 'critical' THEN 'github-critical'
       WHEN severity = 'warning' THEN 'github-warning' WHEN service = 'svc1' THEN 'github-pipeline'
       ELSE 'default-receiver' END AS receiver FROM alert_events""")
def alert_route(spark, sf):
    return al.route(fx.alert_events(spark, sf), receiver_routes("svc1"), DEFAULT_RECEIVER).select(
        "event_id", "receiver")


@query("alert_channels", """
SELECT event_id, unnest(CASE WHEN severity = 'critical' THEN ['github', 'webhook']
       WHEN severity = 'warning' THEN ['github'] WHEN service = 'svc1' THEN ['github', 'webhook']
       ELSE ['github'] END) AS channel FROM alert_events""")
def alert_channels(spark, sf):
    events = fx.alert_events(spark, sf).withColumn("component", F.lit(""))
    return al.route(events, channel_routes("svc1"), DEFAULT_CHANNEL, "channel").select(
        "event_id", "channel")


@query("alert_group", """
SELECT alertname, service, t - t % 300 AS slot, count(*) AS alerts, min(t) AS first_t,
       max(t) AS last_t, CASE max(CASE severity WHEN 'critical' THEN 3 WHEN 'warning' THEN 2
         ELSE 1 END) WHEN 3 THEN 'critical' WHEN 2 THEN 'warning' ELSE 'info' END AS worst_severity
FROM alert_events WHERE status = 'firing' GROUP BY 1, 2, 3""")
def alert_group(spark, sf):
    firing = fx.alert_events(spark, sf).filter(F.col("status") == "firing")
    return al.group_alerts(firing, ["alertname", "service"], "t", 300)


@query("alert_group_windows", """
WITH RECURSIVE fired AS (
  SELECT alertname, concat('c', CAST(event_id % 2 AS VARCHAR)) AS cluster, service, severity, t FROM alert_events
  WHERE status = 'firing'),
moments AS (
  SELECT *, row_number() OVER (PARTITION BY alertname, cluster, service, severity ORDER BY t) AS rn
  FROM (SELECT alertname, cluster, service, severity, t, count(*) AS n FROM fired GROUP BY ALL) a),
walk AS (
  SELECT alertname, cluster, service, severity, t, n, rn, t AS opened_t FROM moments WHERE rn = 1
  UNION ALL
  SELECT m.alertname, m.cluster, m.service, m.severity, m.t, m.n, m.rn,
         CASE WHEN m.t - w.t > 300 THEN m.t ELSE w.opened_t END
  FROM walk w JOIN moments m ON m.alertname = w.alertname AND m.cluster = w.cluster AND m.service = w.service
    AND m.severity = w.severity AND m.rn = w.rn + 1),
due AS (
  SELECT *, opened_t + CASE severity WHEN 'critical' THEN 30 WHEN 'warning' THEN 120 ELSE 10 END AS first_due FROM walk)
SELECT alertname, cluster, service, severity, opened_t,
       first_due + greatest(0, (t - first_due + 299) // 300 * 300) AS notify_t,
       CAST(sum(n) AS BIGINT) AS alerts, min(t) AS first_t, max(t) AS last_t FROM due GROUP BY ALL""")
def alert_group_windows(spark, sf):
    """Groups by alert, cluster and service, each severity with its own wait."""
    firing = fx.alert_events(spark, sf).filter(F.col("status") == "firing").withColumn(
        "cluster", F.concat(F.lit("c"), (F.col("event_id") % 2).cast("string")))
    return al.group_windows(firing, GROUP_BY, by_severity(GROUP_WAIT_S, GROUP_WAIT_DEFAULT_S), GROUP_INTERVAL_S, RESOLVE_TIMEOUT_S)


def _throttle_oracle(keys, every):
    same = " AND ".join(f"m.{k} = s.{k}" for k in keys.split(", "))
    mine = ", ".join(f"m.{k}" for k in keys.split(", "))
    return f"""
WITH RECURSIVE moments AS (
  SELECT DISTINCT {keys}, t, {every} AS every FROM alert_events WHERE status = 'firing'),
sent AS (
  SELECT {keys}, min(t) AS t FROM moments GROUP BY {keys}
  UNION ALL
  SELECT {keys}, t FROM (
    SELECT {mine}, m.t, row_number() OVER (PARTITION BY {mine} ORDER BY m.t) AS rn
    FROM sent s JOIN moments m ON {same} AND m.t > s.t AND m.t >= s.t + m.every) x WHERE rn = 1)
SELECT {keys}, t FROM sent"""


@query("notify_throttle", _throttle_oracle(
    "severity, service", "CASE severity WHEN 'critical' THEN 1800 WHEN 'warning' THEN 7200 ELSE 43200 END"))
def notify_throttle(spark, sf):
    """The receivers' repeat interval."""
    firing = fx.alert_events(spark, sf).filter(F.col("status") == "firing")
    return al.throttle(firing, ["severity", "service"], by_severity(REPEAT_S, REPEAT_DEFAULT_S))


@query("notify_throttle_channel", _throttle_oracle(
    "severity, alertname", "CASE severity WHEN 'critical' THEN 60 WHEN 'warning' THEN 300 ELSE 0 END"))
def notify_throttle_channel(spark, sf):
    """The channels' throttle; severities without one are not held back."""
    firing = fx.alert_events(spark, sf).filter(F.col("status") == "firing")
    return al.throttle(firing, ["severity", "alertname"], by_severity(THROTTLE_S, 0))


@query("notify_cooldown", _throttle_oracle("alertname", "300"))
def notify_cooldown(spark, sf):
    """The general cooldown between notifications of one alert."""
    firing = fx.alert_events(spark, sf).filter(F.col("status") == "firing")
    return al.throttle(firing, ["alertname"], F.lit(COOLDOWN_S))


@query("notify_caps", """
SELECT event_id, severity, t FROM (
  SELECT *, row_number() OVER (PARTITION BY severity, t - t % 86400 ORDER BY t, event_id) AS rd
  FROM (SELECT *, row_number() OVER (PARTITION BY severity, t - t % 3600 ORDER BY t, event_id)
               AS rh FROM alert_events WHERE status = 'firing') a WHERE rh <= 10) b
WHERE rd <= 50""")
def notify_caps(spark, sf):
    firing = fx.alert_events(spark, sf).filter(F.col("status") == "firing")
    return al.cap(firing, ["severity"], ESCALATION_CAPS).select("event_id", "severity", "t")


@query("channel_caps", """
SELECT event_id, alertname, t FROM (
  SELECT *, row_number() OVER (PARTITION BY alertname, t - t % 3600 ORDER BY t, event_id) AS rh
  FROM (SELECT *, row_number() OVER (PARTITION BY alertname, t - t % 60 ORDER BY t, event_id)
               AS rm FROM alert_events) a WHERE rm <= 10) b
WHERE rh <= 50""")
def channel_caps(spark, sf):
    return al.cap(fx.alert_events(spark, sf), ["alertname"], CHANNEL_CAPS).select(
        "event_id", "alertname", "t")


@query("escalation_steps", """
SELECT e.alertname, e.service, e.instance, e.severity, e.start_t, p.step, e.start_t + p.delay_s
       AS due_t FROM episodes e JOIN policy p ON e.severity = p.severity
WHERE e.start_t + p.delay_s <= least(coalesce(e.end_t, 1706745600), 1706745600)""")
def escalation_steps(spark, sf):
    policy = values_frame(spark, ESCALATION_SCHEMA, ESCALATION)
    return al.escalate(_episodes(spark, sf), policy, fx.AS_OF).select(
        *_ALERT, "severity", "start_t", "step", "due_t")


@query("escalation_targets", """
SELECT p.severity, p.step, x.target, count(*) AS n FROM episodes e
JOIN policy p ON e.severity = p.severity
JOIN (VALUES ('critical', 1, 'primary_oncall'), ('critical', 1, 'github_issues'),
  ('critical', 2, 'secondary_oncall'), ('critical', 2, 'slack_alerts'),
  ('critical', 3, 'engineering_manager'), ('critical', 3, 'platform_team'),
  ('warning', 1, 'primary_oncall'), ('warning', 1, 'github_issues'),
  ('warning', 2, 'secondary_oncall'), ('warning', 3, 'team_lead'),
  ('info', 1, 'github_issues'), ('info', 2, 'team_lead')) AS x(severity, step, target)
  ON x.severity = p.severity AND x.step = p.step
WHERE e.start_t + p.delay_s <= least(coalesce(e.end_t, 1706745600), 1706745600)
GROUP BY 1, 2, 3""")
def escalation_targets(spark, sf):
    policy = values_frame(spark, ESCALATION_SCHEMA, ESCALATION)
    due = al.escalate(_episodes(spark, sf), policy, fx.AS_OF)
    return (due.select("severity", "step", F.explode("targets").alias("target"))
            .groupBy("severity", "step", "target").agg(F.count(F.lit(1)).alias("n")))


@query("auto_escalate", """
SELECT alertname, service, instance, severity, start_t,
       CASE WHEN end_t IS NOT NULL THEN 'none'
            WHEN severity = 'critical' AND 1706745600 - start_t >= 600 THEN 'escalate'
            WHEN severity = 'warning' AND 1706745600 - start_t >= 3600 THEN 'escalate'
            WHEN severity = 'info' AND 1706745600 - last_t >= 86400 THEN 'resolve'
            ELSE 'none' END AS auto_action
FROM episodes JOIN (SELECT alertname, service, instance, severity, max(t) AS last_t
                    FROM alert_events GROUP BY ALL) l USING (alertname, service, instance, severity)""")
def auto_escalate(spark, sf):
    """Idle since the last event of the alert, whatever its status."""
    keys = [*_ALERT, "severity"]
    last = fx.alert_events(spark, sf).groupBy(*keys).agg(F.max("t").alias("last_t"))
    open_ = _episodes(spark, sf).join(last, keys)
    return al.auto_escalate(open_, fx.AS_OF).select(
        *_ALERT, "severity", "start_t", "auto_action")


# Incidents ------------------------------------------------------------------------------------

@query("alert_fingerprint", "SELECT event_id, alert_id FROM identified")
def alert_fingerprint_query(spark, sf):
    return fx.alert_events(spark, sf).select("event_id", alert_fingerprint(
        F.col("alertname"), F.col("service"), F.col("instance")).alias("alert_id"))


@query("incident_fields", """
SELECT event_id, concat(upper(coalesce(severity, 'unknown')), ': ', alertname, ' - ',
         coalesce(service, 'unknown-service')) AS title,
       concat('alert,monitoring,automated', coalesce(',severity-' || severity, ''),
         coalesce(',service-' || service, ''), CASE WHEN event_id % 6 = 0 THEN ''
         ELSE concat(',component-', instance) END) AS labels
FROM (SELECT event_id, alertname, instance, CASE WHEN event_id % 4 <> 0 THEN severity END
               AS severity, CASE WHEN event_id % 5 <> 0 THEN service END AS service
      FROM alert_events) e""")
def incident_fields(spark, sf):
    n = F.col("event_id")
    e = fx.alert_events(spark, sf).withColumns({
        "severity": F.when(n % 4 != 0, F.col("severity")),
        "service": F.when(n % 5 != 0, F.col("service")),
        "component": F.when(n % 6 != 0, F.col("instance")).otherwise("")})
    return e.select(
        "event_id",
        incident_title(F.col("severity"), F.col("alertname"), F.col("service")).alias("title"),
        F.array_join(incident_labels(F.col("severity"), F.col("service"), F.col("component")), ",")
        .alias("labels"))


@query("alert_payload_explode", """
SELECT event_id, alertname, CASE WHEN event_id % 2 = 0 THEN severity ELSE 'unknown' END
         AS severity, service, 'unknown' AS instance, status, concat('k ', props) AS description
FROM alert_events JOIN (SELECT event_id AS e, props FROM events) p ON e = event_id
UNION ALL
SELECT event_id, 'Unknown', 'unknown', service, 'unknown', 'unknown', '' FROM alert_events""")
def alert_payload_explode(spark, sf):
    """Each event becomes a document of two alerts, the second with little in it."""
    props = fx.events(spark, sf).select("event_id", "props")
    e = fx.alert_events(spark, sf).join(props, "event_id")
    text = F.lit(None).cast("string")
    labels = F.struct("alertname", F.when(F.col("event_id") % 2 == 0, F.col("severity"))
                      .alias("severity"), "service")
    full = F.struct("status", labels.alias("labels"), F.struct(F.concat(F.lit("k "), "props")
                                                               .alias("description"))
                    .alias("annotations"))
    bare = F.struct(text.alias("status"), F.struct(
        text.alias("alertname"), text.alias("severity"), F.col("service")).alias("labels"),
        F.struct(text.alias("description")).alias("annotations"))
    docs = e.select("event_id", F.to_json(F.struct(F.array(full, bare).alias("alerts")))
                    .alias("body"))
    return explode_payloads(docs).select("event_id", "alertname", "severity", "service", "instance",
                                         "status", "description")


@query("incident_actions", """
SELECT event_id, alert_id, CASE
  WHEN status = 'firing' THEN CASE WHEN was = 'firing' THEN 'update' ELSE 'create' END
  WHEN was = 'firing' THEN 'close' ELSE 'none' END AS action
FROM (SELECT *, lag(status) OVER (PARTITION BY alert_id ORDER BY t, event_id) AS was
      FROM identified) a""")
def incident_actions(spark, sf):
    return al.incident_actions(al.with_alert_id(fx.alert_events(spark, sf))).select(
        "event_id", "alert_id", "action")


@query("incident_state", """
SELECT alert_id, CASE WHEN last(status ORDER BY t, event_id) = 'firing' THEN 'open'
       ELSE 'closed' END AS state, max(t) AS last_t FROM identified GROUP BY 1""")
def incident_state(spark, sf):
    return al.incident_state(al.with_alert_id(fx.alert_events(spark, sf)))


@query("active_alerts", """
SELECT alertname, service, instance, max(t) AS last_t FROM alert_events GROUP BY 1, 2, 3
HAVING last(status ORDER BY t, event_id) = 'firing'""")
def active_alerts(spark, sf):
    return al.active_alerts(fx.alert_events(spark, sf), _ALERT)


@query("active_alert_count", """
SELECT count(*) AS firing FROM (
  SELECT last(status ORDER BY t, event_id) AS s FROM alert_events
  GROUP BY alertname, service, instance) a WHERE s = 'firing'""")
def active_alert_count(spark, sf):
    return al.active_alerts(fx.alert_events(spark, sf), _ALERT).agg(agg.count_rows("firing"))


# Health ---------------------------------------------------------------------------------------

@query("health_rollup", """
SELECT t - t % 3600 AS slot, CASE WHEN bool_and(healthy) THEN 'healthy' ELSE 'unhealthy' END
         AS overall,
       coalesce(string_agg(DISTINCT component, ',' ORDER BY component)
                FILTER (WHERE NOT healthy), '') AS failing FROM health_checks GROUP BY 1""")
def health_rollup(spark, sf):
    checks = fx.health_checks(spark, sf).withColumn(
        "slot", F.col("t") - F.pmod(F.col("t"), F.lit(3600)))
    return agg.health_rollup(checks, ["slot"])


@query("status_json", """
SELECT t - t % 86400 AS slot, CASE WHEN bool_and(healthy) THEN 'healthy' ELSE 'unhealthy' END
         AS overall,
       coalesce(string_agg(DISTINCT component, ',' ORDER BY component)
                FILTER (WHERE NOT healthy), '') AS failing FROM health_checks GROUP BY 1""")
def status_json(spark, sf):
    """The daily health status, written as JSON and read back."""
    checks = fx.health_checks(spark, sf).withColumn(
        "slot", F.col("t") - F.pmod(F.col("t"), F.lit(86400)))
    status, path = agg.health_rollup(checks, ["slot"]), scratch_path(spark, "status")
    write_status(status, path)
    return spark.read.schema(status.schema).json(path)


@query("failure_streak", """
SELECT event_id, component, streak, streak >= 3 AS needs_restart, streak >= 5 AS needs_alert
FROM (SELECT event_id, component, CASE WHEN healthy THEN 0 ELSE count(*) FILTER (WHERE NOT healthy)
        OVER (PARTITION BY component, grp ORDER BY t, event_id) END AS streak
      FROM (SELECT *, count(*) FILTER (WHERE healthy) OVER (
              PARTITION BY component ORDER BY t, event_id) AS grp FROM health_checks) a) b""")
def failure_streak(spark, sf):
    return al.failure_streak(fx.health_checks(spark, sf), ["component"]).select(
        "event_id", "component", "streak", "needs_restart", "needs_alert")


@query("resource_issues", r"""
SELECT event_id, concat_ws('; ',
  CASE WHEN m > 2048 THEN printf('High memory usage: %.0fMB', m) END,
  CASE WHEN c > 80 THEN printf('High CPU usage: %.1f%%', c) END,
  CASE WHEN d > 85 THEN printf('High disk usage: %.1f%%', d) END) AS issues,
  NOT (m > 2048 OR c > 80 OR d > 85) AS healthy
FROM (SELECT event_id, CAST(user_id * 20 AS DOUBLE) AS m, CAST(event_id % 100 AS DOUBLE) AS c,
             CAST(event_id % 97 AS DOUBLE) AS d FROM events) r""")
def resource_issues(spark, sf):
    n = F.col("event_id")
    readings = fx.events(spark, sf).select(
        "event_id", (F.col("user_id") * 20).cast("double").alias("memory_mb"),
        (n % 100).cast("double").alias("cpu_percent"),
        (n % 97).cast("double").alias("disk_percent"))
    return al.resource_issues(readings).select("event_id", "issues", "healthy")


@query("heavy_clients", """
SELECT user_id AS client, count(*) AS request_count, min(t) AS first_request,
       max(t) AS last_request FROM evs WHERE t > 1706745600 - 30 * 86400
GROUP BY 1 HAVING count(*) > 60 ORDER BY 2 DESC, 1""")
def heavy_clients(spark, sf):
    log = fx.events(spark, sf).select(F.col("user_id").alias("client"), "t")
    return agg.heavy_clients(log, "client", "t", fx.AS_OF, more_than=60)


# Logs -----------------------------------------------------------------------------------------

@query("log_scan", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS asctime, concat('app.', event_type) AS name,
       CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS levelname, props AS message
FROM events""")
def log_scan(spark, sf):
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    lines = fx.events(spark, sf).select("event_id", F.concat_ws(
        " - ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.concat(F.lit("app."), "event_type"),
        level, "props").alias("line"))
    return parse_log_lines(lines)


@query("log_classify", r"""
SELECT seq, concat_ws(',', CASE WHEN regexp_matches(line, 'CRITICAL|ERROR') THEN 'critical' END,
  CASE WHEN regexp_matches(line, 'reddit.*error|api.*fail') THEN 'api' END,
  CASE WHEN regexp_matches(line, 'slow|timeout|memory') THEN 'performance' END,
  CASE WHEN regexp_matches(line, '4[0-9][0-9]') THEN 'suspicious_4xx' END,
  CASE WHEN regexp_matches(line, '5[0-9][0-9]') THEN 'suspicious_5xx' END,
  CASE WHEN regexp_matches(line, 'FAILED') THEN 'suspicious_failed' END,
  CASE WHEN regexp_matches(line, 'UNAUTHORIZED') THEN 'suspicious_unauthorized' END) AS classes
FROM (SELECT seq, concat(line, CASE seq % 7 WHEN 0 THEN ' api call fail' WHEN 1 THEN ' timeout'
        WHEN 2 THEN ' status 404' WHEN 3 THEN ' login FAILED' ELSE '' END) AS line
      FROM log_lines) l""")
def log_classify(spark, sf):
    n = F.col("seq") % 7
    tail = (F.when(n == 0, " api call fail").when(n == 1, " timeout").when(n == 2, " status 404")
            .when(n == 3, " login FAILED").otherwise(""))
    lines = fx.log_lines(spark, sf).select("seq", F.concat("line", tail).alias("line"))
    return lines.select("seq", F.array_join(log_classes(F.col("line")), ",").alias("classes"))


@query("log_error_freq", """
SELECT split_part(line, ' ', 2) AS key, count(*) AS n FROM log_lines WHERE line LIKE 'ERROR%'
GROUP BY 1 ORDER BY 2 DESC, 1""")
def log_error_freq(spark, sf):
    errors = fx.log_lines(spark, sf).filter(F.col("line").startswith("ERROR"))
    return logs.error_frequency(errors, F.split_part("line", F.lit(" "), F.lit(2)))


@query("log_tail_health", """
SELECT count(*) FILTER (WHERE upper(line) LIKE '%ERROR%') AS errors, max(t) AS last_t,
       1706745600 - max(t) > 14400 AS stale,
       1706745600 - max(t) <= 14400 AND count(*) FILTER (WHERE upper(line) LIKE '%ERROR%') <= 10
         AS healthy FROM (SELECT * FROM log_lines ORDER BY seq DESC LIMIT 1000) l""")
def log_tail_health(spark, sf):
    return logs.log_tail_health(fx.log_lines(spark, sf), "t", "seq", fx.AS_OF)


@query("log_last_hour_errors", """
SELECT seq, line FROM log_lines WHERE line LIKE 'ERROR%'
  AND t >= 1704952800 AND t < 1704952800 + 3600""")
def log_last_hour_errors(spark, sf):
    errors = fx.log_lines(spark, sf).filter(F.col("line").startswith("ERROR"))
    return logs.hour_errors(errors, "t", 1704952800 + 3600 + 1234).select("seq", "line")


@query("log_pattern_alerts", """
SELECT l.t - l.t % 900 AS slot, k.file, k.threshold, count(*) FILTER (
         WHERE regexp_matches(l.line, k.pattern)) AS hits,
       count(*) FILTER (WHERE regexp_matches(l.line, k.pattern)) > k.threshold AS alerting
FROM (SELECT * REPLACE (concat('user=1 ', line) AS line) FROM log_lines) l
JOIN (VALUES ('file0', 'application', 'ERROR|CRITICAL', 10), ('file1', 'errors', '.*', 5),
  ('file2', 'system', 'user=1.*ERROR', 5)) AS k(name, file, pattern, threshold)
  ON l.file = k.name GROUP BY 1, 2, 3""")
def log_pattern_alerts(spark, sf):
    """The three files by kind; a user stands in for the service in the system log."""
    kinds = F.create_map(*map(F.lit, ("file0", "application", "file1", "errors", "file2", "system")))
    lines = fx.log_lines(spark, sf).withColumns(
        {"file": kinds[F.col("file")], "line": F.concat(F.lit("user=1 "), "line")})
    return logs.pattern_alerts(lines, log_thresholds("user=1"))
