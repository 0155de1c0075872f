"""Rule, routing and escalation tables (fixed values) and the column logic on them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.times import seconds

#: A rule reads the series whose ``label`` is ``label_is``, or matches ``label_like`` as a whole;
#: without a label it reads all series of its metric.
RULE_SCHEMA = ("rule STRING, metric STRING, func STRING, window_s BIGINT, comparator STRING, "
               "threshold DOUBLE, for_s BIGINT, severity STRING, "
               "label STRING, label_is STRING, label_like STRING")

#: Stands for the deployment's service in a selector; see :func:`for_service`.
SERVICE = "{service}"


def _rule(rule, metric, func, window, comparator, threshold, hold, severity, label=None):
    return (rule, metric, func, seconds(window) if window else 0, comparator, float(threshold),
            seconds(hold), severity, label, SERVICE if label else None, None)


def for_service(rules: list[tuple], service: str) -> list[tuple]:
    """Rules whose selectors name ``service``. A deployment also puts its own prefix to rule names."""
    return [tuple(service if v == SERVICE else v for v in r) for r in rules]


#: Metric rules of the alerting configuration.
METRIC_RULES = [
    _rule("PipelineDown", "up", "value", None, "==", 0, "5m", "critical", "job"),
    _rule("PipelineRestartLoop", "prometheus_engine_config_last_reload_success_timestamp_seconds",
          "increase", "15m", ">", 3, "5m", "warning", "job"),
    _rule("HighCPUUsage", "cpu_usage_percent", "value", None, ">", 80, "10m", "warning", "service"),
    _rule("HighMemoryUsage", "memory_usage_percent", "value", None, ">", 85, "5m", "warning",
          "service"),
    _rule("DiskSpaceRunningLow", "disk_usage_percent", "value", None, ">", 90, "5m", "critical",
          "service"),
    _rule("RedditAPIErrors", "reddit_api_errors_total", "increase", "15m", ">", 10, "5m",
          "warning"),
    _rule("SentimentAnalysisFailures", "sentiment_analysis_errors_total", "increase", "15m", ">", 5,
          "5m", "warning"),
    _rule("NoDataProcessed", "posts_processed_total", "increase", "4h", "==", 0, "10m", "warning"),
    _rule("HighDuplicationRate", "duplication_percent", "value", None, ">", 50, "15m", "warning"),
    _rule("DatabaseConnectionFailure", "database_connection_errors_total", "value", None, ">", 0,
          "1m", "critical"),
    _rule("BackupFailure", "backup_last_success_timestamp", "age", None, ">", 86400, "5m",
          "warning"),
    _rule("LogFileErrors", "log_errors_total", "increase", "15m", ">", 20, "5m", "warning"),
    _rule("SystemLoad", "node_load1", "value", None, ">", 2, "10m", "warning"),
    _rule("SystemMemory", "system:memory_usage", "value", None, ">", 90, "5m", "critical"),
    _rule("SystemDiskSpace", "system:disk_usage", "value", None, ">", 95, "5m", "critical"),
]

#: Application rules of the monitoring configuration.
APPLICATION_RULES = [
    _rule("service_down", "up", "value", None, "==", 0, "5m", "critical"),
    _rule("high_error_rate", "errors_total", "rate", "5m", ">", 0.1, "10m", "warning"),
    _rule("high_cpu_usage", "cpu_usage_percent", "value", None, ">", 80, "15m", "warning"),
    _rule("high_memory_usage", "memory_usage_percent", "value", None, ">", 85, "10m", "warning"),
    _rule("disk_space_low", "disk_usage_percent", "value", None, ">", 90, "5m", "critical"),
    _rule("reddit_api_failures", "reddit_api_errors_total", "rate", "15m", ">", 10, "5m",
          "warning"),
    _rule("sentiment_analysis_failures", "sentiment_analysis_errors_total", "rate", "15m", ">", 5,
          "5m", "warning"),
    _rule("no_data_processed", "posts_processed_total", "increase", "4h", "==", 0, "10m",
          "warning"),
]

#: Rules of the dashboard.
DASHBOARD_RULES = [
    _rule("Service Down Alert", "up", "value", None, "==", 0, "5m", "critical", "job"),
    _rule("High Error Rate Alert", "reddit_api_errors_total", "rate", "15m", ">", 0.1, "5m",
          "warning"),
    _rule("Resource Usage Alert", "cpu_usage_percent", "value", None, ">", 80, "10m", "warning",
          "service"),
    _rule("Memory Usage Alert", "memory_usage_percent", "value", None, ">", 85, "5m", "critical",
          "service"),
    _rule("No Data Processed Alert", "posts_processed_total", "increase", "4h", "==", 0, "10m",
          "warning"),
    _rule("Database Connection Alert", "database_connection_errors_total", "value", None, ">", 0,
          "1m", "critical"),
    _rule("Backup Failure Alert", "backup_last_success_timestamp", "age", None, ">", 86400, "5m",
          "warning"),
    _rule("Sentiment Analysis Failures", "sentiment_analysis_errors_total", "increase", "15m", ">",
          5, "5m", "warning"),
]

#: Job rules of the cluster deployment.
JOB_RULES = [
    _rule("JobFailed", "kube_job_status_failed", "value", None, ">", 0, "0m", "warning"),
    _rule("JobTooLong", "kube_job_status_start_time", "age", None, ">", 3600, "5m", "warning"),
    _rule("JobMissing", "kube_cronjob_next_schedule_time", "age", None, ">", 3900, "10m",
          "warning"),
    _rule("HighErrorRate", "pipeline_errors_total", "rate", "5m", ">", 0.1, "5m", "warning"),
]

ESCALATION_SCHEMA = ("severity STRING, step INT, delay_s BIGINT, targets ARRAY<STRING>, "
                     "channels ARRAY<STRING>")

#: Escalation steps per severity.
ESCALATION = [
    ("critical", 1, 0, ["primary_oncall", "github_issues"], ["webhook_github", "email_primary"]),
    ("critical", 2, 300, ["secondary_oncall", "slack_alerts"],
     ["webhook_github", "email_secondary", "slack_critical"]),
    ("critical", 3, 900, ["engineering_manager", "platform_team"],
     ["webhook_github", "email_escalation", "slack_engineering"]),
    ("warning", 1, 0, ["primary_oncall", "github_issues"], ["webhook_github"]),
    ("warning", 2, 1800, ["secondary_oncall"], ["webhook_github", "email_primary"]),
    ("warning", 3, 7200, ["team_lead"], ["webhook_github", "email_secondary"]),
    ("info", 1, 0, ["github_issues"], ["webhook_github"]),
    ("info", 2, 86400, ["team_lead"], ["email_summary"]),
]

#: Seconds until a severity escalates by itself, and until idle info alerts resolve.
AUTO_ESCALATE_S = {"critical": 600, "warning": 3600}
AUTO_RESOLVE_S = {"info": 86400}

#: Seconds between notifications of one alert, by severity; first the receivers' repeat
#: interval, then the channels' throttle, then the general cooldown.
REPEAT_S = {"critical": 1800, "warning": 7200}
REPEAT_DEFAULT_S = 43200
THROTTLE_S = {"critical": 60, "warning": 300}
COOLDOWN_S = 300

#: Notification caps as (bucket seconds, most per bucket), narrow bucket first.
ESCALATION_CAPS = [(3600, 10), (86400, 50)]
CHANNEL_CAPS = [(60, 10), (3600, 50)]

#: Labels that must agree for a critical alert to silence a warning.
INHIBIT_BY_SERVICE = ["service"]
INHIBIT_BY_ALERT = ["alertname", "service", "instance"]

#: Labels that make one notification group; seconds that a new group waits for more alerts, by
#: severity, and from one notification of a group to the next.
GROUP_BY = ["alertname", "cluster", "service"]
GROUP_WAIT_S = {"critical": 30, "warning": 120}
GROUP_WAIT_DEFAULT_S = 10
GROUP_INTERVAL_S = 300
#: Seconds without an alert after which a group is over.
RESOLVE_TIMEOUT_S = 300


def log_thresholds(service: str) -> list[tuple[str, str, int]]:
    """Log patterns and the most hits allowed per 15 minutes, by file kind (fixed values)."""
    return [
        ("application", r"ERROR|CRITICAL", 10),
        ("errors", r".*", 5),
        ("system", rf"{service}.*ERROR", 5),
    ]


@dataclass(frozen=True)
class Route:
    """A route: label values to match, its receivers, and whether later routes may match too."""

    match: dict[str, str]
    receivers: list[str]
    proceed: bool = False


#: Receiver routes; ``service`` is filled in by :func:`receiver_routes`.
DEFAULT_RECEIVER = "default-receiver"


def receiver_routes(service: str) -> list[Route]:
    return [
        Route({"severity": "critical"}, ["github-critical"]),
        Route({"severity": "warning"}, ["github-warning"]),
        Route({"service": service}, ["github-pipeline"], proceed=True),
    ]


DEFAULT_CHANNEL = "github"


def channel_routes(service: str) -> list[Route]:
    return [
        Route({"severity": "critical"}, ["github", "webhook"]),
        Route({"severity": "warning"}, ["github"]),
        Route({"service": service}, ["github", "webhook"]),
        Route({"component": "database"}, ["github", "webhook"]),
    ]


def route_column(routes: list[Route], default: str) -> Column:
    """Receivers of a row as an array: the first match, or those of every match up to the
    first one that does not proceed; the default when none matches."""
    chosen = F.array().cast("array<string>")
    for r in reversed(routes):
        hit = F.lit(True)
        for name, value in r.match.items():
            hit = hit & (F.coalesce(F.col(name), F.lit("")) == value)
        own = F.array(*[F.lit(x) for x in r.receivers])
        chosen = F.when(hit, F.concat(own, chosen) if r.proceed else own).otherwise(chosen)
    return F.when(F.size(chosen) == 0, F.array(F.lit(default))).otherwise(chosen)


def compare(value: Column, comparator: Column, threshold: Column) -> Column:
    """The rule's comparison; null values never breach."""
    verdict = (F.when(comparator == ">", value > threshold)
               .when(comparator == ">=", value >= threshold)
               .when(comparator == "<", value < threshold)
               .when(comparator == "<=", value <= threshold)
               .when(comparator == "==", value == threshold)
               .when(comparator == "!=", value != threshold))
    return F.coalesce(verdict, F.lit(False))


def by_severity(table: dict[str, int], default: int | None = None) -> Column:
    out = F.lit(default).cast("bigint")
    for name, value in table.items():
        out = F.when(F.col("severity") == name, F.lit(value).cast("bigint")).otherwise(out)
    return out
