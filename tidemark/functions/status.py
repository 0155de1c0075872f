"""Value to status text, threshold bands, log line classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: KPI bands (fixed values): name -> (direction, good limit, critical limit).
#: "high" is better when large; "low" is better when small.
KPI_BANDS = {
    "posts_per_hour": ("high", 50.0, 20.0),
    "api_response_seconds": ("low", 2.0, 5.0),
    "sentiment_seconds": ("low", 1.0, 3.0),
    "error_rate_percent": ("low", 1.0, 5.0),
    "cpu_percent": ("low", 50.0, 80.0),
    "memory_percent": ("low", 60.0, 85.0),
    "disk_percent": ("low", 70.0, 90.0),
}

#: Warning and critical limits of the resource monitor (fixed values).
RESOURCE_LIMITS = {
    "cpu": (70.0, 85.0),
    "memory": (80.0, 90.0),
    "disk": (85.0, 95.0),
}

#: Line classes and their patterns (fixed values).
LOG_CLASSES = {
    "critical": r"CRITICAL|ERROR",
    "api": r"reddit.*error|api.*fail",
    "performance": r"slow|timeout|memory",
    "suspicious_4xx": r"4[0-9][0-9]",
    "suspicious_5xx": r"5[0-9][0-9]",
    "suspicious_failed": r"FAILED",
    "suspicious_unauthorized": r"UNAUTHORIZED",
}


def health_text(value: Column) -> Column:
    return F.when(value == 0, "Unhealthy").when(value == 1, "Healthy")


def firing_text(count: Column) -> Column:
    return F.when(count == 0, "Healthy").when((count >= 1) & (count <= 999), "Alerting")


def kpi_band(name: Column, value: Column) -> Column:
    """good / warning / critical by :data:`KPI_BANDS`; null for an unknown KPI."""
    out = F.lit(None).cast("string")
    for kpi, (direction, good, critical) in KPI_BANDS.items():
        if direction == "high":
            band = F.when(value > good, "good").when(value < critical, "critical")
        else:
            band = F.when(value < good, "good").when(value > critical, "critical")
        out = F.when(name == kpi, band.otherwise("warning")).otherwise(out)
    return F.when(value.isNotNull(), out)


def resource_level(name: Column, value: Column) -> Column:
    """ok / warning / critical by :data:`RESOURCE_LIMITS`."""
    out = F.lit(None).cast("string")
    for resource, (warning, critical) in RESOURCE_LIMITS.items():
        level = F.when(value > critical, "critical").when(value > warning, "warning").otherwise("ok")
        out = F.when(name == resource, level).otherwise(out)
    return F.when(value.isNotNull(), out)


def log_classes(line: Column, classes: dict[str, str] | None = None) -> Column:
    """Names of all classes whose pattern is found in the line, in table order."""
    table = classes or LOG_CLASSES
    return F.array_compact(F.array(*[F.when(line.rlike(p), F.lit(n)) for n, p in table.items()]))
