"""Incident columns: fingerprint, title, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Labels every incident carries (fixed values).
BASE_LABELS = ["alert", "monitoring", "automated"]


def _or(col: Column, default: str) -> Column:
    return F.coalesce(col, F.lit(default))


def alert_fingerprint(alertname: Column, service: Column, instance: Column) -> Column:
    """First eight hex digits of the MD5 of ``name-service-instance``."""
    joined = F.concat_ws("-", _or(alertname, ""), _or(service, ""), _or(instance, ""))
    return F.substring(F.md5(joined), 1, 8)


def incident_title(severity: Column, alertname: Column, service: Column) -> Column:
    return F.concat(F.upper(_or(severity, "unknown")), F.lit(": "), _or(alertname, "Unknown Alert"),
                    F.lit(" - "), _or(service, "unknown-service"))


def incident_labels(severity: Column, service: Column, component: Column) -> Column:
    """Base labels, then one per non-empty part."""
    def part(prefix: str, col: Column) -> Column:
        return F.when(_or(col, "") != "", F.concat(F.lit(prefix), col))

    return F.array_compact(F.array(
        *[F.lit(x) for x in BASE_LABELS],
        part("severity-", F.lower(severity)), part("service-", service),
        part("component-", component)))
