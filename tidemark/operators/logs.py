"""Log line operators: frequencies, tail health, windowed pattern alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def error_frequency(lines: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """Rows per key, most frequent first."""
    return (lines.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), name))


def hour_errors(lines: DataFrame, t: str, as_of: int) -> DataFrame:
    """Lines of the clock hour before the one that holds ``as_of``."""
    hour = as_of - as_of % 3600
    return lines.filter((F.col(t) >= hour - 3600) & (F.col(t) < hour))


def log_tail_health(lines: DataFrame, t: str, order: str, as_of: int, tail: int = 1000,
                    max_errors: int = 10, stale_s: int = 4 * 3600) -> DataFrame:
    """Errors among the last ``tail`` lines and whether the log is fresh and quiet.

    The tail is a top-k, so each task keeps only its own last lines.
    """
    last = lines.select(order, t, "line").orderBy(F.desc(order)).limit(tail)
    out = last.agg(F.count_if(F.upper("line").contains("ERROR")).alias("errors"),
                   F.max(t).alias("last_t"))
    stale = F.lit(as_of) - F.col("last_t") > stale_s
    return out.select("errors", "last_t", F.coalesce(stale, F.lit(True)).alias("stale"),
                      (F.coalesce(~stale, F.lit(False)) & (F.col("errors") <= max_errors))
                      .alias("healthy"))


def pattern_alerts(lines: DataFrame, thresholds: list[tuple[str, str, int]], t: str = "t",
                   kind: str = "file", line: str = "line", width_s: int = 900) -> DataFrame:
    """Pattern hits per file and 15 minutes beside the file's threshold.

    ``thresholds`` are (kind, pattern, most hits); other kinds are left out. Each
    pattern is a literal, compiled once, and one pass serves all kinds.
    """
    slot = (F.col(t) - F.pmod(F.col(t), F.lit(width_s))).alias("slot")
    hit, most = F.lit(False), F.lit(None).cast("int")
    for name, pattern, threshold in thresholds:
        hit = F.when(F.col(kind) == name, F.col(line).rlike(pattern)).otherwise(hit)
        most = F.when(F.col(kind) == name, threshold).otherwise(most)
    return (lines.filter(F.col(kind).isin([name for name, _, _ in thresholds]))
            .groupBy(slot, kind).agg(F.count_if(hit).alias("hits"))
            .withColumn("threshold", most).withColumn("alerting", F.col("hits") > F.col("threshold")))
