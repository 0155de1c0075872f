"""File manifests, snapshots and retention as table operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Days a snapshot of each type is kept (fixed values); other types are kept for good.
RETENTION_DAYS = {"daily": 7, "weekly": 28, "monthly": 360}

#: A backup must be larger than this many bytes (fixed value).
MIN_BYTES = 1024


def manifest_totals(manifest: DataFrame, by: list[str] | None = None,
                    size: str = "length") -> DataFrame:
    return manifest.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"))


def manifest_verify(expected: DataFrame, found: DataFrame, path: str = "path",
                    size: str = "size", checksum: str = "checksum",
                    min_bytes: int = MIN_BYTES) -> DataFrame:
    """Per expected file: does it exist, is it readable, is it large enough; passed iff all are.

    A file counts as readable when its checksum could be computed.
    """
    there = found.select(path, F.col(size).alias("__size"), F.col(checksum).alias("__sum"),
                         F.lit(True).alias("__there"))
    joined = expected.select(path).join(there, path, "left")
    exists = F.coalesce(F.col("__there"), F.lit(False))
    readable = exists & F.col("__sum").isNotNull()
    large = F.coalesce(F.col("__size") > min_bytes, F.lit(False))
    return joined.select(path, exists.alias("file_exists"), readable.alias("readable"),
                         large.alias("size_check"), (exists & readable & large).alias("passed"))


def verification_summary(verified: DataFrame) -> DataFrame:
    return verified.agg(
        F.count(F.lit(1)).alias("files"), F.count_if("passed").alias("passed_files"),
        F.when(F.bool_and("passed"), "passed").otherwise("failed").alias("status"))


def manifest_diff(old: DataFrame, new: DataFrame, path: str = "path",
                  checksum: str = "checksum") -> DataFrame:
    """added / removed / changed / same per path."""
    a = old.select(path, F.col(checksum).alias("old_checksum"), F.lit(True).alias("__o"))
    b = new.select(path, F.col(checksum).alias("new_checksum"), F.lit(True).alias("__n"))
    change = (F.when(F.col("__o").isNull(), "added").when(F.col("__n").isNull(), "removed")
              .when(F.col("old_checksum").eqNullSafe(F.col("new_checksum")), "same")
              .otherwise("changed"))
    return a.join(b, path, "full_outer").select(path, change.alias("change"), "old_checksum",
                                                "new_checksum")


def retention_select(snapshots: DataFrame, as_of: int, created: str = "created_t",
                     kind: str = "type", limits: dict[str, int] | None = None) -> DataFrame:
    """Snapshots past their retention, newest first. Only selects; deletes nothing.

    Age counts whole days and must exceed the limit.
    """
    age = F.floor((F.lit(as_of) - F.col(created)) / F.lit(86400)).cast("bigint")
    limit = F.lit(None).cast("bigint")
    for name, days in (limits or RETENTION_DAYS).items():
        limit = F.when(F.col(kind) == name, F.lit(days).cast("bigint")).otherwise(limit)
    return (snapshots.withColumn("age_days", age).filter(F.col("age_days") > limit)
            .orderBy(F.desc(created), "name"))


def parse_snapshot_name(name: str = "name") -> list:
    """``type_yyyyMMdd_HHmmss[.tar.gz]`` to type and creation time in epoch seconds."""
    pattern = r"^([^_]+)_(\d{8})_(\d{6})"
    stamp = F.concat(F.regexp_extract(name, pattern, 2), F.regexp_extract(name, pattern, 3))
    when = F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmmss"))
    return [F.when(F.col(name).rlike(pattern), F.regexp_extract(name, pattern, 1)).alias("type"),
            F.unix_timestamp(when).alias("created_t")]


def keep_recent_rows(df: DataFrame, t: str, as_of: int, days: int = 90) -> DataFrame:
    """Rows not older than ``days``."""
    return df.filter(F.col(t) >= as_of - days * 86400)


def recent_files(manifest: DataFrame, modified: str, as_of: int, days: int = 7) -> DataFrame:
    """Files changed within ``days``, newest first."""
    return (manifest.filter(F.col(modified) > as_of - days * 86400)
            .orderBy(F.desc(modified), "path"))
