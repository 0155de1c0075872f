"""Queries on manifests, snapshots and retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import manifests as mf
from tidemark.plans import fixtures as fx
from tidemark.plans.registry import query
from tidemark.sources.telemetry import file_manifest as manifest_of


@query("file_manifest")
def file_manifest(spark, sf):
    """The table files themselves; no SQL form."""
    found = manifest_of(spark, sf, glob="*.parquet", checked_bytes=None)
    name = F.element_at(F.split("path", "/"), -1)
    return found.select(name.alias("name"), "length", "checksum")


@query("manifest_totals", """
SELECT split_part(path, '/', 1) AS folder, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes
FROM manifest_old GROUP BY 1""")
def manifest_totals(spark, sf):
    files = fx.manifest_old(spark, sf).withColumn(
        "folder", F.split_part("path", F.lit("/"), F.lit(1)))
    return mf.manifest_totals(files, ["folder"], "size")


_VERIFY = """
SELECT o.path, n.path IS NOT NULL AS file_exists, n.checksum IS NOT NULL AS readable,
       coalesce(n.size > 1024, false) AS size_check,
       n.path IS NOT NULL AND n.checksum IS NOT NULL AND coalesce(n.size > 1024, false) AS passed
FROM manifest_old o LEFT JOIN (SELECT path, size, CASE WHEN size % 5 <> 0 THEN checksum END
                                      AS checksum FROM manifest_new) n ON o.path = n.path"""


def _verified(spark, sf):
    found = fx.manifest_new(spark, sf).withColumn(
        "checksum", F.when(F.col("size") % 5 != 0, F.col("checksum")))
    return mf.manifest_verify(fx.manifest_old(spark, sf), found)


@query("manifest_verify", _VERIFY)
def manifest_verify(spark, sf):
    return _verified(spark, sf)


@query("manifest_verify_summary", f"""
SELECT count(*) AS files, count(*) FILTER (WHERE passed) AS passed_files,
       CASE WHEN bool_and(passed) THEN 'passed' ELSE 'failed' END AS status FROM ({_VERIFY}) v""")
def manifest_verify_summary(spark, sf):
    return mf.verification_summary(_verified(spark, sf))


@query("manifest_diff", """
SELECT coalesce(o.path, n.path) AS path, CASE WHEN o.path IS NULL THEN 'added'
         WHEN n.path IS NULL THEN 'removed' WHEN o.checksum = n.checksum THEN 'same'
         ELSE 'changed' END AS change, o.checksum AS old_checksum, n.checksum AS new_checksum
FROM manifest_old o FULL OUTER JOIN manifest_new n ON o.path = n.path""")
def manifest_diff(spark, sf):
    return mf.manifest_diff(fx.manifest_old(spark, sf), fx.manifest_new(spark, sf))


@query("retention_select", """
SELECT name, type, created_t, age_days FROM (
  SELECT *, (1706745600 - created_t) // 86400 AS age_days FROM snapshots) s
WHERE age_days > CASE type WHEN 'daily' THEN 7 WHEN 'weekly' THEN 28 WHEN 'monthly' THEN 360 END
ORDER BY created_t DESC, name""")
def retention_select(spark, sf):
    return mf.retention_select(fx.snapshots(spark, sf), fx.AS_OF)


@query("row_retention", """
SELECT name, created_t FROM snapshots WHERE created_t >= 1706745600 - 90 * 86400""")
def row_retention(spark, sf):
    return mf.keep_recent_rows(fx.snapshots(spark, sf), "created_t", fx.AS_OF).select(
        "name", "created_t")


@query("manifest_recent", """
SELECT name AS path, created_t FROM snapshots WHERE created_t > 1706745600 - 7 * 86400
ORDER BY 2 DESC, 1""")
def manifest_recent(spark, sf):
    files = fx.snapshots(spark, sf).select(F.col("name").alias("path"), "created_t")
    return mf.recent_files(files, "created_t", fx.AS_OF)
