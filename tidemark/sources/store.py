"""The persistent seen-store.

Rows of one run live in their own ``run_id`` partition, and a run replaces its
partition as a whole. A run that is repeated after a crash therefore reads the
store without its own rows, comes to the same result, and adds nothing twice.
"""

from __future__ import annotations

import logging
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.errors import AnalysisException

from tidemark.schemas import SEEN

log = logging.getLogger(__name__)

_RUN_ID = re.compile(r"[A-Za-z0-9_.:-]+")

_STORED = StructType([*SEEN.fields, StructField("run_id", StringType())])


class SeenStore:
    """Parquet files below ``path``, partitioned by run.

    With ``table`` the store is a catalogue table bucketed by ``content_hash``
    instead: the anti join of a run then shuffles its batch only, and never
    the store, which is what grows.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, table: str | None = None,
                 buckets: int = 256):
        if (path is None) == (table is None):
            raise ValueError("give either a path or a table")
        self.spark, self.path, self.table, self.buckets = spark, path, table, buckets

    def read(self, excluding: str | None = None) -> DataFrame:
        """Stored rows, without those of run ``excluding``.

        An unreadable store counts as empty, so that no post is lost over it.
        """
        try:
            if self.table:
                rows = self.spark.table(self.table)
            else:
                rows = self.spark.read.schema(_STORED).parquet(self.path)
        except AnalysisException as err:
            log.warning("seen-store not readable, taken as empty: %s", err.getCondition())
            return self.spark.createDataFrame([], SEEN)
        if excluding is not None:
            rows = rows.filter(F.col("run_id") != excluding)
        return rows.select(*SEEN.names)

    def commit(self, rows: DataFrame, run_id: str) -> None:
        """Replace the rows of ``run_id``. Call it after the run's own output is written."""
        if not _RUN_ID.fullmatch(run_id):
            raise ValueError(f"not usable as a partition name: {run_id!r}")
        if self.path:
            (rows.select(*SEEN.names, F.lit(run_id).alias("run_id"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("run_id").parquet(self.path))
            return
        if not self.spark.catalog.tableExists(self.table):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in _STORED)
            self.spark.sql(
                f"CREATE TABLE {self.table} ({columns}) USING parquet PARTITIONED BY (run_id) "
                f"CLUSTERED BY (content_hash) SORTED BY (content_hash) INTO {self.buckets} BUCKETS")
        # One task per bucket writes one file; the named partition alone is replaced.
        batch = rows.select(*SEEN.names).repartition(self.buckets, "content_hash")
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.table} PARTITION (run_id = '{run_id}') "
                       "SELECT * FROM {batch}", batch=batch)
