"""Incremental runs with durable progress, and the streaming operators they use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators.dedup import dedup_against, dedup_first_wins, insert_if_absent, with_hash
from tidemark.operators.scoring import Scorer
from tidemark.plans.batch import arrivals, scored_posts
from tidemark.sources.store import SeenStore

#: How long late rows are waited for.
WATERMARK = "1 hour"


def read_files(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
               files_per_batch: int | None = None) -> DataFrame:
    """A file stream in a fixed schema."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def run_available(df: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what is there, then stop; the next call goes on from the checkpoint."""
    query = (df.writeStream.format("parquet").outputMode(mode).option("path", sink)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def each_available(df: DataFrame, write: Callable[[DataFrame, int], None],
                   checkpoint: str) -> StreamingQuery:
    """The same with a function per micro-batch."""
    query = (df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def stream_dedup(posts: DataFrame, event_time: str | None = None,
                 watermark: str = WATERMARK) -> DataFrame:
    """First sight of every content hash.

    Without ``event_time`` it is exact and its state grows with the distinct
    hashes. With it the state is bounded, and a copy that comes later than the
    watermark passes.
    """
    hashed = posts if "content_hash" in posts.columns else with_hash(posts)
    if event_time is None:
        return hashed.dropDuplicates(["content_hash"])
    return hashed.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(
        ["content_hash"])


def window_counts(events: DataFrame, ts: str, by: list[str], width: str, slide: str | None = None,
                  watermark: str = WATERMARK) -> DataFrame:
    """Counts per sliding window. A zone-less time is cast, as watermarks need an instant."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if timed.isStreaming:
        timed = timed.withWatermark(ts, watermark)
    return timed.groupBy(F.window(ts, width, slide), *by).agg(F.count(F.lit(1)).alias("n"))


def late_rows(query: StreamingQuery) -> int:
    """Rows the stateful operators of a query dropped as too late."""
    return sum(op["numRowsDroppedByWatermark"]
               for progress in query.recentProgress for op in progress["stateOperators"])


def score_and_store(store: SeenStore, sink: str, scorer: Scorer | None,
                    prefix: str = "batch") -> Callable[[DataFrame, int], None]:
    """Per micro-batch: drop seen posts, score, write the sink, then the store.

    The run id follows from the batch id and both writes replace that run's
    partition, so a batch that is run again changes nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run_id = f"{prefix}-{batch_id:010d}"
        seen = store.read(excluding=run_id)
        unique = dedup_against(dedup_first_wins(with_hash(arrivals(batch, None, None))), seen)
        rows = scored_posts(unique, scorer, run_id)
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id").parquet(sink))
        store.commit(insert_if_absent(unique, seen), run_id)
    return write
