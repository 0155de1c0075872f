"""Exact de-duplication within a batch and against the seen-store."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import content_hash, text_or_empty
from tidemark.operators.ordered import first_per_key
from tidemark.session import cut_lineage


def with_hash(posts: DataFrame) -> DataFrame:
    return posts.withColumn("content_hash", content_hash(F.col("title"), F.col("content")))


def dedup_first_wins(df: DataFrame, key: str = "content_hash",
                     order: str = "arrival_seq") -> DataFrame:
    """One row per key: the earliest to arrive."""
    return first_per_key(df, [key], [F.col(order)])


def _split(df: DataFrame, key: str) -> DataFrame:
    """``df`` with a second join key that no earlier shuffle has.

    A join on both keys then shuffles both sides itself, and a plain shuffle is
    what adaptive execution can split at a hot key; a side that an aggregation
    has left partitioned by the key alone would rule that out.
    """
    return df.withColumn("__split", F.xxhash64(key))


def dedup_against(df: DataFrame, store: DataFrame, key: str = "content_hash",
                  repeated: bool = False) -> DataFrame:
    """Rows whose key the store does not hold.

    Keys that are ``repeated`` in ``df`` are joined so that a hot one can be
    split; where every key stands once, a bucketed store is not shuffled.
    """
    if not repeated:
        return df.join(store.select(key), key, "left_anti")
    return _split(df, key).join(_split(store.select(key), key), [key, "__split"], "left_anti").drop("__split")


def duplicate_flag(df: DataFrame, store: DataFrame, key: str = "content_hash",
                   order: str = "arrival_seq") -> DataFrame:
    """Every row kept, with ``is_duplicate`` as the sequential check would answer.

    The first arrival per key and the store membership are found on one row
    per key; the rows then meet that result once.
    """
    firsts = df.groupBy(key).agg(F.min(order).alias("__first"))
    known = store.select(key).distinct().withColumn("__known", F.lit(True))
    verdict = firsts.join(known, key, "left")
    return (
        _split(df, key).join(_split(verdict, key), [key, "__split"], "left")
        .withColumn("is_duplicate",
                    F.coalesce(F.col("__known"), F.lit(False)) | (F.col(order) > F.col("__first")))
        .drop("__first", "__known", "__split")
    )


def store_rows(posts: DataFrame, *more: str) -> DataFrame:
    """Posts as seen-store rows; first seen is the creation time, not the clock."""
    created = F.coalesce(F.col("created_utc"), F.lit(0)).cast("bigint")
    return posts.select(
        text_or_empty(F.col("post_id")).alias("post_id"), "content_hash",
        text_or_empty(F.col("title")).alias("title"),
        text_or_empty(F.col("subreddit")).alias("subreddit"),
        created.alias("created_utc"), created.alias("first_seen_utc"), *more)


def insert_if_absent(batch: DataFrame, store: DataFrame, order: str = "arrival_seq") -> DataFrame:
    """The store rows a batch adds: neither its hash nor its id may be there yet.

    Within the batch the earliest row per hash, then the earliest per id, wins;
    :func:`dedup_strict` is the exact sequential rule for ids with many hashes.
    """
    hashed = batch if "content_hash" in batch.columns else with_hash(batch)
    fresh = dedup_first_wins(hashed, "content_hash", order)
    rows = store_rows(fresh, order)
    rows = rows.join(store.select("content_hash"), "content_hash", "left_anti")
    rows = rows.join(store.select("post_id"), "post_id", "left_anti")
    return first_per_key(rows, ["post_id"], [F.col(order)]).drop(order)


def dedup_strict(df: DataFrame, store: DataFrame | None = None, *, id_col: str = "post_id",
                 key: str = "content_hash",
                 order: str = "arrival_seq") -> tuple[DataFrame, DataFrame]:
    """Sequential two-key semantics: ``(emitted, stored)``.

    A row is emitted while its hash is not stored, and stored only if its id is
    not stored either. The stored rows are the first-come matching of ids and
    hashes, found in parallel rounds: each round stores every pair that is the
    earliest left of both its id and its hash, and drops the pairs that touch a
    stored id or hash. Copies of one pair are collapsed first, and every round
    works on pairs and per-key minima only, so a hot id or hash is combined
    before it is shuffled. Runs one small action per round; every round settles
    at least the earliest pair left, and a chain of pairs takes a round per two.
    """
    base = df.withColumn(id_col, text_or_empty(F.col(id_col)))
    pairs = base.groupBy(id_col, key).agg(F.min(order).alias("seq"))
    if store is not None:
        pairs = pairs.join(store.select(key), key, "left_anti") \
                     .join(store.select(id_col), id_col, "left_anti")
    live = cut_lineage(pairs)
    found: list[DataFrame] = []
    while not live.isEmpty():
        by_id = live.groupBy(id_col).agg(F.min("seq").alias("seq"))
        by_key = live.groupBy(key).agg(F.min("seq").alias("seq"))
        hit = cut_lineage(by_id.join(by_key, "seq").select(id_col, key, "seq"))
        found.append(hit)
        live = cut_lineage(live.join(hit.select(id_col), id_col, "left_anti")
                           .join(hit.select(key), key, "left_anti"))
    stored = reduce(DataFrame.unionByName, found) if found else pairs.limit(0)
    open_rows = base if store is None else base.join(store.select(key), key, "left_anti")
    emitted = (
        open_rows.join(stored.select(key, F.col("seq").alias("__stored")), key, "left")
        .filter(F.col("__stored").isNull() | (F.col(order) <= F.col("__stored")))
        .select(*df.columns)
    )
    return emitted, stored.withColumnRenamed("seq", order)


def store_stats(store: DataFrame) -> DataFrame:
    """Total rows, oldest and newest first-seen time."""
    return store.agg(F.count(F.lit(1)).alias("total_posts"),
                     F.min("first_seen_utc").alias("oldest_post"),
                     F.max("first_seen_utc").alias("newest_post"))


def store_by_community(store: DataFrame) -> DataFrame:
    return (store.groupBy("subreddit").agg(F.count(F.lit(1)).alias("posts"))
            .orderBy(F.desc("posts"), "subreddit"))
