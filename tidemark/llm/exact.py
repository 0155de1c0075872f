"""Operator 12: exact copies by a tree merge of sorted digest runs, in DataFrame operations alone.

Every input partition is a run: its texts' digests, sorted, each once, with the
number of rows and the row that would stay. Runs are merged in rounds,
``FAN_IN`` neighbours into one, until a single run is left: a round gathers the
equal digests of neighbours, which sorting has put beside each other, adds their
counts and keeps the better of their rows. A run has no task of its own; its
digests are spread over all tasks by (run, digest), so the last round is as even
as the first. A digest has one row in a run, however many copies the run holds,
so a round moves at most ``FAN_IN`` rows of a digest to one task, also where a
third of all rows are copies of one text.

The answer goes back the way it came: each run's row is joined with the one of
the run that it was merged into, and the documents with those of their own run.
No key of these joins has more rows than a run has copies.

Texts are equal where SHA-256, length in bytes and a second 64-bit hash agree;
every merge is by all three, so a row never stands for a text that only shares
its digest. Every round is written to the shared folder, so that a lost executor
costs a part of one round.

Rows: null counts as empty text. The row with the largest id stays (or the
smallest, as asked), of rows with that id one; a null id stays only where all
ids are null. Every row of the input gives one row, copies and repeats included.
Very long texts are digested where they are read and not moved. Other columns
are ignored by :func:`mark_copies` and carried by :func:`keep_one`. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Runs that one round merges into one.
FAN_IN = 16

#: What must agree for two texts to be one.
SAME = ["digest", "size", "check"]

Normaliser = Callable[[Column], Column]


def _same(text: Column) -> list[Column]:
    return [F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).alias("size"),
            F.xxhash64(text).alias("check")]


def _text(docs: DataFrame, text: str, normalise: Normaliser | None) -> Column:
    column = F.coalesce(docs[text].cast("string"), F.lit(""))
    return normalise(column) if normalise else column


def leaves(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", normalise: Normaliser | None = None) -> DataFrame:
    """A row per document: its run, its place, its id and what tells its text apart. Written once, as places are not stable."""
    return written(docs.select(F.spark_partition_id().alias("run"), F.monotonically_increasing_id().alias("place"),
                               docs[doc_id].cast("bigint").alias("id"), *_same(_text(docs, text, normalise))), "digests")


def merge_runs(rows: DataFrame, fan_in: int) -> DataFrame:
    """Merge ``fan_in`` neighbouring runs (of run, digest, size, check, best, n) into one."""
    run = F.expr(f"cast(run div {fan_in} as int)").alias("run")
    return rows.groupBy(run, *SAME).agg(F.max("best").alias("best"), F.sum("n").alias("n"))


def merge_tree(rows: DataFrame, largest: bool = True, fan_in: int = FAN_IN) -> list[DataFrame]:
    """The runs of every round: first those of the partitions, last a single one."""
    # Of equal ids the row that was read first; the larger struct is the better row.
    rank = F.col("id") if largest else -F.col("id")
    best = F.struct(rank.alias("rank"), (-F.col("place")).alias("place"))
    rounds = [written(rows.select("run", *SAME, best.alias("best"), F.lit(1).cast("bigint").alias("n"))
                      .transform(merge_runs, 1), "run")]
    runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    while runs > 1:
        rounds.append(written(merge_runs(rounds[-1], fan_in), "run"))
        runs = -(-runs // fan_in)
    return rounds


def _settled(rounds: list[DataFrame], fan_in: int) -> DataFrame:
    """The first round's rows with the final ``best`` and ``n`` of their text, handed down round by round."""
    final = rounds[-1]
    for lower in reversed(rounds[:-1]):
        own = lower.select(F.col("run").alias("child"), F.expr(f"cast(run div {fan_in} as int)").alias("run"), *SAME)
        final = own.join(final, ["run", *SAME]).select(F.col("child").alias("run"), *SAME, "best", "n")
    return final


def mark_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", largest: bool = True,
                normalise: Normaliser | None = None, fan_in: int = FAN_IN) -> DataFrame:
    """doc_id, keep_id (id of the row that stays), group_size, kept, text_sha256 for every row of ``docs``."""
    rows = leaves(docs, text, doc_id, normalise)
    final = _settled(merge_tree(rows, largest, fan_in), fan_in)
    keep = F.col("best.rank") if largest else -F.col("best.rank")
    return rows.join(final, ["run", *SAME]).select(
        F.col("id").alias("doc_id"), keep.alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("place") == -F.col("best.place")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", largest: bool = True,
             normalise: Normaliser | None = None) -> DataFrame:
    """One row of every text, with the columns of ``docs``; of rows that share id and text any one."""
    kept = mark_copies(docs, text, doc_id, largest, normalise).filter("kept")
    kept = kept.select(F.col("doc_id").alias("id"), F.unhex("text_sha256").alias("digest"))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[doc_id].cast("bigint").alias("id"),
                       _same(_text(docs, text, normalise))[0])
    rows = rows.groupBy("id", "digest").agg(F.first("row").alias("row"))
    return rows.join(kept, rows["id"].eqNullSafe(kept["id"]) & (rows["digest"] == kept["digest"])).select("row.*")
