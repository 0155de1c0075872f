"""Connected components of a link table, as joins of links only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


#: Links that a task of a round takes at least, so that rounds over few links are not cut into a task for each handful.
TASK_LINKS = 50_000


def components(links: DataFrame) -> DataFrame:
    """(id, root): the smallest id that each linked id (``a``, ``b``) reaches.

    Alternates two steps until every class is a star: every node hands its smallest
    neighbour to its larger neighbours, then to its smaller ones. A large class
    turns into a star in a logarithmic number of rounds. A node's links are only
    ever reduced to their minimum, never gathered; the join back to them is one
    of plain shuffles, which Spark can split where a node has very many. Each
    round is written to the shared folder, by as many tasks as its links ask for.
    """
    cores = links.sparkSession.sparkContext.defaultParallelism
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                         .filter("u <> v").distinct(), "links")
    while True:
        tasks = max(cores, edges.count() // TASK_LINKS)
        both = edges.union(edges.select(F.col("v"), F.col("u"))).toDF("u", "v")
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
                            .coalesce(tasks), "least")
        # Stars: every node but the smallest has one link, that to the smallest.
        if least.filter("m < u and n > 1").isEmpty():
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
        least = least.drop("n")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").coalesce(tasks).distinct().coalesce(tasks)
        least = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
        small = large.join(least, "u")
        # A node keeps its smallest neighbour, and its other smaller ones get that one too.
        small = small.select("u", F.col("m").alias("v")).union(
            small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = written(small.filter("u <> v").coalesce(tasks).distinct().coalesce(tasks), "links")
