"""Connected components of a link table, fully distributed.

Alternating large-star / small-star rounds: every round rewires each node to
the smallest node it sees, so stars collapse at once and chains in a
logarithmic number of rounds. Links never leave the executors; each round is
checkpointed and only one checksum row returns to the driver. The steps' tasks follow
the counted links, so that few links make few files and shuffle blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, tasks_for


def _fingerprint(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Each node and its smaller neighbours to the smallest of them (a > b holds)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return (moved.where("a <> b").unionAll(least.select("a", F.col("m").alias("b")))
            .coalesce(tasks).distinct().coalesce(tasks))


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Each larger neighbour of a node to the smallest node of its neighbourhood."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")) \
        .select("a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
            .coalesce(tasks).distinct().coalesce(tasks))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b); root: smallest node reachable.

    Links in any direction, repeated or to oneself are fine; nodes with a null
    end are ignored. No links give no rows.
    """
    e = (edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
         .distinct())
    e = checkpoint(e)
    seen = _fingerprint(e)
    tasks = tasks_for(seen[0])
    e = e.coalesce(tasks)
    while seen[0]:
        e = checkpoint(_small_star(_large_star(e, tasks), tasks))
        now = _fingerprint(e)
        if now == seen:
            break
        seen = now
    # Converged: every node but the roots has exactly one edge, to its root.
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
