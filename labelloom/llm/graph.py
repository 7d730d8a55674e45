"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.store import land
from labelloom.session import TASK_ROWS

ROUNDS = 60


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp): the smallest node that each linked node reaches; nodes without links are absent.

    Every round each node takes the smallest label among its neighbours' and its own, then the label
    of its label, so labels halve their way to the root. Links and labels stay distributed, each
    round is written to the shared folder, and the minimum is pre-aggregated before its shuffle, so a
    node with very many links is no task's burden. A round is written by one task per TASK_ROWS link ends and
    at least one per core, however many shuffle partitions there are: the driver keeps something of every
    task and file. Links with a null end are ignored.
    """
    one = links.select(F.col(a).alias("u"), F.col(b).alias("v")).dropna().filter("u != v")
    tasks = max(-(-2 * one.count() // TASK_ROWS), one.sparkSession.sparkContext.defaultParallelism)
    both = land(one.union(one.select("v", "u")).distinct().coalesce(tasks), "links")
    labels = land(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("l")).coalesce(tasks), "labels")
    for _ in range(ROUNDS):
        told = both.join(labels.select(F.col("u").alias("v"), "l"), "v").select("u", "l", F.lit(None).cast("long").alias("old"))
        step = (told.union(labels.select("u", "l", F.col("l").alias("old"))).groupBy("u")
                .agg(F.min("l").alias("l"), F.max("old").alias("old")))
        root = labels.select(F.col("u").alias("l"), F.col("l").alias("up"))
        labels_next = land(
            step.join(root, "l").select("u", F.least("l", "up").alias("l"), (F.least("l", "up") != F.col("old")).alias("moved"))
            .coalesce(tasks), "labels")
        labels = labels_next.select("u", "l")
        if labels_next.filter("moved").limit(1).count() == 0:
            return labels.select(F.col("u").alias("node"), F.col("l").alias("comp"))
    raise RuntimeError(f"labels still move after {ROUNDS} rounds")
