"""Connected components against plain merging, and how many files and tasks the driver has to keep track of."""

from __future__ import annotations

import random

import pytest

from labelloom.llm import graph, jaccard


@pytest.fixture
def many_partitions(spark):
    """Far more shuffle partitions than small tables need, none of which Spark merges."""
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def merged(links):
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            low, high = sorted((top(a), top(b)))
            root[high] = low
    return {x: top(x) for x in list(root)}


def test_components_in_few_files(spark, many_partitions, monkeypatch):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(200, 240)] + [(1000, -i) for i in range(1, 60)] + [(7, 8), (8, 7), (9, 9), (None, 5), (5, None)]
    links += [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(90)]
    written = []
    land = graph.land
    monkeypatch.setattr(graph, "land", lambda df, name: written.append(land(df, name)) or written[-1])
    got = {r["node"]: r["comp"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == merged(links)
    cores = spark.sparkContext.defaultParallelism
    assert len(written) > 2 and max(len(t.inputFiles()) for t in written) <= cores
    assert graph.components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long")).count() == 0


def test_jobs_of_near_duplicates(spark, many_partitions):
    """Bands are kept with each distinct set, buckets are made once, and used sets are listed once."""
    rng = random.Random(5)
    pool = [f"w{i}" for i in range(900)]
    rows = [(i, " ".join(rng.choices(pool, k=60))) for i in range(40)]
    rows += [(100 + i, rows[i % 5][1] + f" tail{i}") for i in range(60)]
    sc = spark.sparkContext
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sc.setJobGroup("near", "near duplicates")
    try:
        kept = {r["doc_id"] for r in jaccard.drop_near_duplicates(docs).select("doc_id").collect()}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert kept == set(range(40))
    jobs = [sc.statusTracker().getJobInfo(i) for i in sc.statusTracker().getJobIdsForGroup("near")]
    stages = {s for j in jobs for s in j.stageIds}
    done = sum(i.numCompletedTasks for i in map(sc.statusTracker().getStageInfo, stages) if i)
    assert 0 < done < 1600
