"""Centroid clustering by shallot search: exact k-means with bounds.

Every vector carries its centroid, the one that was second, an upper bound of the distance to the
first and a lower bound of the distance to all others. While the centroids' moves leave the bounds
apart, or the vector lies within half the way to its centroid's next one, nothing is computed. Else
both remembered centroids are measured, and the search starts at the closer one: its neighbours, sorted
by their distance from it, are looked at in turn as long as they lie in a ball around it whose radius
is the vector's distance to it plus the second best distance found. A closer find shrinks that
ball. Bounds are floating point with a margin that only ever makes the search wider; what they let
through is compared by exact squared distances of whole numbers, ties going to the smaller number.

The vectors stay where they are: a round is one pass that writes vectors with their bounds, and sums
of the vectors that changed their centroid, added to the sums of the round before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm import vectors
from labelloom.llm.store import land, unland

CLUSTERS = 40
ROUNDS = 5
DIM = 64
SCALE = 256
SEED = 2

_SLACK = 1e-9
_STATE = "vec_id long, vec array<int>, now array<int>, old array<int>, second int, upper double, lower double"


class Neighbours:
    """The centroids of a round, each with the others by distance, and how far the last update moved them."""

    def __init__(self, centres: np.ndarray, before: np.ndarray | None = None):
        self.centres = centres
        gaps = vectors.apart(centres)
        k = len(centres)
        order = np.argsort(gaps, axis=1, kind="stable")
        # Not the centroid itself, which need not come first where centroids are equal.
        self.near = np.array([row[row != i] for i, row in enumerate(order)], dtype=np.int64).reshape(k, k - 1)
        self.far = np.sqrt(np.take_along_axis(gaps, self.near, axis=1).astype(float)) if k > 1 else np.zeros((1, 0))
        self.half = self.far[:, 0] / 2 if k > 1 else np.full(1, np.inf)
        moves = np.sqrt(vectors.squared(centres, before).astype(float)) if before is not None else np.zeros(k)
        self.moves = moves * (1 + _SLACK)
        # The largest move of any other centroid.
        self.others = np.array([np.delete(self.moves, i).max(initial=0.0) for i in range(k)])


def search(x: np.ndarray, first: np.ndarray, second: np.ndarray, known: Neighbours):
    """Nearest and second nearest centroid of every row of `x` with squared distances, from two to start with."""
    centres = known.centres
    d1, d2 = vectors.squared(x, centres[first]), vectors.squared(x, centres[second])
    swap = (d2 < d1) | ((d2 == d1) & (second < first))
    near, next_ = np.where(swap, second, first), np.where(swap, first, second)
    near_d, next_d = np.where(swap, d2, d1), np.where(swap, d1, d2)
    start, reach = near.copy(), np.sqrt(near_d.astype(float))
    live = np.arange(len(x))
    for rank in range(known.near.shape[1]):
        ball = reach[live] + np.sqrt(next_d[live].astype(float))
        live = live[known.far[start[live], rank] <= ball * (1 + _SLACK) + _SLACK]
        if not len(live):
            break
        there = known.near[start[live], rank]
        new = (there != near[live]) & (there != next_[live])
        at, there = live[new], there[new]
        d = vectors.squared(x[at], centres[there])
        best = (d < near_d[at]) | ((d == near_d[at]) & (there < near[at]))
        better = best | (d < next_d[at]) | ((d == next_d[at]) & (there < next_[at]))
        to = at[best]
        next_[to], next_d[to] = near[to], near_d[to]
        near[to], near_d[to] = there[best], d[best]
        only = better & ~best
        next_[at[only]], next_d[at[only]] = there[only], d[only]
    return near, next_, near_d, next_d


def assign(x: np.ndarray, first: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray, known: Neighbours):
    """One round for the rows of `x`: their state, after the moves of the centroids, brought up to date.

    Also returns how many rows had to be searched.
    """
    first, second = first.copy(), second.copy()
    upper = upper + known.moves[first]
    lower = np.maximum(lower - known.others[first], 0.0)
    floor = np.maximum(lower, known.half[first])
    open_ = np.flatnonzero(upper * (1 + _SLACK) >= floor * (1 - _SLACK))
    upper[open_] = np.sqrt(vectors.squared(x[open_], known.centres[first[open_]]).astype(float))
    open_ = open_[upper[open_] * (1 + _SLACK) >= floor[open_] * (1 - _SLACK)]
    if len(known.centres) > 1 and len(open_):
        near, next_, near_d, next_d = search(x[open_], first[open_], second[open_], known)
        first[open_], second[open_] = near, next_
        upper[open_], lower[open_] = np.sqrt(near_d.astype(float)), np.sqrt(next_d.astype(float))
    return first, second, upper, lower, len(open_)


def _round(batches: Iterator[pa.RecordBatch], known: Neighbours, fresh: bool) -> Iterator[pa.RecordBatch]:
    dim = known.centres.shape[1]
    for batch in batches:
        x, n = vectors.matrix(batch.column("vec"), dim), batch.num_rows
        if fresh:
            old = np.full(n, -1, dtype=np.int64)
            state = np.zeros(n, np.int64), np.full(n, min(1, len(known.centres) - 1)), np.full(n, np.inf), np.zeros(n)
        else:
            old = vectors.matrix(batch.column("now"), 1)[:, 0]
            state = old, *(batch.column(c).to_numpy() for c in ("second", "upper", "lower"))
        first, second, upper, lower, _ = assign(x, *state, known)
        yield pa.record_batch(
            [batch.column("vec_id"), batch.column("vec"), vectors.lists(first[:, None], pa.int32()),
             vectors.lists(old[:, None], pa.int32()), pa.array(second, pa.int32()), pa.array(upper), pa.array(lower)],
            names=["vec_id", "vec", "now", "old", "second", "upper", "lower"])


def _distances(batches: Iterator[pa.RecordBatch], centres: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, now = vectors.matrix(batch.column("vec"), centres.shape[1]), vectors.matrix(batch.column("now"), 1)[:, 0]
        yield pa.record_batch([batch.column("vec_id"), pa.array(now, pa.int32()), pa.array(vectors.squared(x, centres[now]))],
                              names=["vec_id", "cluster", "distance"])


def clusters(embeddings: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE,
             id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector with `dim` finite components.

    Other rows are left out. Components become floor(scale * x), held to 2^27 on either side (the
    numbers are exact up to there, for `dim` up to 64). Centroids start as the `k` vectors with the
    smallest sha256 of `2:<id>`; a null id counts as an empty text, and equal hashes go by components.
    With fewer than `k` vectors there are as many centroids; without any, no rows. Repeated
    rows each come back. Sums beyond the largest long are held to it. Other columns are ignored.
    """
    column = F.col(f"`{vector_col}`")
    given = (embeddings.filter((F.size(column) == dim) & vectors.complete(column))
             .select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vectors.whole(column, scale).alias("vec")))
    order = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    seeds = given.orderBy(order, "vec").limit(k).collect()
    if not seeds:
        return embeddings.sparkSession.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centres, before = np.array([r["vec"] for r in seeds], dtype=np.int64), None
    counts, sums = np.zeros(len(centres), dtype=object), np.zeros(centres.shape, dtype=object)
    state = given
    for turn in range(rounds + 1):
        passed = land(state.mapInArrow(partial(_round, known=Neighbours(centres, before), fresh=turn == 0), _STATE), "clusters")
        if turn:
            unland(state)
        state = passed
        if turn < rounds:
            more, change = vectors.moved_sums(state, len(centres), dim)
            counts, sums = counts + more[0], sums + change[0]
            centres, before = vectors.means(centres, counts, sums), centres
    result = land(state.mapInArrow(partial(_distances, centres=centres), "vec_id long, cluster int, distance long"), "distances")
    unland(state)
    # One row per centroid.
    totals = {r["cluster"]: int(r["total"]) for r in
              result.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    every = min(sum(totals.values()), vectors.LARGEST)
    facts = [(c, min(total, vectors.LARGEST), every, hashlib.sha256(vectors.digits(centres[c]).encode()).hexdigest())
             for c, total in sorted(totals.items())]
    told = embeddings.sparkSession.createDataFrame(
        facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return result.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
