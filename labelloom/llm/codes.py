"""Vector code compression by ball k-means: product codes whose codebooks are trained exactly.

A codebook's entry and the parts it holds are a ball, whose radius is the largest distance of such a
part. Entries further away than twice the radius can win none of its parts; the others are its
neighbours. A ball without neighbours is stable, and so is one that did not move and whose neighbours
did not either: its parts are not compared with anything. In other balls, a part within half the
way to the nearest neighbour lies in the stable core and stays; the rest lie in rings between half the
distances to successive neighbours, and a part is compared only with the neighbours of its ring
and those further in. All comparisons are of exact squared distances of whole numbers, where
"at most half as far" is 4 a <= b, and ties go to the lower index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.llm import vectors
from labelloom.llm.store import land, unland
from labelloom.session import small_side

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096

_SLACK = 1e-9


class Balls:
    """One part position's entries, for one round: their neighbours and which balls moved."""

    def __init__(self, entries: np.ndarray, before: np.ndarray | None, radii: np.ndarray | None):
        k = len(entries)
        self.entries = entries
        gaps = vectors.apart(entries)
        moves = np.zeros(k) if before is None else np.sqrt(vectors.squared(entries, before).astype(float))
        # Radii of the last assignment grow by the entry's move at most.
        reach = np.full(k, np.inf) if radii is None else (np.sqrt(radii.astype(float)) + moves) * (1 + _SLACK)
        others = ~np.eye(k, dtype=bool)
        close = others & (np.sqrt(gaps.astype(float)) <= 2 * reach[:, None] * (1 + _SLACK))
        still = moves == 0
        self.moved = ~still
        # Nothing can change in a ball that stands still among neighbours that do.
        self.idle = still & ~(close & ~still[None, :]).any(axis=1) if before is not None else np.zeros(k, dtype=bool)
        # Neighbours by distance, padded with a distance that no ring reaches.
        none = np.iinfo(np.int64).max
        gaps = np.where(close, gaps, none)
        order = np.argsort(gaps, axis=1, kind="stable")
        self.near, self.gap = order, np.take_along_axis(gaps, order, axis=1)
        self.none = none


def assign(x: np.ndarray, code: np.ndarray, d: np.ndarray, balls: Balls) -> int:
    """Bring entry and squared distance of the parts in the rows of `x` up to date, in place.

    Returns the number of distances to other entries that were computed.
    """
    old = code.copy()
    far = balls.moved[old]
    d[far] = vectors.squared(x[far], balls.entries[old[far]])
    # Distances to the ball's own entry decide the rings, whatever is found on the way.
    ring = np.minimum(d, balls.none // 8) * 4
    live, own = np.flatnonzero(~balls.idle[old]), d.copy()
    tried = 0
    for rank in range(balls.near.shape[1]):
        gap = balls.gap[old[live], rank]
        live = live[(gap != balls.none) & (gap <= ring[live])]
        if not len(live):
            break
        there = balls.near[old[live], rank]
        new = vectors.squared(x[live], balls.entries[there])
        tried += len(live)
        best = (new < own[live]) | ((new == own[live]) & (there < code[live]))
        at = live[best]
        own[at], code[at] = new[best], there[best]
    d[:] = own
    return tried


def _round(batches: Iterator[pa.RecordBatch], balls: list[Balls], dim: int, fresh: bool) -> Iterator[pa.RecordBatch]:
    parts = len(balls)
    for batch in batches:
        x = vectors.matrix(batch.column("vec"), parts * dim).reshape(batch.num_rows, parts, dim)
        old = (np.full((batch.num_rows, parts), -1, dtype=np.int64) if fresh else vectors.matrix(batch.column("now"), parts))
        now = np.maximum(old, 0)
        d = np.empty(old.shape, dtype=np.int64)
        if not fresh:
            d[:] = vectors.matrix(batch.column("d"), parts)
        for p, ball in enumerate(balls):
            part, code, gap = np.ascontiguousarray(x[:, p]), now[:, p].copy(), d[:, p].copy()
            if fresh:
                gap[:] = vectors.squared(part, ball.entries[code])
            assign(part, code, gap, ball)
            now[:, p], d[:, p] = code, gap
        yield pa.record_batch(
            [batch.column("vec_id"), batch.column("label"), batch.column("vec"), vectors.lists(now, pa.int32()),
             vectors.lists(old, pa.int32()), vectors.lists(d, pa.int64())], names=["vec_id", "label", "vec", "now", "old", "d"])


def _radii(state: DataFrame, parts: int, entries: int) -> np.ndarray:
    """Largest squared distance of each ball; 0 for one without parts. Maxima are taken in each task first."""
    pairs = state.select(F.posexplode(F.arrays_zip("now", "d")).alias("part", "z"))
    rows = pairs.groupBy("part", F.col("z.now").alias("entry")).agg(F.max("z.d").alias("d")).collect()
    radii = np.zeros((parts, entries), dtype=np.int64)
    for r in rows:
        radii[r["part"], r["entry"]] = r["d"]
    return radii


def _length(given: DataFrame, parts: int) -> int:
    """The length of most vectors, the larger of equals, among those that can be cut into equal parts."""
    size = F.size("vector")
    found = (given.select(size.alias("n")).filter((F.col("n") > 0) & (F.col("n") % parts == 0)).groupBy("n")
             .agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("n")).first())
    return found["n"] if found else 0


def _code(now: Column) -> Column:
    return F.concat_ws("", F.transform(now, lambda i: F.lower(F.lpad(F.hex(i), 2, "0"))))


def codes(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
          id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector without null or non-finite components.

    Components become floor(scale * x), held to 2^27 on either side (exact up to there, for vectors of
    up to 64 components). Where lengths differ, the length that most vectors have counts, the larger of
    equals; vectors of another length, or of one that `parts` does not divide, are left out. Codebooks
    start as the parts of the `entries` vectors with the smallest ids, null ids last and equal ids by
    their components; of fewer vectors there are fewer entries, of none no rows. A table without the
    label column has null labels. Repeated rows each come back. Sums beyond the largest long are held
    to it. Other columns are ignored. At most 256 entries fit a code's two digits.
    """
    if entries > 256:
        raise ValueError("a code has two hex digits a part, so there are at most 256 entries")
    vector = F.col(f"`{vector_col}`")
    label = F.col(f"`{label_col}`") if label_col in embeddings.columns else F.lit(None).cast("int")
    given = (embeddings.filter(vectors.complete(vector))
             .select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), label.alias("label"), vector.alias("vector")))
    length = _length(given, parts)
    spark = embeddings.sparkSession
    if not length:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    state = given.filter(F.size("vector") == length).select("vec_id", "label", vectors.whole(F.col("vector"), scale).alias("vec"))
    kind = state.schema["label"].dataType.simpleString()
    schema = f"vec_id long, label {kind}, vec array<int>, now array<int>, old array<int>, d array<bigint>"
    seeds = state.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).collect()
    dim, books = length // parts, np.array([r["vec"] for r in seeds], dtype=np.int64)
    books = books.reshape(len(seeds), parts, dim).transpose(1, 0, 2)
    counts, sums = np.zeros(books.shape[:2], dtype=object), np.zeros(books.shape, dtype=object)
    before, radii = [None] * parts, [None] * parts
    for turn in range(rounds + 1):
        balls = [Balls(books[p], before[p], radii[p]) for p in range(parts)]
        passed = land(state.mapInArrow(partial(_round, balls=balls, dim=dim, fresh=turn == 0), schema), "codes")
        if turn:
            unland(state)
        state = passed
        if turn < rounds:
            more, change = vectors.moved_sums(state, books.shape[1], dim, parts)
            counts, sums = counts + more, sums + change
            before, radii = books, _radii(state, parts, books.shape[1])
            books = np.stack([vectors.means(books[p], counts[p], sums[p]) for p in range(parts)])
    digest = hashlib.sha256(vectors.digits(books).encode()).hexdigest()
    errors = F.aggregate("d", F.lit(0).cast("decimal(38,0)"), lambda a, v: (a + v).cast("decimal(38,0)"))
    coded = land(state.select("vec_id", "label", _code(F.col("now")).alias("code"), vectors.as_long(errors).alias("error")), "codes")
    unland(state)
    per_label = coded.groupBy(F.col("label").alias("_label")).agg(
        vectors.as_long(F.sum(F.col("error").cast("decimal(38,0)"))).alias("label_error"))
    return (coded.join(small_side(per_label), F.col("label").eqNullSafe(F.col("_label")))
            .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))
