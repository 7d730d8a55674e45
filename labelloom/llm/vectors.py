"""Vectors as whole numbers, and their exact sums per group, for the two operators that cluster them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Components are held to this many steps on either side, so that a squared distance of up to 64 of them fits a long.
MOST = 1 << 27
LARGEST = (1 << 63) - 1


def complete(vector: Column) -> Column:
    """True for a vector without null or non-finite components; false for a null vector."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~odd, F.lit(False))


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component as an int, x taken as a double."""
    return F.transform(vector, lambda x: F.floor(
        F.least(F.greatest(x.cast("double") * scale, F.lit(float(-MOST))), F.lit(float(MOST)))).cast("int"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column of `dim` whole numbers each."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(len(column), dim)


def lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from the rows of a matrix."""
    n, dim = rows.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * dim, pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(rows.reshape(-1), kind))


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows, as longs."""
    gap = x - c
    return np.einsum("ij,ij->i", gap, gap)


def apart(centres: np.ndarray) -> np.ndarray:
    """Exact squared distances between all centres."""
    gap = centres[:, None, :] - centres[None, :, :]
    return np.einsum("ijk,ijk->ij", gap, gap)


def digits(rows: np.ndarray) -> str:
    """All numbers of a matrix in order, as decimal text joined by commas."""
    return ",".join(str(v) for v in rows.reshape(-1).tolist())


def _moved(batches: Iterator[pa.RecordBatch], groups: int, dim: int, parts: int) -> Iterator[pa.RecordBatch]:
    """What the rows of a task that changed their group add to the sums: one row per group and part that changed."""
    sums = np.zeros((parts, groups, dim), dtype=np.int64)
    counts = np.zeros((parts, groups), dtype=np.int64)
    for batch in batches:
        x = matrix(batch.column(0), parts * dim).reshape(batch.num_rows, parts, dim)
        now, old = (matrix(batch.column(i), parts) for i in (1, 2))
        for p in range(parts):
            rows = np.flatnonzero(now[:, p] != old[:, p])
            for group, sign in ((now[rows, p], 1), (old[rows, p], -1)):
                for g in np.unique(group[group >= 0]):
                    mine = rows[group == g]
                    sums[p, g] += sign * x[mine, p].sum(axis=0)
                    counts[p, g] += sign * len(mine)
    part, group = np.nonzero((counts != 0) | (sums != 0).any(axis=2))
    yield pa.record_batch([pa.array(part, pa.int32()), pa.array(group, pa.int32()), pa.array(counts[part, group], pa.int64()),
                           lists(sums[part, group], pa.int64())], names=["part", "grp", "n", "sums"])


def moved_sums(state: DataFrame, groups: int, dim: int, parts: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Changes of counts (parts x groups) and of component sums (parts x groups x dim) between two assignments.

    `state` has `vec`, `now` and `old`: arrays of whole numbers, of the groups of each part now and
    before (-1: none). Only rows that changed are read into the sums; each task adds up its own, and
    what arrives here are parts x groups x dim numbers at most.
    """
    told = (state.filter("now != old").select("vec", "now", "old")
            .mapInArrow(partial(_moved, groups=groups, dim=dim, parts=parts), "part int, grp int, n long, sums array<bigint>"))
    long = told.select("part", "grp", "n", F.posexplode("sums").alias("at", "v"))
    rows = (long.groupBy("part", "grp", "at")
            .agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect())
    # Python's own numbers: sums over any number of rows.
    counts, sums = np.zeros((parts, groups), dtype=object), np.zeros((parts, groups, dim), dtype=object)
    for r in rows:
        counts[r["part"], r["grp"]] = int(r["n"])
        sums[r["part"], r["grp"], r["at"]] = int(r["v"])
    return counts, sums


def means(centres: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """floor(sum / count) of each component; a centre without members stays."""
    out = centres.copy()
    for g in np.flatnonzero(counts > 0):
        out[g] = [int(v) // int(counts[g]) for v in sums[g]]
    return out


def as_long(total: Column) -> Column:
    """A sum of decimals as a long, held to the largest one."""
    return F.least(total, F.lit(LARGEST).cast("decimal(38,0)")).cast("long")
