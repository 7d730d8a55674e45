"""Pareto front over several objectives, larger is better.

Candidates are what local fronts leave. They are dealt to the cells of a grid, cut at quantiles of every
objective, and each cell is known by its corners: the least and the largest value of every objective in
it. A cell whose upper corner another cell's lower corner dominates goes as a whole, before any points
meet; and two cells meet only if the upper corner of one is not below the lower corner of the other
anywhere. What a front leaves of a grid is thin, so most pairs of cells never meet.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.session import save_point

CANDIDATES_PER_CHUNK = 20_000
# Bounds what the driver sees of a grid: two corners and a size per cell.
MOST_CELLS = 512
# Stands for a null objective, which is worse than any number.
NULL_KEY = np.iinfo(np.int64).min


def order_keys(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of doubles; NaN, which stands for null, comes before minus infinity."""
    bits = (values.astype(np.float64) + 0.0).view(np.int64)
    keys = np.where(bits < 0, bits ^ np.iinfo(np.int64).max, bits)
    return np.where(np.isnan(values), NULL_KEY, keys)


def _dominated(points: np.ndarray, rivals: np.ndarray) -> np.ndarray:
    """Which points some rival matches everywhere and beats somewhere."""
    hit = np.zeros(len(points), dtype=bool)
    for start in range(0, len(rivals), 256):
        block = rivals[start:start + 256]
        open_rows = np.flatnonzero(~hit)
        for i in range(0, len(open_rows), 1024):
            rows = open_rows[i:i + 1024]
            theirs, mine = block[None, :, :], points[rows][:, None, :]
            hit[rows] = ((theirs >= mine).all(axis=2) & (theirs > mine).any(axis=2)).any(axis=1)
    return hit


def _front(points: np.ndarray) -> np.ndarray:
    """Positions of the points no other one dominates, found from the largest sum of ranks downwards."""
    ranks = np.zeros(len(points), dtype=np.int64)
    for column in points.T:
        ranks += np.unique(column, return_inverse=True)[1].reshape(-1)
    order = np.argsort(-ranks, kind="stable")
    kept = np.empty(0, dtype=np.int64)
    for start in range(0, len(order), 256):
        block = order[start:start + 256]
        block = block[~_dominated(points[block], points[kept])]
        block = block[~_dominated(points[block], points[block])]
        kept = np.concatenate([kept, block])
    return np.sort(kept)


def meeting_cells(lower: np.ndarray, upper: np.ndarray) -> list[tuple[int, int]]:
    """(cell, rival) for every cell that no lower corner dominates and each rival that may hold a point above one of its own."""
    open_cells = np.flatnonzero(~_dominated(upper, lower))
    pairs = []
    for cell in open_cells:
        rivals = open_cells[(upper[open_cells] >= lower[cell]).all(axis=1)]
        pairs.extend((int(cell), int(rival)) for rival in rivals)
    return pairs


def _gridded(candidates: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add `_cell`: the number of quantiles below the value of every objective, nulls first, as one text."""
    per_objective = max(2, int(round(MOST_CELLS ** (1 / len(names)) - 0.5)))
    used = names[:int(np.log2(MOST_CELLS))]  # beyond nine objectives two halves of each are too many cells
    shares = [i / per_objective for i in range(1, per_objective)]
    cuts = candidates.select(F.struct(*[
        F.percentile_approx(_number(c), shares, 1000).alias(f"c{i}") for i, c in enumerate(used)]).alias("cuts")).scalar()

    def place(i: int, name: str) -> Column:
        below = F.size(F.filter(F.col(f"_cuts.c{i}"), lambda cut: cut < F.col(name)))
        return F.when(_number(name).isNull(), F.lit(0)).otherwise(below).cast("string")

    located = candidates.withColumn("_cuts", cuts)
    return located.withColumn("_cell", F.concat_ws("-", *[place(i, c) for i, c in enumerate(used)])).drop("_cuts")


def _number(name: str) -> Column:
    """An objective, with NaN as null."""
    return F.when(~F.isnan(name), F.col(name))


def pareto_front(df: DataFrame, id_col: str, columns: Sequence[str]) -> DataFrame:
    """Rows no other row dominates; ids are unique, and a null objective (or NaN) is worse than any number.

    Rows dominated inside their own batch are dropped first, and again after mixing the batches for
    as long as that at least halves the candidates. The rest is dealt to grid cells, of which whole ones
    go by their corners; cells that may dominate each other meet in bounded chunks, each pair in its own
    task, which reports the ids that lose. No task holds all candidates, however long the front is.
    """
    names = list(columns)
    rows = df.select(id_col, *[F.col(c).cast("double").alias(c) for c in names])

    def values(rows: pd.DataFrame) -> np.ndarray:
        return order_keys(rows[names].to_numpy(dtype=np.float64, na_value=np.nan))

    def local_front(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.iloc[_front(values(batch))]

    candidates = save_point(rows.mapInPandas(local_front, rows.schema))
    size = candidates.count()
    while size > CANDIDATES_PER_CHUNK:
        mixed = candidates.repartition(-(-size // CANDIDATES_PER_CHUNK))
        candidates = save_point(mixed.mapInPandas(local_front, rows.schema))
        before, size = size, candidates.count()
        if size > before / 2:
            break
    if size <= CANDIDATES_PER_CHUNK:
        def whole_front(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = list(batches)
            yield from local_front([pd.concat(held)] if held else [])

        return candidates.repartition(1).mapInPandas(whole_front, rows.schema)

    gridded = save_point(_gridded(candidates, names))
    corners = gridded.groupBy("_cell").agg(
        F.count("*").alias("size"),
        *[side(F.struct(_number(c).isNotNull(), _number(c).alias("v")))["v"].alias(f"{name}{i}")
          for i, c in enumerate(names) for name, side in (("lo", F.min), ("hi", F.max))]).toPandas()  # at most MOST_CELLS rows
    lower, upper = (order_keys(corners[[f"{side}{i}" for i in range(len(names))]].to_numpy(dtype=np.float64, na_value=np.nan))
                    for side in ("lo", "hi"))
    chunks = -(-corners["size"].to_numpy() // CANDIDATES_PER_CHUNK)
    pairs = [(corners["_cell"][a], corners["_cell"][b], int(chunks[a]), int(chunks[b])) for a, b in meeting_cells(lower, upper)]
    schema = "_cell string, _rival string, _chunks int, _rival_chunks int"
    meetings = F.broadcast(df.sparkSession.createDataFrame(pairs, schema))  # at most MOST_CELLS squared short rows

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    def chunk(count: str) -> Column:
        return F.pmod(F.xxhash64(id_col), F.col(count)).cast("int")

    points = (gridded.join(meetings, "_cell")
              .select(*rows.columns, "_cell", "_rival", chunk("_chunks").alias("_mine"), every("_rival_chunks").alias("_theirs")))
    rivals = (gridded.withColumnRenamed("_cell", "_rival").join(meetings, "_rival")
              .select(*[F.col(c).alias(c) for c in rows.columns], F.col("_cell").alias("_cell"), F.col("_rival").alias("_rival"),
                      chunk("_rival_chunks").alias("_theirs"), every("_chunks").alias("_mine")))

    def losers(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        return mine.loc[_dominated(values(mine), values(theirs)), [id_col]]

    keys = ["_cell", "_rival", "_mine", "_theirs"]
    beaten = points.groupBy(*keys).cogroup(rivals.groupBy(*keys)).applyInPandas(
        losers, rows.select(id_col).schema
    )
    kept = gridded.join(F.broadcast(meetings.select("_cell").distinct()), "_cell", "left_semi")
    return kept.join(beaten.distinct(), id_col, "left_anti").select(*rows.columns)
