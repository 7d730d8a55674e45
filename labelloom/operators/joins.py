"""Joins that replace id lists, frame-by-frame merges and per-row lookups."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.session import BROADCAST_ROWS, small_side


def vocabulary(df: DataFrame, column: str, max_terms: int = 1000) -> list[str]:
    """The distinct values of a label column, sorted; they become the columns of wide tables.

    A vocabulary past `max_terms` is an error: keep such data in long form, whose operators take no
    vocabulary. At most `max_terms + 1` short strings reach the driver.
    """
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().limit(max_terms + 1).collect()
    if len(rows) > max_terms:
        raise ValueError(f"more than {max_terms} distinct values in {column}")
    return sorted(r[0] for r in rows)


def ids_of(df: DataFrame, key: str) -> DataFrame:
    """Distinct ids of a table, for the far side of a semi or anti join.

    Repeats collapse before the shuffle, so an id that holds much of the table arrives once per task.
    """
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def for_parts(df: DataFrame, parts: Sequence[str] | None) -> DataFrame:
    """A table with one row per part, ready to join to rows of those parts.

    A given vocabulary bounds it, so it is broadcast; without one its size is checked first.
    """
    if parts is None:
        return small_side(df)
    kept = df.filter(F.col("part").isin(list(parts)))
    return F.broadcast(kept) if len(parts) <= BROADCAST_ROWS else kept


def work_list(wanted: DataFrame, *done: DataFrame, key: str) -> DataFrame:
    """Ids still to process: wanted minus every finished set."""
    return reduce(lambda left, right: left.join(ids_of(right, key), key, "left_anti"), done, ids_of(wanted, key))


def assemble_wide(
    df: DataFrame, keys: Sequence[str], part: str, value: str, parts: Sequence[str], prefix: str = ""
) -> DataFrame:
    """One column per part; keys lacking any part are dropped. One shuffle instead of a join per part.

    Of several values for one cell the smallest counts.
    """
    wide = df.groupBy(*keys).agg(*cells(part, value, parts, F.min, prefix))
    return wide.na.drop(subset=[f"`{prefix}{p}`" for p in parts])


def cells(
    part: str, value: str, parts: Sequence[str], how: Callable[[Column], Column], prefix: str = ""
) -> list[Column]:
    """One aggregate per part: a pivot that keeps one row per key in memory, without a row per key and part before it."""
    return [how(F.when(F.col(part) == p, F.col(value))).alias(f"{prefix}{p}") for p in parts]


def prefer(base: DataFrame, better: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Take `columns` from `better` where it has the key, else from `base`; `replaced` says which.

    Keys are unique in `better`.
    """
    renamed = better.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in columns], F.lit(1).alias("_hit"))
    joined = base.join(renamed, list(keys), "left")
    chosen = [
        F.when(F.col("_hit") == 1, F.col(f"_b_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in base.columns
    ]
    return joined.select(*chosen, F.coalesce("_hit", F.lit(0)).alias("replaced"))


def lookup_or(df: DataFrame, table: DataFrame, keys: Sequence[str], value: str, default: Column) -> DataFrame:
    """Attach `value` from a table, or the default where the table has no such key."""
    joined = df.join(table.select(*keys, value), list(keys), "left")
    return joined.withColumn(value, F.coalesce(F.col(value), default))


def outer_chain(frames: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Full outer join of one-value tables on a key; absent values become 0."""
    chained = reduce(lambda a, b: a.join(b, key, "full"), frames.values())
    return chained.na.fill(0, list(frames))


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by name; a column missing from one frame is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def common_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Ids in both tables."""
    return ids_of(a, key).join(ids_of(b, key), key, "left_semi")


def without_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct ids of the first table that the second lacks."""
    return ids_of(a, key).join(ids_of(b, key), key, "left_anti")
