"""Data expectations as queries: each returns one row (check, failed_rows)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.operators.joins import common_ids


def _report(check: str, failed: DataFrame) -> DataFrame:
    return failed.agg(F.count("*").alias("failed_rows")).select(F.lit(check).alias("check"), "failed_rows")


def expect_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """No key occurs twice; counts the repeated keys."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1")
    return _report("unique_" + "_".join(keys), repeated)


def expect_disjoint(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """No id is in both tables; counts the shared ids."""
    return _report(f"disjoint_{key}", common_ids(a, b, key))


def expect_that(df: DataFrame, name: str, predicate: Column) -> DataFrame:
    """Every row satisfies the predicate; an unknown outcome fails."""
    return _report(name, df.filter(~F.coalesce(predicate, F.lit(False))))


def expect_min_prob(df: DataFrame, probs: str, floor: float = 0.5) -> DataFrame:
    """The winning class has at least the given probability."""
    return expect_that(df, "min_prob", F.array_max(probs) >= floor)


def expect_rates_sum(metrics: DataFrame) -> DataFrame:
    """Hit and miss rate add up to one wherever they exist."""
    sums = F.col("tpr").isNull() | (F.abs(F.col("tpr") + F.col("fnr") - 1) < 0.01)
    return expect_that(metrics, "tpr_fnr_sum", sums)


def expect_equal_lengths(df: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """All array columns of a row have the same length."""
    same = F.lit(True)
    for name in arrays[1:]:
        same = same & (F.size(name) == F.size(arrays[0]))
    return expect_that(df, "equal_lengths", same)


def expect_same_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both tables have exactly the same rows of keys, each once."""
    tagged = a.select(*keys, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*keys, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    sides = tagged.groupBy(*keys).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    return _report("same_keys", sides.filter("_a <> 1 or _b <> 1"))
