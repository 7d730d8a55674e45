"""Counts, shares, coverage and distribution summaries. All of them combine on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.functions import safe_ratio
from labelloom.operators.joins import ids_of


def count_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Group sizes, largest first, ties by key."""
    return df.groupBy(*keys).agg(F.count("*").alias("count")).orderBy(F.desc("count"), *keys)


def complete_views(files: DataFrame, required: Sequence[str]) -> DataFrame:
    """Case ids that have every required view. One flag per view keeps the state of a case fixed-size."""
    flags = [F.max((F.col("view") == v).cast("int")).alias(f"_v{i}") for i, v in enumerate(required)]
    seen = files.filter(F.col("view").isin(list(required))).groupBy("case_id").agg(*flags)
    return seen.filter(" and ".join(f"_v{i} = 1" for i in range(len(required)))).select("case_id")


def view_counts(files: DataFrame) -> DataFrame:
    """Number of distinct views per case."""
    return files.groupBy("case_id").agg(F.count_distinct("view").alias("n_views"))


def coverage(ids: DataFrame, available: DataFrame, key: str) -> DataFrame:
    """How many of the distinct ids are available: counts and ratio in one row."""
    wanted = ids_of(ids, key)
    have = ids_of(available, key).withColumn("_have", F.lit(1))
    flagged = wanted.join(have, key, "left")
    total, found = F.count("*"), F.count("_have")
    return flagged.agg(
        found.alias("available"), (total - found).alias("not_available"), safe_ratio(found, total).alias("ratio")
    )


def coverage_sum(df: DataFrame, value: str, kept: Column) -> DataFrame:
    """Share of a value and of the rows that a filter keeps, and the share of null values."""
    inside = F.coalesce(kept, F.lit(False))
    return df.agg(
        safe_ratio(F.sum(F.when(inside, F.col(value))), F.sum(value)).alias("value_share"),
        F.avg(F.col(value).isNull().cast("double")).alias("null_share"),
        F.sum(inside.cast("long")).alias("used"),
        F.sum((~inside).cast("long")).alias("removed"),
    )


def first_value_per(df: DataFrame, keys: Sequence[str], values: Sequence[str], order: str) -> DataFrame:
    """First non-null value per group and column, by `order`."""
    firsts = [F.min_by(v, F.when(F.col(v).isNotNull(), F.col(order))).alias(v) for v in values]
    return df.groupBy(*keys).agg(*firsts)


def mode_per(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Most frequent value per group; of equally frequent ones the largest."""
    sizes = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return sizes.groupBy(*keys).agg(F.max_by(value, F.struct("_n", value)).alias("mode"))


def macro(metrics: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and worst value over parts of each metric; parts without a value are skipped."""
    means = [F.avg(c).alias(f"avg_{c}") for c in columns]
    worst = [F.min(c).alias(f"min_{c}") for c in columns]
    return metrics.agg(*means, *worst)


def correlations(metrics: DataFrame, columns: Sequence[str], against: str) -> DataFrame:
    """Pearson correlation of each metric with one other column."""
    return metrics.agg(*[F.corr(c, against).alias(f"corr_{c}") for c in columns])


def histogram(df: DataFrame, column: str, bins: int, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Rows per equal-width bin of [low, high]; the top edge belongs to the last bin."""
    scaled = F.floor((F.col(column) - low) / (high - low) * bins)
    inside = df.filter(F.col(column).between(low, high))
    return inside.groupBy(F.least(scaled, F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("count"))


def label_balance(df: DataFrame, parts: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Positives and positive share of every 0/1 column, optionally per view or fold."""
    sums = [F.sum(p).alias(p) for p in parts]
    tallied = df.groupBy(*by).agg(F.count("*").alias("rows"), *sums)
    long = tallied.unpivot([*by, "rows"], list(parts), "part", "positives")
    return long.withColumn("ratio", safe_ratio(F.col("positives"), F.col("rows")))
