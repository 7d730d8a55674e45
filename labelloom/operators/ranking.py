"""Ranks, running totals, quantiles and top-n that never sort a whole group in one task.

A plain `row_number().over(partitionBy(key))` sends each key to one task, which fails when one key
holds a third of the rows. `running` splits every key into ordered buckets, numbers the rows bucket
by bucket, and adds the size of the earlier buckets, so the widest task holds one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from labelloom.functions import hash_order
from labelloom.session import save_point

SALTS = 256
RANGE_STEP = 16
# Rows of one range of a whole table, and of one quantile's bracket, which a single task sorts.
BUCKET_ROWS = 1_000_000


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Earliest row per key; each map task forwards at most one row per key."""
    numbered = df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return numbered.filter("_rn = 1").drop("_rn")


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Drop duplicates on `keys`; unlike `dropDuplicates` the survivor is determined by `order`."""
    return first_per(df, keys, order)


def top_n_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First n rows per key, with the rank in `rank`.

    The first pass keeps n rows per key and group of map tasks, so a hot key is sorted in `SALTS`
    tasks and reaches the last one as at most `SALTS * n` rows.
    """
    salted = df.withColumn("_salt", F.spark_partition_id() % SALTS)
    within_salt = F.row_number().over(W.partitionBy(*keys, "_salt").orderBy(*order))
    kept = salted.withColumn("_rn", within_salt).filter(F.col("_rn") <= n).drop("_rn", "_salt")
    ranked = kept.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("rank") <= n)


def keep_top_groups(df: DataFrame, key: str, k: int) -> DataFrame:
    """Rows that belong to the k most frequent values of `key`."""
    top = df.groupBy(key).agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), key).limit(k).select(key)
    return df.join(F.broadcast(top) if k <= 10_000 else top, key, "left_semi")


def hash_bucket(digest: str | Column, digits: int = 3) -> Column:
    """Leading hex digits of a digest: 16^digits ordered buckets of near-equal size."""
    column = F.col(digest) if isinstance(digest, str) else digest
    return F.substring(column, 1, digits)


def range_bucketed(saved: DataFrame, column: str) -> DataFrame:
    """Add `_range`, an order-preserving bucket of a numeric column, of about BUCKET_ROWS rows at most.

    The cut points are approximate quantiles; they only balance the buckets, so results do not depend on
    how good they are. A first level of cuts is read once through a scalar subquery, and a row looks up its
    place in two steps of `RANGE_STEP` comparisons. The row count says into how many parts each of these
    ranges is cut again, by quantiles of its own; repeated values stay together. `saved` is read several times.
    """
    buckets = RANGE_STEP * RANGE_STEP
    shares = [i / buckets for i in range(1, buckets)]
    cuts = saved.select(F.percentile_approx(column, shares, 10_000).alias("fine"))
    every = F.array(*[F.get("fine", F.lit(RANGE_STEP * i - 1)) for i in range(1, RANGE_STEP)])
    both = cuts.select(F.struct("fine", every.alias("coarse")).alias("cuts")).scalar()

    def below(values: Column) -> Column:
        return F.coalesce(F.size(F.filter(values, lambda cut: cut < F.col(column))), F.lit(0))

    coarse = saved.withColumn("_cuts", both).withColumn("_coarse", below(F.col("_cuts.coarse")))
    start = F.col("_coarse") * RANGE_STEP
    fine = below(F.slice(F.col("_cuts.fine"), start + 1, RANGE_STEP - 1))
    ranged = coarse.withColumn("_range", (start + fine).cast("long")).drop("_cuts", "_coarse")
    parts = -(-saved.count() // (buckets * BUCKET_ROWS))
    if parts <= 1:
        return ranged
    own = ranged.groupBy(F.col("_range").alias("_of")).agg(
        F.percentile_approx(column, [i / parts for i in range(1, parts)], 100 * parts).alias("_own"))
    joined = ranged.join(F.broadcast(own), ranged["_range"] == own["_of"])  # one row for each of 256 ranges
    return joined.withColumn("_range", F.col("_range") * parts + below(F.col("_own"))).drop("_of", "_own")


def running(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[Column],
    value: str | None = None,
    upto: int | None = None,
) -> DataFrame:
    """Add `rank` (from 1) and `group_size` per key, and `running_sum` when `value` is given.

    `bucket` must be non-decreasing along `order`, null first. Every row comes back: null keys are a
    group of their own, and null ids or buckets come first. With `upto`, buckets that start beyond that rank are dropped before the sort.
    """
    columns = df.columns
    # Keys and bucket as one struct: structs with nulls inside are equal, so null keys join like others
    # and the window below finds its rows where the join has put them.
    place = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], bucket.alias("bucket"))
    located = df.withColumn("_place", place)
    totals = [F.count("*").alias("_n")]
    if value is not None:
        totals.append(F.sum(value).alias("_sum"))
    sizes = located.groupBy("_place").agg(*totals)
    group = W.partitionBy(*([F.col(f"_place.k{i}") for i in range(len(keys))] or [F.lit(0)]))
    before = group.orderBy("_place.bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_place",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(group).alias("group_size"),
        *([F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum_before")] if value else []),
    )
    joined = located.join(offsets, "_place")
    if upto is not None:
        joined = joined.filter(F.col("_before") < upto)
    local = W.partitionBy("_place").orderBy(*order)
    added = [(F.row_number().over(local) + F.col("_before")).alias("rank"), "group_size"]
    if value is not None:
        so_far = local.rowsBetween(W.unboundedPreceding, W.currentRow)
        added.append((F.coalesce(F.sum(value).over(so_far), F.lit(0)) + F.col("_sum_before")).alias("running_sum"))
    ranked = joined.select(*columns, *added)
    return ranked if upto is None else ranked.filter(F.col("rank") <= upto)


def shuffled(
    df: DataFrame, keys: Sequence[str], id_col: str, seed: int, upto: int | None = None
) -> DataFrame:
    """Number the rows of every key in the reproducible shuffle order of `id_col`."""
    hashed = df.withColumn("_hash", hash_order(id_col, seed))
    return running(hashed, keys, hash_bucket("_hash"), [F.col("_hash"), F.col(id_col)], upto=upto).drop("_hash")


def running_mean(df: DataFrame, order: str, column: str, every: int | None = None) -> DataFrame:
    """Mean of the rows up to and including this one, by a unique numeric `order` column.

    With `every`, only each `every`-th row is reported. The two columns are saved first: three
    passes read them, and all must see the same values.
    """
    rows = save_point(df.select(order, F.col(column).cast("double").alias(column)))
    totals = running(range_bucketed(rows, order), [], F.col("_range"), [F.col(order)], value=column)
    result = totals.select(
        order, "rank", (F.col("running_sum") / F.col("rank")).alias("running_mean")
    )
    return result if every is None else result.filter(F.col("rank") % every == 0)


def _brackets(data: DataFrame, probs: Sequence[float], accuracy: int) -> tuple[int, list[tuple[float | None, float | None]]]:
    """The number of values `_v`, and for each prob two values around its rank with few different ones between them."""
    slack = 3.0 / accuracy
    edges = [min(max(p + side * slack, 0.0), 1.0) for p in probs for side in (-1, 1)]
    n, found = data.agg(F.count("*"), F.percentile_approx("_v", edges, accuracy)).first()
    if not n:
        return 0, [(None, None)] * len(probs)
    brackets = [(found[2 * i], found[2 * i + 1]) for i in range(len(probs))]
    # Edges are off by n / accuracy ranks each, so a bracket spans at most 8 n / accuracy ranks inside its edges.
    bound = 8 * n // accuracy
    while bound > BUCKET_ROWS:
        inside = [F.when((F.col("_v") > lo) & (F.col("_v") < hi), F.col("_v")) for lo, hi in brackets]
        counts = data.agg(*[c for (lo, _), v in zip(brackets, inside, strict=True)
                            for c in (F.count_if(F.col("_v") <= lo), F.count(v))]).first()
        sketches = []
        for i, p in enumerate(probs):
            # Share of the wanted rank among the values strictly inside.
            share = (p * (n - 1) - counts[2 * i]) / max(1, counts[2 * i + 1] - 1)
            around = [min(max(share + side * slack, 0.0), 1.0) for side in (-1, 1)]
            sketches.append(F.percentile_approx(inside[i], around, accuracy))
        narrowed = data.agg(*sketches).first()
        for i, (lo, hi) in enumerate(brackets):
            if not narrowed[i]:
                continue
            # An edge that the sketch had to clip stays where it was.
            share = (probs[i] * (n - 1) - counts[2 * i]) / max(1, counts[2 * i + 1] - 1)
            brackets[i] = (narrowed[i][0] if share - slack > 0 else lo, narrowed[i][1] if share + slack < 1 else hi)
        widest = max(counts[1::2])
        if 8 * widest // accuracy + 2 >= bound:
            break
        bound = 8 * widest // accuracy + 2
    return n, brackets


def exact_quantile(
    df: DataFrame, column: str, probs: Sequence[float], accuracy: int = 10_000
) -> DataFrame:
    """Linear-interpolation quantiles, exact, one row (prob, quantile) per requested prob.

    Mergeable sketches bracket each quantile: one of all values, then fresh ones of the values inside the
    brackets, all quantiles in one pass, until no bracket can hold more than BUCKET_ROWS different values.
    A last pass counts the distinct values inside the brackets and summarises the rows on either side, so
    only a sliver of pre-counted values is ever sorted. A bracket that misses its rank (which the sketch's
    error bound rules out) raises an error. `df` is read in every pass, so pass a saved table if its values
    come from a float aggregate.
    """
    data = df.select(F.col(column).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    n, brackets = _brackets(data, [float(p) for p in probs], accuracy)
    brackets = F.array(*[
        F.struct(F.lit(n).cast("long").alias("n"), F.lit(p).alias("prob"), F.lit(lo).cast("double").alias("lo"),
                 F.lit(hi).cast("double").alias("hi")) for p, (lo, hi) in zip(map(float, probs), brackets, strict=True)])
    side = F.when(F.col("_v") < F.col("lo"), -1).when(F.col("_v") > F.col("hi"), 1).otherwise(0)
    counted = (
        data.select("_v", F.inline(brackets))
        .withColumn("_side", side)
        .groupBy("prob", "n", "_side", F.when(F.col("_side") == 0, F.col("_v")).alias("_inside"))
        .agg(F.count("*").alias("_c"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    )
    walk = W.partitionBy("prob").orderBy("_side", "_inside")
    upto = counted.withColumn("_cum", F.sum("_c").over(walk.rowsBetween(W.unboundedPreceding, W.currentRow)))
    position = F.col("prob") * (F.col("n") - 1)

    def value_at(rank: Column) -> Column:
        # Of the rows outside the bracket only the nearest one on each side is known.
        first = F.col("_cum") - F.col("_c") + 1
        below = F.when((F.col("_side") == -1) & (rank == F.col("_cum")), F.col("_max"))
        above = F.when((F.col("_side") == 1) & (rank == first), F.col("_min"))
        inside = F.when((F.col("_side") == 0) & rank.between(first, F.col("_cum")), F.col("_min"))
        return F.max(F.coalesce(below, inside, above))

    picked = upto.groupBy("prob", "n").agg(
        value_at(F.floor(position) + 1).alias("low"), value_at(F.ceil(position) + 1).alias("high")
    )
    value = F.col("low") + (F.col("high") - F.col("low")) * (position - F.floor(position))
    missed = F.raise_error(F.lit("quantile bracket missed its rank; raise `accuracy`"))
    return picked.select("prob", F.coalesce(value, missed.cast("double")).alias("quantile"))


def quantile_value(df: DataFrame, column: str, prob: float) -> Column:
    """One exact quantile as a scalar subquery, to use inside an expression."""
    return exact_quantile(df, column, [prob]).select("quantile").scalar()
