"""Samples, splits, folds, balancing and weights.

Every random choice follows the md5 order of (id, seed), so it is reproducible, survives retries,
and spreads any group, however large, over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.functions import label_key, safe_ratio
from labelloom.operators.joins import ids_of
from labelloom.operators.ranking import dedup, keep_top_groups, shuffled
from labelloom.session import small_side


def sample_n(df: DataFrame, id_col: str, n: int, seed: int) -> DataFrame:
    """n rows in shuffle order."""
    return shuffled(df, [], id_col, seed, upto=n).drop("rank", "group_size")


def sample_n_per(df: DataFrame, keys: Sequence[str], id_col: str, n: int, seed: int) -> DataFrame:
    """Up to n random rows of every group."""
    return shuffled(df, keys, id_col, seed, upto=n).drop("rank", "group_size")


def sample_frac_per(df: DataFrame, keys: Sequence[str], id_col: str, frac: float, seed: int) -> DataFrame:
    """The same fraction of every group, its size rounded half to even."""
    ranked = shuffled(df, keys, id_col, seed)
    quota = F.bround(F.lit(frac) * F.col("group_size"), 0)
    return ranked.filter(F.col("rank") <= quota).drop("rank", "group_size")


def balance_down(df: DataFrame, label: str, id_col: str, seed: int) -> DataFrame:
    """Every class cut to the size of the smallest."""
    smallest = df.groupBy(label).agg(F.count("*").alias("n")).agg(F.min("n").alias("n")).scalar()
    ranked = shuffled(df, [label], id_col, seed)
    return ranked.filter(F.col("rank") <= smallest).drop("rank", "group_size")


def sample_ids_topped(df: DataFrame, id_col: str, n: int, seed: int) -> DataFrame:
    """n distinct ids, or all of them when there are fewer."""
    return sample_n(df.select(id_col).distinct(), id_col, n, seed)


def balance_pool(labels: DataFrame, parts: Sequence[str], n: int, seed: int) -> DataFrame:
    """Ids of up to n positives of each named part, united; `labels` is (case_id, part, gt)."""
    positives = labels.filter(F.col("part").isin(list(parts)) & (F.col("gt") == 1))
    return sample_n_per(positives, ["part"], "case_id", n, seed).select("case_id").distinct()


def split_stratified(df: DataFrame, label: str, id_col: str, frac: float, seed: int) -> DataFrame:
    """Column `split`: `test` for the given fraction of every class, else `train`."""
    ranked = shuffled(df, [label], id_col, seed)
    in_test = F.col("rank") <= F.bround(F.lit(frac) * F.col("group_size"), 0)
    return ranked.withColumn("split", F.when(in_test, "test").otherwise("train")).drop("rank", "group_size")


def kfold(df: DataFrame, k: int, id_col: str, seed: int, strata: Sequence[str] = ()) -> DataFrame:
    """Column `fold` in 0..k-1; fold sizes differ by at most one inside every stratum."""
    ranked = shuffled(df, list(strata), id_col, seed)
    return ranked.withColumn("fold", ((F.col("rank") - 1) % k).cast("int")).drop("rank", "group_size")


def _column_sums(df: DataFrame, columns: Sequence[str]) -> Column:
    """Row count `n` and the sum of every column as one scalar struct."""
    totals = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns]
    return df.agg(F.struct(F.count("*").alias("n"), *totals).alias("totals")).scalar()


def combination_strata(df: DataFrame, parts: Sequence[str], k: int) -> DataFrame:
    """Column `stratum`: the label combination, or for one seen fewer than k times its rarest label.

    Of equally rare labels the first in column order counts. A rare row without labels is `rare:`.
    """
    combos = df.groupBy(label_key(parts).alias("_combo")).agg(F.count("*").alias("_combo_rows"))
    totals = df.withColumn("_totals", _column_sums(df, parts)).withColumn("_combo", label_key(parts))
    ranked = F.array(*[
        F.when(F.col(p) == 1, F.struct(F.col(f"_totals.{p}").alias("n"), F.lit(i).alias("i"), F.lit(p).alias("part")))
        for i, p in enumerate(parts)
    ])
    rarest = F.concat(F.lit("rare:"), F.coalesce(F.array_min(F.array_compact(ranked))["part"], F.lit("")))
    joined = totals.join(small_side(combos), "_combo")
    stratum = F.when(F.col("_combo_rows") >= k, F.col("_combo")).otherwise(rarest)
    return joined.select(*df.columns, stratum.alias("stratum"))


def kfold_multilabel(df: DataFrame, parts: Sequence[str], k: int, id_col: str, seed: int) -> DataFrame:
    """Folds balanced over label combinations; rare combinations are balanced by their rarest label."""
    return kfold(combination_strata(df, parts, k), k, id_col, seed, ["stratum"]).drop("stratum")


def label_combos(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows per label combination."""
    return df.groupBy(label_key(parts).alias("combo")).agg(F.count("*").alias("rows"))


def drop_rare_combos(df: DataFrame, parts: Sequence[str], min_rows: int = 10) -> DataFrame:
    """Rows whose label combination is seen more than `min_rows` times."""
    common = label_combos(df, parts).filter(F.col("rows") > min_rows).select("combo")
    return df.withColumn("combo", label_key(parts)).join(small_side(common), "combo", "left_semi").drop("combo")


def oversample(df: DataFrame, parts: Sequence[str], min_ratio: float = 0.2, copies: int = 2) -> DataFrame:
    """Repeat the positives of scarce parts.

    A part is scarce when its positive share is below `min_ratio`. Each scarce part adds `copies`
    copies of its positive rows of the *input*, so the repeats add up and do not multiply.
    """
    totals = F.col("_totals")
    extra = F.lit(0)
    for p in parts:
        scarce = totals[p] / totals["n"] < min_ratio
        extra = extra + F.when(scarce & (F.col(p) == 1), copies).otherwise(0)
    counted = df.withColumn("_totals", _column_sums(df, parts))
    repeated = counted.withColumn("_copy", F.explode(F.sequence(F.lit(0), extra)))
    return repeated.drop("_totals").withColumnRenamed("_copy", "copy")


def holdout(df: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rest, held out) by a fixed list of ids."""
    listed = ids_of(ids, key)
    return df.join(listed, key, "left_anti"), df.join(listed, key, "left_semi")


def split_eval_train(
    df: DataFrame,
    id_col: str,
    case_col: str,
    group: str,
    eval_rows: int,
    per_group: int,
    train_rows: int,
    seed: int,
) -> tuple[DataFrame, DataFrame]:
    """(train, eval): random eval rows, and train rows of other cases, capped per group and in total."""
    evaluation = sample_n(df, id_col, eval_rows, seed)
    others = df.join(ids_of(evaluation, case_col), case_col, "left_anti")
    train = sample_n(sample_n_per(others, [group], id_col, per_group, seed), id_col, train_rows, seed)
    return train, dedup(evaluation, [id_col], [F.col(case_col)])


def sample_common_models(
    df: DataFrame, label: str, model: str, id_col: str, top_models: int, per_cell: int, seed: int
) -> DataFrame:
    """Up to `per_cell` random rows per (label, model) among the most frequent models."""
    return sample_n_per(keep_top_groups(df, model, top_models), [label, model], id_col, per_cell, seed)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Weight per class: rows / (classes * rows of the class)."""
    sizes = df.groupBy(label).agg(F.count("*").alias("count"))
    overall = sizes.agg(F.struct(F.sum("count").alias("n"), F.count("*").alias("k")).alias("all")).scalar()
    weighted = sizes.withColumn("_all", overall)
    weight = safe_ratio(F.col("_all.n"), F.col("_all.k") * F.col("count"))
    return weighted.select(label, "count", weight.alias("weight"))


def with_class_weights(df: DataFrame, label: str) -> DataFrame:
    """Rows with the weight of their class; a null label is a class too."""
    weights = small_side(class_weights(df, label).select(F.col(label).alias("_class"), "weight"))
    return df.join(weights, F.col(label).eqNullSafe(F.col("_class"))).drop("_class")


def pos_weights(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Weight of the positives per part: negatives / positives, 1 where the part has no negatives.

    A part without positives has no weight.
    """
    sums = df.agg(F.count("*").alias("n"), *[F.sum(p).alias(p) for p in parts])
    long = sums.unpivot("n", list(parts), "part", "pos")
    negatives = F.col("n") - F.col("pos")
    weight = F.when(negatives == 0, F.lit(1.0)).otherwise(safe_ratio(negatives, F.col("pos")))
    return long.select("part", weight.alias("pos_weight"))


def id_batches(df: DataFrame, id_col: str, size: int, seed: int) -> DataFrame:
    """Fixed-size work batches: column `batch_id`, every batch but the last of `size` distinct ids."""
    ranked = shuffled(df.select(id_col).distinct(), [], id_col, seed)
    return ranked.select(id_col, F.floor((F.col("rank") - 1) / size).alias("batch_id"))


def all_disjoint(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Ids that occur in more than one of the frames; empty when the splits are disjoint."""
    tagged = [ids_of(f, key) for f in frames]
    together = reduce(DataFrame.unionByName, tagged)
    return together.groupBy(key).agg(F.count("*").alias("frames")).filter("frames > 1")
