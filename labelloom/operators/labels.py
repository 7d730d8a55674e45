"""Long and wide multi-label tables, photo labels and prediction assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.functions import safe_ratio
from labelloom.operators.joins import assemble_wide
from labelloom.operators.ranking import first_per


def pivot_mean(df: DataFrame, key: str, part: str, value: str, parts: Sequence[str]) -> DataFrame:
    """Wide table whose cells hold the mean of repeated values; absent cells stay null."""
    return df.groupBy(key).pivot(part, list(parts)).agg(F.avg(value))


def multilabel(
    df: DataFrame, key: str, label: str, parts: Sequence[str], features: Sequence[str] = (), order: str | None = None
) -> DataFrame:
    """0/1 column `vision_<part>` (input) and `<part>` (target) per part, one row per key.

    Case features come from the first row by `order`.
    """
    present = [F.max((F.col(label) == p).cast("int")).alias(p) for p in parts]
    firsts = [F.min_by(f, order).alias(f) for f in features]
    wide = df.groupBy(key).agg(*firsts, *present)
    flags = [F.coalesce(F.col(f"`{p}`"), F.lit(0)) for p in parts]
    return wide.select(
        key,
        *features,
        *[flag.alias(f"vision_{p}") for flag, p in zip(flags, parts)],
        *[flag.alias(p) for flag, p in zip(flags, parts)],
    )


def long_labels(wide: DataFrame, key: str, parts: Sequence[str], prefix: str = "") -> DataFrame:
    """Back to (key, part, gt)."""
    return wide.unpivot(key, [F.col(f"`{prefix}{p}`").alias(p) for p in parts], "part", "gt") if not prefix else (
        wide.select(key, *[F.col(f"`{prefix}{p}`").alias(p) for p in parts]).unpivot(key, list(parts), "part", "gt")
    )


def view_labels(
    labels: DataFrame, mapping: DataFrame, files: DataFrame, order: Sequence[Column]
) -> DataFrame:
    """Labels of every photo: the parts its view can show, for the first photo of each (case, view).

    `labels` is (case_id, part, gt), `mapping` is (view, part) and small, `files` has case_id, view,
    filename. The mapping is attached to the photos as one array per view, so only the join on the
    case moves data.
    """
    first_photo = first_per(files, ["case_id", "view"], order).select("case_id", "view", "filename")
    visible = mapping.groupBy("view").agg(F.collect_set("part").alias("_parts"))
    expected = first_photo.join(visible, "view").select(
        "case_id", "view", "filename", F.explode("_parts").alias("part")
    )
    return expected.join(labels, ["case_id", "part"])


def explode_predictions(df: DataFrame) -> DataFrame:
    """Parallel arrays (parts, pred, conf, gt) of one photo to one row per part."""
    zipped = F.arrays_zip("parts", "pred", "conf", "gt")
    return df.select("file", F.inline(zipped)).withColumnRenamed("parts", "part")


def pred_multilabel(preds: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Predicted 0/1 columns per photo, for photos predicted on every part."""
    return assemble_wide(preds, ["case_id", "view", "filename", "model"], "part", "pred", parts, prefix="vision_")


def part_agreement(preds: DataFrame, by: Sequence[str]) -> DataFrame:
    """Share of predictions that equal the given label, per group."""
    right = (F.col("pred") == F.col("gt")).cast("long")
    return preds.groupBy(*by).agg(F.count("*").alias("rows"), safe_ratio(F.sum(right), F.count("*")).alias("acc"))


def case_study(pred: DataFrame, gt: DataFrame, vision: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Wide predictions and labels to one row per (case, part) with error flags.

    `vision` is (case_id, part, v_pred) and covers some parts; the others get -1. The three tables meet
    as one row per case, so no row per case and part is moved or sorted.
    """
    def cells(wide: DataFrame, name: str) -> DataFrame:
        return wide.select("case_id", F.struct(*[F.col(f"`{p}`").alias(f"_{i}") for i, p in enumerate(parts)]).alias(name))

    seen = vision.groupBy("case_id").agg(F.collect_list(F.struct("part", "v_pred")).alias("_seen"))
    both = cells(pred, "_pred").join(cells(gt, "_gt"), "case_id").join(seen, "case_id", "left")
    long = both.select("case_id", "_seen", F.inline(F.array(*[
        F.struct(F.lit(p).alias("part"), F.col(f"_pred._{i}").alias("pred"), F.col(f"_gt._{i}").alias("gt"))
        for i, p in enumerate(parts)
    ])))
    own = F.filter("_seen", lambda v: v["part"] == F.col("part"))
    joined = long.select("case_id", "part", "pred", "gt", F.explode_outer(own["v_pred"]).alias("v_pred"))
    is_fp = (F.col("gt") == 0) & (F.col("pred") == 1)
    is_fn = (F.col("gt") == 1) & (F.col("pred") == 0)
    return joined.select(
        "case_id",
        "part",
        F.coalesce("v_pred", F.lit(-1)).alias("v_pred"),
        "pred",
        "gt",
        is_fp.cast("int").alias("fp"),
        is_fn.cast("int").alias("fn"),
    )
