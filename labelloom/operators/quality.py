"""Label quality: confident learning, area under the margin, out-of-distribution, corrections.

Definitions follow the published papers (confident learning: Northcutt, Jiang, Chuang 2021; AUM:
Pleiss et al. 2020; BALD: Houlsby et al. 2011). A multi-label table is treated as one binary task
per part: `gt` is the given label and `conf` the predicted probability of a positive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from labelloom.functions import bald_terms, entropy, margin, safe_ratio
from labelloom.operators.joins import for_parts, ids_of
from labelloom.operators.ranking import quantile_value, range_bucketed, running, top_n_per
from labelloom.operators.sampling import sample_n_per
from labelloom.session import save_point, small_side


def confident_thresholds(preds: DataFrame) -> DataFrame:
    """Per part, the mean probability of a class over the rows given that class (`t0`, `t1`)."""
    positive, negative = F.col("gt") == 1, F.col("gt") == 0
    return preds.groupBy("part").agg(
        F.avg(F.when(negative, 1 - F.col("conf"))).alias("t0"), F.avg(F.when(positive, F.col("conf"))).alias("t1")
    )


def confident_class(p1: Column, t0: Column, t1: Column) -> Column:
    """Most probable class among those at or above their threshold; null when neither is."""
    p0 = 1 - p1
    sure0 = F.coalesce(p0 >= t0, F.lit(False))
    sure1 = F.coalesce(p1 >= t1, F.lit(False))
    return (
        F.when(sure0 & sure1, F.when(p1 > p0, 1).otherwise(0))
        .when(sure1, 1)
        .when(sure0, 0)
        .cast("int")
    )


def find_label_issues(preds: DataFrame, parts: Sequence[str] | None = None) -> DataFrame:
    """Every (case, part) with its confident class, issue flag and self-confidence.

    The thresholds are one row per part and are broadcast (without a vocabulary, after a check of
    their number), so the predictions are read twice and never shuffled on the part.
    """
    scoped = preds if parts is None else preds.filter(F.col("part").isin(list(parts)))
    joined = scoped.join(for_parts(confident_thresholds(scoped), parts), "part")
    guess = confident_class(F.col("conf"), F.col("t0"), F.col("t1"))
    given = F.when(F.col("gt") == 1, F.col("conf")).otherwise(1 - F.col("conf"))
    return joined.select(
        *preds.columns,
        guess.alias("confident"),
        F.coalesce((guess != F.col("gt")).cast("int"), F.lit(0)).alias("is_issue"),
        given.alias("self_confidence"),
    )


def case_issues(issues: DataFrame) -> DataFrame:
    """Per case: flagged if any part is, with the worst self-confidence over its parts."""
    return issues.groupBy("case_id").agg(
        F.max("is_issue").alias("is_issue"), F.min("self_confidence").alias("quality")
    )


def rank_issues(issues: DataFrame, top_n: int) -> DataFrame:
    """The `top_n` worst flagged cases, worst first; at most `top_n` rows meet in the last task."""
    worst = [F.col("quality"), F.col("case_id")]
    flagged = case_issues(issues).filter("is_issue = 1").orderBy(*worst).limit(top_n)
    return flagged.select("case_id", "quality", F.row_number().over(W.orderBy(*worst)).alias("rank"))


def issue_coverage(issues: DataFrame) -> DataFrame:
    """Number and share of flagged cases."""
    return case_issues(issues).agg(
        F.count("*").alias("cases"),
        F.sum("is_issue").alias("issues"),
        safe_ratio(F.sum("is_issue"), F.count("*")).alias("coverage"),
    )


def class_thresholds(df: DataFrame, probs: str, label: str, by: Sequence[str], n_classes: int) -> DataFrame:
    """Per group, an array of the mean probability of class j over rows labelled j (null: none)."""
    means = [F.avg(F.when(F.col(label) == j, F.get(probs, F.lit(j)))) for j in range(n_classes)]
    return df.groupBy(*by).agg(F.array(*means).alias("thresholds"))


def _with_thresholds(df: DataFrame, probs: str, label: str, by: Sequence[str], n_classes: int) -> DataFrame:
    thresholds = class_thresholds(df, probs, label, by, n_classes)
    if by:
        return df.join(small_side(thresholds), list(by))
    return df.withColumn("thresholds", thresholds.scalar())


def class_issues(df: DataFrame, probs: str, label: str, n_classes: int, by: Sequence[str] = ()) -> DataFrame:
    """Multi-class form of `find_label_issues`: adds `confident` and `is_issue`."""
    given = _with_thresholds(df, probs, label, by, n_classes)
    sure = F.zip_with(probs, "thresholds", lambda p, t: F.when(p >= t, p))
    best = F.array_max(sure)
    guess = F.when(best.isNotNull(), F.array_position(sure, best) - 1).cast("int")
    flagged = given.withColumn("confident", guess).drop("thresholds")
    return flagged.withColumn("is_issue", F.coalesce((F.col("confident") != F.col(label)).cast("int"), F.lit(0)))


def class_health(df: DataFrame, probs: str, label: str, n_classes: int, by: Sequence[str] = ()) -> DataFrame:
    """Per class: estimated label issues, inverse issues, noise, inverse noise and quality.

    The counts of (given, confident) class are scaled so that each given class keeps its number of
    rows; at least one correct row per class is assumed.
    """
    by = list(by)
    issues = class_issues(df, probs, label, n_classes, by)
    given, guess = F.col(label).alias("given"), F.col("confident").alias("guess")
    tallies = issues.groupBy(*by, given, guess).agg(F.count("*").alias("n"))
    counts = F.array(*[
        F.greatest(
            F.sum(F.when(F.col("guess") == j, F.col("n")).otherwise(0)),
            F.max((F.col("given") == j).cast("long")),
        )
        for j in range(n_classes)
    ])
    per_class = tallies.groupBy(*by, "given").agg(F.sum("n").alias("rows"), counts.alias("counts"))
    sure = F.aggregate("counts", F.lit(0).cast("long"), lambda acc, x: acc + x)
    scaled = per_class.withColumn("scale", F.col("rows") / sure)
    cells = scaled.select(*by, "given", "rows", "scale", F.posexplode("counts").alias("guess", "n"))
    joint = cells.select(*by, "given", "guess", (F.col("n") * F.col("scale")).alias("mass"))
    off = F.when(F.col("given") != F.col("guess"), F.col("mass")).otherwise(F.lit(0.0))
    sides = joint.withColumn("off", off)
    row_side = sides.groupBy(*by, F.col("given").alias("class")).agg(
        F.sum("mass").alias("given_rows"), F.sum("off").alias("off_given")
    )
    column_side = sides.groupBy(*by, F.col("guess").alias("class")).agg(
        F.sum("mass").alias("true_rows"), F.sum("off").alias("off_true")
    )

    def whole(mass: str) -> Column:
        # Half to even, after dropping float noise that could hide a half.
        return F.bround(F.round(mass, 6), 0).cast("long")

    noise = safe_ratio(F.col("off_given"), F.col("given_rows"))
    return row_side.join(column_side, [*by, "class"]).select(
        *by,
        "class",
        whole("off_given").alias("label_issues"),
        whole("off_true").alias("inverse_issues"),
        noise.alias("label_noise"),
        safe_ratio(F.col("off_true"), F.col("true_rows")).alias("inverse_noise"),
        (1 - noise).alias("quality"),
    )


def compare_health(before: DataFrame, after: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Class health before and after cleaning side by side, with the gain in quality."""
    keys = [*by, "class"]
    left = before.select(*keys, F.col("quality").alias("quality_before"), F.col("label_issues").alias("issues_before"))
    right = after.select(*keys, F.col("quality").alias("quality_after"), F.col("label_issues").alias("issues_after"))
    gain = F.col("quality_after") - F.col("quality_before")
    return left.join(right, keys, "full").withColumn("gain", gain)


def ood_score(df: DataFrame, probs: str, label: str, n_classes: int) -> DataFrame:
    """Typicality 1 - normalised entropy of the threshold-adjusted probabilities; low is atypical.

    Each probability is shifted by its class threshold and the largest threshold, and renormalised.
    A class without given rows keeps its probability (threshold 0).
    """
    given = _with_thresholds(df, probs, label, (), n_classes)
    limits = F.transform("thresholds", lambda t: F.coalesce(t, F.lit(0.0)))
    shifts = F.zip_with(limits, F.array_repeat(F.array_max(limits), n_classes), lambda t, top: top - t)
    raised = F.zip_with(probs, shifts, lambda p, s: p + s)
    total = F.aggregate(raised, F.lit(0.0), lambda acc, x: acc + x)
    adjusted = F.zip_with(raised, F.array_repeat(total, n_classes), lambda x, t: x / t)
    score = 1 - entropy(adjusted) / F.log(F.lit(float(n_classes)))
    return given.withColumn("ood_score", score).drop("thresholds")


def aum(epochs: DataFrame, sample: str = "sample_id", label: str = "label", logits: str = "logits") -> DataFrame:
    """Area under the margin: mean over epochs of given-label logit minus the largest other logit."""
    return epochs.groupBy(sample).agg(F.avg(margin(F.col(logits), F.col(label))).alias("aum"))


def select_clean(
    df: DataFrame,
    aum_values: DataFrame,
    key: str,
    lo: float | None = 0.6,
    hi: float | None = None,
    ood: float | None = None,
) -> DataFrame:
    """Rows with an AUM at or above its `lo` quantile.

    Optional further bounds: at most the `hi` quantile, and at least the `ood` quantile of
    `ood_score`. Rows without an AUM are left out; they still count in the OOD quantile. The joined
    table is saved, because each bound reads it again and must see the same scores.
    """
    attached = save_point(df.join(aum_values, key, "left"))
    known = attached.filter(F.col("aum").isNotNull())
    kept = known
    if lo is not None:
        kept = kept.filter(F.col("aum") >= quantile_value(known, "aum", lo))
    if hi is not None:
        kept = kept.filter(F.col("aum") <= quantile_value(known, "aum", hi))
    if ood is not None:
        kept = kept.filter(F.col("ood_score") >= quantile_value(attached, "ood_score", ood))
    return kept


def selection_report(known: DataFrame, selected: DataFrame, label: str) -> DataFrame:
    """Rows and share kept per class."""
    total = known.groupBy(label).agg(F.count("*").alias("rows"))
    kept = selected.groupBy(label).agg(F.count("*").alias("kept"))
    joined = total.join(kept, label, "left").na.fill(0, ["kept"])
    return joined.withColumn("share", safe_ratio(F.col("kept"), F.col("rows")))


def cap_per_class(df: DataFrame, label: str, id_col: str, n: int, seed: int) -> DataFrame:
    """At most n random rows per class."""
    return sample_n_per(df, [label], id_col, n, seed)


def suspicious_cases(
    preds: DataFrame,
    issues: DataFrame,
    targets: Sequence[str],
    exclude: Sequence[str] = (),
    min_given: int = 3,
    max_predicted: int = 1,
    mirror: bool = False,
) -> DataFrame:
    """Flagged cases with many given positives but few predicted ones (`mirror`: the reverse).

    Given positives count over all parts except the excluded; predicted ones (conf > 0.5) over the
    target parts only. `preds` has one row per (case, part).
    """
    excluded = F.col("part").isin(list(exclude)) if exclude else F.lit(False)
    given = F.sum(F.when(~excluded, F.col("gt")).otherwise(0))
    predicted = F.sum(F.when(F.col("part").isin(list(targets)) & (F.col("conf") > 0.5), 1).otherwise(0))
    counted = preds.groupBy("case_id").agg(given.alias("given"), predicted.alias("predicted"))
    if mirror:
        chosen = counted.filter((F.col("given") <= max_predicted) & (F.col("predicted") >= min_given))
    else:
        chosen = counted.filter((F.col("given") >= min_given) & (F.col("predicted") <= max_predicted))
    flagged = issues.filter("is_issue = 1").select("case_id")
    return chosen.join(flagged, "case_id", "left_semi").select("case_id")


def correct_labels(labels: DataFrame, cases: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Set the target parts of the listed cases to 0; `labels` is (case_id, part, gt, ...)."""
    listed = cases.select("case_id").distinct().withColumn("_listed", F.lit(True))
    joined = labels.join(listed, "case_id", "left")
    hit = F.col("_listed") & F.col("part").isin(list(targets))
    return joined.select(*[F.when(hit, 0).otherwise(F.col("gt")).alias("gt") if c == "gt" else F.col(c)
                           for c in labels.columns])


def correction_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Positives and negatives per part before and after a correction."""
    def tally(df: DataFrame, suffix: str) -> DataFrame:
        return df.groupBy("part").agg(
            F.sum("gt").alias(f"pos_{suffix}"), F.sum(1 - F.col("gt")).alias(f"neg_{suffix}")
        )
    return tally(before, "before").join(tally(after, "after"), "part")


def worst_half(issues: DataFrame) -> DataFrame:
    """The worse half of the flagged cases by quality, rounded down; equal qualities by case id.

    Only the distinct qualities are put in order, with their numbers of cases, however many cases share
    one. Ids are ordered inside the one quality that the cut falls into.
    """
    flagged = save_point(case_issues(issues).filter("is_issue = 1").select("case_id", "quality"))
    half = flagged.agg(F.floor(F.count("*") / 2).alias("n")).scalar()
    sizes = save_point(flagged.groupBy("quality").agg(F.count("*").alias("n")))
    ordered = running(range_bucketed(sizes, "quality"), [], F.col("_range"), [F.col("quality")], value="n")
    placed = save_point(ordered.select("quality", (F.col("running_sum") - F.col("n")).alias("before"), F.col("running_sum").alias("upto")))
    whole = placed.filter(F.col("upto") <= half).agg(F.max("quality").alias("q")).scalar()
    cut = placed.filter((F.col("before") < half) & (F.col("upto") > half))
    tied = save_point(flagged.filter(F.col("quality") == cut.agg(F.max("quality").alias("q")).scalar()))
    ranked = running(range_bucketed(tied, "case_id"), [], F.col("_range"), [F.col("case_id")])
    room = half - cut.agg(F.max("before").alias("b")).scalar()
    return (flagged.filter(F.col("quality") <= whole).select("case_id")
            .unionByName(ranked.filter(F.col("rank") <= room).select("case_id")))


def correct_guarded(
    labels: DataFrame, cases: DataFrame, parts: Sequence[str] | None = None, min_pos: float = 0.1
) -> DataFrame:
    """Like `correct_labels`, but a part keeps its labels if too few positives would remain.

    The share is positives outside the listed cases over all rows of the part. Labels of parts that
    are not named come back as they are; without names every part is a target.
    """
    listed = cases.select("case_id").distinct().withColumn("_listed", F.lit(1))
    joined = labels.join(listed, "case_id", "left")
    marked = joined.withColumn("_listed", F.coalesce("_listed", F.lit(0)))
    left_over = F.sum(F.when((F.col("_listed") == 0) & (F.col("gt") == 1), 1).otherwise(0))
    shares = marked.groupBy("part").agg((safe_ratio(left_over, F.count("*")) >= min_pos).alias("_apply"))
    joined_back = marked.join(for_parts(shares, parts), "part", "left")
    fixed = F.when((F.col("_listed") == 1) & F.coalesce("_apply", F.lit(False)), 0).otherwise(F.col("gt"))
    return joined_back.select(*[fixed.alias("gt") if c == "gt" else F.col(c) for c in labels.columns])


def noisy_cases(top_issues: Sequence[DataFrame], protect: DataFrame) -> DataFrame:
    """Distinct cases of several issue lists, except the protected ones."""
    united = top_issues[0].select("case_id")
    for other in top_issues[1:]:
        united = united.unionByName(other.select("case_id"))
    return united.distinct().join(ids_of(protect, "case_id"), "case_id", "left_anti")


def bald(draws: DataFrame, sample: str, probs: str, n_classes: int) -> DataFrame:
    """Mutual information between prediction and model, from repeated stochastic predictions."""
    means = F.array(*[F.avg(F.get(probs, F.lit(j))) for j in range(n_classes)])
    folded = draws.groupBy(sample).agg(means.alias("_mean"), F.avg(entropy(F.col(probs))).alias("_entropy"))
    return folded.select(sample, bald_terms(F.col("_mean"), F.col("_entropy")).alias("bald"))


def most_uncertain(scores: DataFrame, sample: str, k: int) -> DataFrame:
    """The k samples worth labelling next."""
    return scores.orderBy(F.desc("bald"), sample).limit(k)


def first_batch(df: DataFrame, n: int = 200) -> DataFrame:
    """The n highest AUM values per view and label."""
    return top_n_per(df, ["view", "gt"], [F.desc("aum"), F.col("sample_id")], n)
