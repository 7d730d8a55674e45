"""Voting over views and evaluation per case, per part and overall."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from labelloom.functions import flag_gt, safe_ratio
from labelloom.operators.ranking import first_per
from labelloom.session import small_side

TIE_RULES = ("mean_conf", "one", "zero")
BITS_PER_WORD = 62


def _tie(mean_conf: Column, tie: str) -> Column:
    """Outcome of an even vote. The mean is rounded so that summation order cannot flip it."""
    if tie not in TIE_RULES:
        raise ValueError(f"tie must be one of {TIE_RULES}")
    if tie == "mean_conf":
        return (F.round(mean_conf, 9) >= 0.5).cast("int")
    return F.lit(1 if tie == "one" else 0)


def count_votes(preds: DataFrame, tie: str = "mean_conf") -> DataFrame:
    """(case_id, part, gt, pred) of every part with a prediction, by majority of its views."""
    votes = preds.groupBy("case_id", "part").agg(
        F.sum(flag_gt(F.col("conf"), F.col("threshold"))).alias("_pos"),
        F.count("*").alias("_n"),
        F.avg("conf").alias("_conf"),
        F.max("gt").alias("gt"),
    )
    twice = F.col("_pos") * 2
    winner = F.when(twice > F.col("_n"), 1).when(twice < F.col("_n"), 0).otherwise(_tie(F.col("_conf"), tie))
    return votes.select("case_id", "part", "gt", winner.alias("pred"))


def ensemble_vote(
    preds: DataFrame, labels: DataFrame, parts: Sequence[str] | None = None, tie: str = "mean_conf"
) -> DataFrame:
    """(case_id, part, gt, pred) for every part of every case with a label and a prediction.

    Views vote by strict threshold and the majority wins; a part without predictions is 0. The
    votes of a case are folded into bit masks (one row of a few longs per case) before they meet
    the labels, so the predictions are read once and both inputs are shuffled on the case alone.

    `parts` may name the parts that count. Without it all parts that have labels do, however many: they are numbered
    in a table of their own, and a case keeps the words of its mask that hold one of its predictions.
    """
    if parts is None:
        return _vote_on_all(preds, labels, tie)
    names = list(parts)
    wanted = F.col("part").isin(names)
    voted = _with_bit(count_votes(preds.filter(wanted), tie), names)
    words = range(-(-len(names) // BITS_PER_WORD))
    folded = voted.groupBy("case_id").agg(*[
        F.array(*[F.bit_or(F.when((F.col("_word") == w) & is_set, F.col("_mask"))) for w in words]).alias(name)
        for name, is_set in _masks().items()
    ])
    given = _with_bit(labels.filter(wanted).select("case_id", "part", "gt"), names)
    return _outcomes(given.join(folded, "case_id"), lambda name: F.get(name, F.col("_word")))


def _masks() -> dict[str, Column]:
    return {"_seen": F.lit(True), "_pred": F.col("pred") == 1, "_gt": F.col("gt") == 1}


def _vote_on_all(preds: DataFrame, labels: DataFrame, tie: str) -> DataFrame:
    """The vote over all labelled parts; their numbers are joined by a broadcast if the table of parts is small."""
    found = labels.select("part").where(F.col("part").isNotNull()).distinct()
    numbers = small_side(found.select("part", F.monotonically_increasing_id().alias("_at")))
    voted = _masked(count_votes(preds, tie).join(numbers, "part"))
    # Dealt by the case once, which both groupings need.
    per_word = voted.repartition("case_id").groupBy("case_id", "_word").agg(
        *[F.bit_or(F.when(is_set, F.col("_mask"))).alias(name) for name, is_set in _masks().items()])
    folded = per_word.groupBy("case_id").agg(F.map_from_entries(F.collect_list(F.struct("_word", F.struct(*_masks())))).alias("_words"))
    given = _masked(labels.select("case_id", "part", "gt").join(numbers, "part"))
    return _outcomes(given.join(folded, "case_id"), lambda name: F.try_element_at("_words", F.col("_word"))[name])


def _outcomes(joined: DataFrame, word_of: Callable[[str], Column]) -> DataFrame:
    """Label and vote of each row, from the word of each mask that its part stands in."""
    def bit(name: str) -> Column:
        word = F.coalesce(word_of(name), F.lit(0).cast("long"))
        return F.when(word.bitwiseAND(F.col("_mask")) != 0, 1).otherwise(0)

    return joined.select(
        "case_id",
        "part",
        F.when(bit("_seen") == 1, bit("_gt")).otherwise(F.col("gt")).alias("gt"),
        bit("_pred").alias("pred"),
    )


def _masked(placed: DataFrame) -> DataFrame:
    """Word and mask of the part's number `_at`."""
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("_at") % BITS_PER_WORD).cast("int"))
    return placed.withColumn("_word", F.floor(F.col("_at") / BITS_PER_WORD)).withColumn("_mask", mask)


def _with_bit(df: DataFrame, names: list[str]) -> DataFrame:
    """Word and mask of the part's position in the vocabulary."""
    position = F.array_position(F.array(*map(F.lit, names)), F.col("part")) - 1
    return _masked(df.withColumn("_at", position)).withColumn("_word", F.col("_word").cast("int"))


def case_accuracy(decisions: DataFrame, lists: bool = False) -> DataFrame:
    """Share of parts decided correctly per case; `lists` adds the sorted correct and wrong parts."""
    right = F.col("pred") == F.col("gt")
    extra = []
    if lists:
        for name, chosen in (("correct_parts", right), ("wrong_parts", ~right)):
            extra.append(F.array_sort(F.collect_list(F.when(chosen, F.col("part")))).alias(name))
    return decisions.groupBy("case_id").agg(
        F.sum(right.cast("long")).alias("correct"), F.avg(right.cast("double")).alias("case_acc"), *extra
    )


def _confusion(weight: Column | None = None) -> dict[str, Column]:
    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, weight if weight is not None else F.lit(1)).otherwise(0))

    given, said = F.col("gt") == 1, F.col("pred") == 1
    return {
        "tp": total(given & said),
        "tn": total(~given & ~said),
        "fp": total(~given & said),
        "fn": total(given & ~said),
    }


def _f1(precision: Column, recall: Column) -> Column:
    return safe_ratio(2 * precision * recall, precision + recall)


def part_metrics(
    decisions: DataFrame, mode: str = "rate", weight: str | None = None, by: Sequence[str] = ("part",)
) -> DataFrame:
    """Confusion metrics per part.

    `rate`: precision and accuracy are formed from the rates, so accuracy is the balanced one.
    `count`: standard formulas on (optionally weighted) counts. A zero denominator gives null.
    """
    cells = decisions.groupBy(*by).agg(
        *[c.alias(name) for name, c in _confusion(F.col(weight) if weight else None).items()]
    )
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    rates = cells.select(
        *by,
        *[c.alias(f"{n}_count") for n, c in zip(("tp", "tn", "fp", "fn"), (tp, tn, fp, fn))],
        safe_ratio(tp, tp + fn).alias("tpr"),
        safe_ratio(tn, tn + fp).alias("tnr"),
        safe_ratio(fp, tn + fp).alias("fpr"),
        safe_ratio(fn, tp + fn).alias("fnr"),
        (tp + fn).alias("gt_pos"),
        (tn + fp).alias("gt_neg"),
        safe_ratio(tp + fn, tp + tn + fp + fn).alias("gt_pos_ratio"),
        safe_ratio(tp + fp, tp + tn + fp + fn).alias("pred_pos_ratio"),
    )
    if mode == "rate":
        precision = safe_ratio(F.col("tpr"), F.col("tpr") + F.col("fpr"))
        accuracy = (F.col("tpr") + F.col("tnr")) / 2
    elif mode == "count":
        n_tp, n_tn, n_fp, n_fn = (F.col(f"{c}_count") for c in ("tp", "tn", "fp", "fn"))
        precision = safe_ratio(n_tp, n_tp + n_fp)
        accuracy = safe_ratio(n_tp + n_tn, n_tp + n_tn + n_fp + n_fn)
    else:
        raise ValueError("mode must be 'rate' or 'count'")
    scored = rates.select("*", precision.alias("precision"), F.col("tpr").alias("recall"), accuracy.alias("acc"))
    return scored.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def average_precision_binary(decisions: DataFrame) -> DataFrame:
    """Average precision of hard 0/1 decisions per part: R*P + (1-R)*prevalence."""
    counted = part_metrics(decisions, mode="count")
    hits = F.coalesce(F.col("recall") * F.col("precision"), F.lit(0.0))
    score = hits + (1 - F.col("recall")) * F.col("gt_pos_ratio")
    return counted.select("part", score.alias("average_precision"), "recall")


def hamming_cases(decisions: DataFrame, variant: str) -> DataFrame:
    """Hamming score per case.

    `a`: shared / given positives, 1 if both sets are empty, null if only the given set is.
    `b`: as `a`, but 0 if only the given set is empty. `c`: share of parts decided correctly.
    """
    sets = decisions.groupBy("case_id").agg(
        F.sum("gt").alias("_given"),
        F.sum("pred").alias("_said"),
        F.sum(F.col("gt") * F.col("pred")).alias("_both"),
        F.avg((F.col("gt") == F.col("pred")).cast("double")).alias("_right"),
    )
    empty = (F.col("_given") == 0) & (F.col("_said") == 0)
    shared = safe_ratio(F.col("_both"), F.col("_given"))
    scores = {
        "a": F.when(empty, 1.0).otherwise(shared),
        "b": F.when(empty, 1.0).otherwise(F.coalesce(shared, F.lit(0.0))),
        "c": F.col("_right"),
    }
    return sets.select("case_id", scores[variant].alias("score"))


def hamming(decisions: DataFrame, variant: str) -> DataFrame:
    """Mean Hamming score over the cases that have one."""
    return hamming_cases(decisions, variant).agg(F.lit(variant).alias("variant"), F.avg("score").alias("score"))


def hamming_summary(decisions: DataFrame) -> DataFrame:
    """(variant, score) of all three Hamming scores and of exact match (`exact`), from one pass per case."""
    sets = decisions.groupBy("case_id").agg(
        F.sum("gt").alias("_given"), F.sum("pred").alias("_said"), F.sum(F.col("gt") * F.col("pred")).alias("_both"),
        F.avg((F.col("gt") == F.col("pred")).cast("double")).alias("_right"))
    empty = (F.col("_given") == 0) & (F.col("_said") == 0)
    shared = safe_ratio(F.col("_both"), F.col("_given"))
    scores = sets.agg(
        F.avg(F.when(empty, 1.0).otherwise(shared)).alias("a"),
        F.avg(F.when(empty, 1.0).otherwise(F.coalesce(shared, F.lit(0.0)))).alias("b"),
        F.avg("_right").alias("c"), F.avg((F.col("_right") == 1).cast("double")).alias("exact"))
    return scores.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("variant"), F.col(n).alias("score")) for n in ("a", "b", "c", "exact")])).alias("s")).select("s.*")


def exact_match(decisions: DataFrame) -> DataFrame:
    """Share of cases with every part right."""
    cases = decisions.groupBy("case_id").agg(F.min((F.col("gt") == F.col("pred")).cast("double")).alias("_all"))
    return cases.agg(F.avg("_all").alias("exact_match"))


def pr_curve(preds: DataFrame, n: int = 11) -> DataFrame:
    """Precision, recall and F1 per part at n evenly spaced thresholds (conf >= threshold).

    A row is counted once under the number of thresholds it reaches; the curve is a running total
    over at most n + 1 counts per part, so the predictions are not multiplied by n.
    """
    thresholds = [i / (n - 1) for i in range(n)]
    reached = F.lit(0)
    for t in thresholds:
        reached = reached + (F.col("conf") >= t).cast("int")
    counts = preds.groupBy("part", reached.alias("_reached")).agg(
        F.sum("gt").alias("_pos"), F.count("*").alias("_n")
    )
    grid = counts.select("part").distinct().select(
        "part", F.posexplode(F.array(*map(F.lit, thresholds))).alias("_level", "threshold")
    )
    empty = grid.select("part", (F.col("_level") + 1).alias("_reached"), F.lit(0).alias("_pos"), F.lit(0).alias("_n"))
    filled = counts.unionByName(empty).groupBy("part", "_reached").agg(F.sum("_pos").alias("_pos"), F.sum("_n").alias("_n"))
    down = W.partitionBy("part").orderBy(F.desc("_reached"))
    everything = W.partitionBy("part")
    totals = filled.select(
        "part",
        (F.col("_reached") - 1).alias("_level"),
        F.sum("_pos").over(down).alias("_tp"),
        F.sum("_n").over(down).alias("_said"),
        F.sum("_pos").over(everything).alias("_given"),
        F.sum("_n").over(everything).alias("_rows"),
    ).filter("_level >= 0")
    precision = F.coalesce(safe_ratio(F.col("_tp"), F.col("_said")), F.lit(0.0))
    recall = safe_ratio(F.col("_tp"), F.col("_given"))
    negatives = F.col("_rows") - F.col("_given")
    curve = totals.select(
        "part",
        F.get(F.array(*map(F.lit, thresholds)), F.col("_level")).alias("threshold"),
        precision.alias("precision"),
        recall.alias("recall"),
        safe_ratio(F.col("_said") - F.col("_tp"), negatives).alias("fpr"),
    )
    return curve.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def best_threshold(curve: DataFrame) -> DataFrame:
    """Threshold with the highest F1 per part, the lowest one of equals."""
    return first_per(curve, ["part"], [F.desc_nulls_last(F.round("f1", 12)), F.col("threshold")])


def threshold_at(curve: DataFrame, fpr: float | None = None, fnr: float | None = None) -> DataFrame:
    """Lowest threshold with at most the given false-positive rate, or highest with at most the miss rate."""
    if (fpr is None) == (fnr is None):
        raise ValueError("give exactly one of fpr and fnr")
    if fpr is not None:
        return curve.filter(F.col("fpr") <= fpr).groupBy("part").agg(F.min("threshold").alias("threshold"))
    return curve.filter(1 - F.col("recall") <= fnr).groupBy("part").agg(F.max("threshold").alias("threshold"))


def global_rates(decisions: DataFrame, parts: Sequence[str] | None = None) -> DataFrame:
    """False-positive rate, miss rate, accuracy and mean case accuracy over all rows."""
    scoped = decisions if parts is None else decisions.filter(F.col("part").isin(list(parts)))
    cells = {name: c.alias(name) for name, c in _confusion().items()}
    per_case = scoped.groupBy("case_id").agg(*cells.values(), F.count("*").alias("n"))
    tp, tn, fp, fn = (F.sum(c) for c in ("tp", "tn", "fp", "fn"))
    return per_case.agg(
        safe_ratio(fp, fp + tn).alias("fpr"),
        safe_ratio(fn, fn + tp).alias("fnr"),
        safe_ratio(tp + tn, F.sum("n")).alias("acc"),
        F.avg((F.col("tp") + F.col("tn")) / F.col("n")).alias("mean_case_acc"),
    )


def _with_case_count(study: DataFrame, by: Sequence[str], counts: dict[str, Column], rows: Column) -> DataFrame:
    """Counts per group over the rows of interest, with `_cases`, the number of cases of the whole study.

    One pass over the study: a case keeps its rows of interest, each as a struct, and adds one row that
    stands for itself, so cases are counted by the same grouping.
    """
    kept = F.struct(*by, *[c.alias(n) for n, c in counts.items()])
    cases = study.groupBy("case_id").agg(F.collect_list(F.when(rows, kept)).alias("rows"))
    itself = F.array(F.get("rows", F.lit(-1)))
    every = cases.select("case_id", F.explode(F.concat("rows", itself)).alias("r"))
    is_case = F.col("r").isNull() & F.col("case_id").isNotNull()
    grouped = every.groupBy(F.col("r").isNull().alias("_self"), *[F.col(f"r.{c}").alias(c) for c in by]).agg(
        F.count_if(is_case).alias("_own"), *[F.count_if(F.col(f"r.{n}")).alias(n) for n in counts])
    total = grouped.withColumn("_cases", F.sum("_own").over(W.partitionBy(F.lit(0))))  # one row per group
    return total.filter(~F.col("_self")).drop("_self", "_own")


def error_attribution(study: DataFrame) -> DataFrame:
    """Per part, what explains its errors, as shares of the number of cases.

    `study` has case_id, part, v_pred, pred, gt and a reviewer's `remarks`. Only parts with a photo
    model (v_pred <> -1) that have an error or a remark of interest are reported.
    """
    wrong, seen = F.col("pred") != F.col("gt"), F.col("v_pred") != -1
    relabel, hard = F.col("remarks") == "label error", F.col("remarks") == "hard sample"
    kinds = {
        "error": seen & wrong,
        "label_error_different": seen & relabel & wrong,
        "label_error_same": seen & relabel & ~wrong,
        "hard_sample": seen & hard & wrong,
    }
    counts = _with_case_count(study, ["part"], kinds, reduce(lambda a, b: a | b, (F.coalesce(k, F.lit(False)) for k in kinds.values())))
    shares = counts.select("part", *[safe_ratio(F.col(n), F.col("_cases")).alias(n) for n in kinds])
    unexplained = F.col("error") - F.col("hard_sample") - F.col("label_error_different") + F.col("label_error_same")
    return shares.withColumn("unexplained", unexplained)


def remark_counts(study: DataFrame, remark: str, by: Sequence[str]) -> DataFrame:
    """Rows with one remark per group, with their ratio to the number of cases."""
    said = F.col("remarks") == remark
    counted = _with_case_count(study, by, {"count": said}, said)
    return counted.select(*by, "count", safe_ratio(F.col("count"), F.col("_cases")).alias("ratio"))


def after_repair_cases(study: DataFrame, more_than: int = 2) -> DataFrame:
    """Label errors per case and whether they are so many that the photos were likely taken after repair."""
    errors = study.filter(F.col("remarks") == "label error").groupBy("case_id").agg(
        F.count("*").alias("label_error_count")
    )
    return errors.withColumn("after_repair", flag_gt(F.col("label_error_count"), more_than))


def recall_bands(metrics: DataFrame, low: float = 0.2, high: float = 0.6) -> DataFrame:
    """How many parts have a low or a high recall, with the mean metrics."""
    return metrics.agg(
        F.count_if(F.col("recall") <= low).alias("low_recall"),
        F.count_if(F.col("recall") >= high).alias("high_recall"),
        F.avg("precision").alias("avg_precision"),
        F.avg("recall").alias("avg_recall"),
        F.avg("f1").alias("avg_f1"),
    )


def calibration_bins(preds: DataFrame, bins: int = 15) -> DataFrame:
    """Rows, accuracy and mean confidence of the winning class per equal-width confidence bin."""
    confidence = F.greatest(F.col("conf"), 1 - F.col("conf"))
    right = ((F.col("conf") > 0.5).cast("int") == F.col("gt")).cast("double")
    bin_no = F.least(F.floor(confidence * bins), F.lit(bins - 1)).cast("int")
    return preds.groupBy(bin_no.alias("bin")).agg(
        F.count("*").alias("rows"), F.avg(right).alias("accuracy"), F.avg(confidence).alias("confidence")
    )


def calibration(preds: DataFrame, bins: int = 15) -> DataFrame:
    """Expected calibration error: row-weighted mean gap between accuracy and confidence."""
    gap = F.abs(F.col("accuracy") - F.col("confidence")) * F.col("rows")
    return calibration_bins(preds, bins).agg(safe_ratio(F.sum(gap), F.sum("rows")).alias("ece"))


def multilabel_scores(decisions: DataFrame, average: str) -> DataFrame:
    """Accuracy, precision, recall and F1, pooled over all parts (micro) or averaged over them (macro)."""
    names = ["acc", "precision", "recall", "f1"]
    if average == "micro":
        scored = part_metrics(decisions.withColumn("part", F.lit("all")), mode="count")
        return scored.select(F.lit("micro").alias("average"), *names)
    per_part = part_metrics(decisions, mode="count")
    zeroed = [F.avg(F.coalesce(n, F.lit(0.0))).alias(n) for n in names]
    return per_part.agg(*zeroed).select(F.lit("macro").alias("average"), *names)


def class_probability(preds: DataFrame, probs: str) -> DataFrame:
    """Winning class and its probability."""
    return preds.withColumn("pred_prob", F.array_max(probs)).withColumn(
        "pred", (F.array_position(probs, F.array_max(probs)) - 1).cast("int")
    )
