"""Label-table, voting and evaluation queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.functions import file_key
from labelloom.operators import aggregates, evaluate, joins, labels, ranking
from labelloom.plans.registry import query
from labelloom.plans.sampling import PARTS
from labelloom.plans.views import ALL_PARTS, Views, with_views


def _decisions(v: Views) -> DataFrame:
    return evaluate.ensemble_vote(v.predictions, v.labels, v.parts)


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


# --- label tables ---

@query("multilabel", with_views("select case_id, " + ", ".join(
    [f"""max(case when part = '{p}' then 1 else 0 end) as "vision_{p}" """ for p in PARTS]
    + [f"""max(case when part = '{p}' then 1 else 0 end) as "{p}" """ for p in PARTS]
    + ["arg_min(damage_cond, line * 1000000 + fval) as damage_cond"]) + " from part_lines group by case_id", "part_lines"))
def _(v: Views):
    lines = v.part_lines.withColumn("at", F.col("line") * 1000000 + F.col("fval"))
    return labels.multilabel(lines, "case_id", "part", v.parts, ["damage_cond"], "at")


MAPPING = {"click": ("LARGE", "SMALL"), "view": ("LARGE", "PROMO", "MEDIUM"), "error": ("STANDARD",)}
_MAPPING_SQL = " union all ".join(
    f"select '{view}' as view, '{p}' as part" for view, parts in MAPPING.items() for p in parts
)


@query("view_labels", with_views("""select f.case_id, f.view, f.filename, m.part, l.gt from
    (select case_id, view, cast(case_id as varchar) || '_' || cast(doc_id as varchar) || '.JPG' as filename from files
     qualify row_number() over (partition by case_id, view order by final_date, doc_id) = 1) f
    join mapping m on f.view = m.view join labels_long l on l.case_id = f.case_id and l.part = m.part""",
    "files", "labels_long", mapping=_MAPPING_SQL))
def _(v: Views):
    mapping = v.spark.createDataFrame(
        [(view, p) for view, parts in MAPPING.items() for p in parts], "view string, part string"
    )
    files = v.files.withColumn("filename", file_key(F.col("case_id"), F.col("doc_id")))
    return labels.view_labels(v.labels_by_part, mapping, files, [F.col("final_date"), F.col("doc_id")])


@query("explode_predictions", with_views("""select cast(case_id as varchar) || '.JPG' as file, part, conf > 0.5 as pred, conf, gt
    from case_predictions""", "case_predictions"))
def _(v: Views):
    entry = F.struct("part", (F.col("conf") > 0.5).alias("pred"), "conf", "gt")
    batches = v.case_predictions.groupBy("case_id").agg(F.collect_list(entry).alias("e"))
    packed = batches.select(
        F.concat(F.col("case_id").cast("string"), F.lit(".JPG")).alias("file"),
        F.col("e.part").alias("parts"), F.col("e.pred").alias("pred"), F.col("e.conf").alias("conf"), F.col("e.gt").alias("gt"),
    )
    return labels.explode_predictions(packed)


_PHOTOS = """select case_id, part, view % 2 as view, max(cast(conf > 0.5 as integer)) as pred, max(gt) as gt
    from predictions group by case_id, part, view % 2"""


def _photo_predictions(v: Views) -> DataFrame:
    return v.predictions.groupBy("case_id", "part", (F.col("view") % 2).alias("view")).agg(
        F.max((F.col("conf") > 0.5).cast("int")).alias("pred"), F.max("gt").alias("gt")
    )


@query("pred_multilabel", with_views(f"""select case_id, view, cast(case_id as varchar) || '.JPG' as filename, 'm' as model,
    {', '.join(f"max(pred) filter (where part = '{p}') as \"vision_{p}\"" for p in ALL_PARTS)} from photos
    group by case_id, view having count(*) = {len(ALL_PARTS)}""", "predictions", photos="""select case_id, part, 0 as view,
    max(cast(conf > 0.5 as integer)) as pred, max(gt) as gt from predictions group by case_id, part"""))
def _(v: Views):
    # One photo a case shows all its parts; the rows with every part of the table are kept.
    whole = v.by_case(v.predictions).groupBy("case_id", "part").agg(
        F.max((F.col("conf") > 0.5).cast("int")).alias("pred"), F.max("gt").alias("gt")).withColumn("view", F.lit(0))
    photos = whole.withColumns({"filename": F.concat(F.col("case_id").cast("string"), F.lit(".JPG")), "model": F.lit("m")})
    return labels.pred_multilabel(photos, ALL_PARTS)


@query("part_agreement", with_views("""select part, view, count(*) as rows, round(sum(cast(pred = gt as integer)) / count(*), 6) as acc
    from photos group by part, view""", "predictions", photos=_PHOTOS))
def _(v: Views):
    return _rounded(labels.part_agreement(_photo_predictions(v), ["part", "view"]), "acc")


# --- votes and per-case accuracy ---

@query("ensemble_vote", with_views("select case_id, part, gt, pred from decisions", "decisions"))
def _(v: Views):
    return _decisions(v)


@query("ensemble_vote_tie_one", with_views("""select l.case_id, l.part, coalesce(v.gt, l.gt) as gt,
    case when v.n is null then 0 when v.pos * 2 >= v.n then 1 else 0 end as pred
    from labels_long l left join votes v on l.case_id = v.case_id and l.part = v.part
    where l.case_id in (select case_id from predictions)""", "labels_long", "votes"))
def _(v: Views):
    return evaluate.ensemble_vote(v.predictions, v.labels, tie="one")


@query("case_accuracy", with_views("""select case_id, cast(sum(cast(gt = pred as integer)) as bigint) as correct,
    round(avg(cast(gt = pred as double)), 6) as case_acc,
    coalesce(string_agg(case when gt = pred then part end, ',' order by part), '') as correct_parts,
    coalesce(string_agg(case when gt <> pred then part end, ',' order by part), '') as wrong_parts
    from decisions group by case_id""", "decisions"))
def _(v: Views):
    listed = evaluate.case_accuracy(_decisions(v), lists=True)
    joined = listed.withColumns({n: F.array_join(n, ",") for n in ("correct_parts", "wrong_parts")})
    return _rounded(joined, "case_acc")


CELLS = {
    "cells": """select part, sum(case when gt = 1 and pred = 1 then w else 0 end) as tp, sum(case when gt <> 1 and pred <> 1 then w else 0 end) as tn,
        sum(case when gt <> 1 and pred = 1 then w else 0 end) as fp, sum(case when gt = 1 and pred <> 1 then w else 0 end) as fn
        from graded_rows group by part""",
    "rates": """select part, tp as tp_count, tn as tn_count, fp as fp_count, fn as fn_count, tp / nullif(tp + fn, 0) as tpr,
        tn / nullif(tn + fp, 0) as tnr, fp / nullif(tn + fp, 0) as fpr, fn / nullif(tp + fn, 0) as fnr, tp + fn as gt_pos, tn + fp as gt_neg,
        (tp + fn) / (tp + tn + fp + fn) as gt_pos_ratio, (tp + fp) / (tp + tn + fp + fn) as pred_pos_ratio from cells""",
    "by_rate": "select *, tpr / nullif(tpr + fpr, 0) as precision, tpr as recall, (tpr + tnr) / 2 as acc from rates",
    "by_count": """select *, tp_count / nullif(tp_count + fp_count, 0) as precision, tpr as recall,
        (tp_count + tn_count) / (tp_count + tn_count + fp_count + fn_count) as acc from rates""",
}
COUNTS = ("tp_count", "tn_count", "fp_count", "fn_count", "gt_pos", "gt_neg")
RATIOS = ("tpr", "tnr", "fpr", "fnr", "gt_pos_ratio", "pred_pos_ratio", "precision", "recall", "acc", "f1")


def _metric_sql(source: str, weight: str = "1") -> str:
    f1 = "2 * precision * recall / nullif(precision + recall, 0)"
    counts = ", ".join(f"cast({c} as bigint) as {c}" for c in COUNTS)
    shown = ", ".join(f"round({f1 if r == 'f1' else r}, 6) as {r}" for r in RATIOS)
    return with_views(
        f"select part, {counts}, {shown} from {source}",
        "decisions", graded_rows=f"select *, {weight} as w from decisions", **CELLS)


@query("part_metrics_rate", _metric_sql("by_rate"))
def _(v: Views):
    return _rounded(evaluate.part_metrics(_decisions(v)), *RATIOS)


@query("part_metrics_count", _metric_sql("by_count"))
def _(v: Views):
    return _rounded(evaluate.part_metrics(_decisions(v), mode="count"), *RATIOS)


@query("part_metrics_weighted", _metric_sql("by_count", "1 + case_id % 3"))
def _(v: Views):
    weighted = _decisions(v).withColumn("w", 1 + F.col("case_id") % 3)
    return _rounded(evaluate.part_metrics(weighted, mode="count", weight="w"), *RATIOS)


def _metric_view(sql: str, **more: str) -> str:
    scored = "select *, 2 * precision * recall / nullif(precision + recall, 0) as f1 from by_rate"
    return with_views(sql, "decisions", graded_rows="select *, 1 as w from decisions", **CELLS, scored=scored, **more)


@query("macro_metrics", _metric_view("""select round(avg(tpr), 6) as avg_tpr, round(avg(tnr), 6) as avg_tnr, round(avg(acc), 6) as avg_acc,
    round(min(tpr), 6) as min_tpr, round(min(tnr), 6) as min_tnr, round(min(acc), 6) as min_acc from scored"""))
def _(v: Views):
    macro = aggregates.macro(evaluate.part_metrics(_decisions(v)), ["tpr", "tnr", "acc"])
    return _rounded(macro, *macro.columns)


@query("metric_correlation", _metric_view("""select round(corr(tpr, gt_pos_ratio), 6) as corr_tpr,
    round(corr(tnr, gt_pos_ratio), 6) as corr_tnr, round(corr(acc, gt_pos_ratio), 6) as corr_acc from scored"""))
def _(v: Views):
    found = aggregates.correlations(evaluate.part_metrics(_decisions(v)), ["tpr", "tnr", "acc"], "gt_pos_ratio")
    return _rounded(found, *found.columns)


@query("recall_bands", _metric_view("""select count(*) filter (where recall <= 0.84) as low_recall, count(*) filter (where recall >= 0.86) as high_recall,
    round(avg(precision), 6) as avg_precision, round(avg(recall), 6) as avg_recall, round(avg(f1), 6) as avg_f1 from scored"""))
def _(v: Views):
    bands = evaluate.recall_bands(evaluate.part_metrics(_decisions(v)), 0.84, 0.86)
    return _rounded(bands, "avg_precision", "avg_recall", "avg_f1")


@query("average_precision", with_views("""select part, round(coalesce(recall * precision, 0) + (1 - recall) * gt_pos_ratio, 6) as average_precision,
    round(recall, 6) as recall from by_count""", "decisions", graded_rows="select *, 1 as w from decisions", **CELLS))
def _(v: Views):
    return _rounded(evaluate.average_precision_binary(_decisions(v)), "average_precision", "recall")


_SETS = "select case_id, sum(gt) as g, sum(pred) as s, sum(gt * pred) as b, avg(cast(gt = pred as double)) as c from decisions group by case_id"


@query("hamming_scores", with_views("""select 'a' as variant, round(avg(case when g = 0 and s = 0 then 1 else b / nullif(g, 0) end), 6) as score from sets
    union all select 'b', round(avg(case when g = 0 and s = 0 then 1 else coalesce(b / nullif(g, 0), 0) end), 6) from sets
    union all select 'c', round(avg(c), 6) from sets
    union all select 'exact', round(avg(case when c = 1 then 1.0::double else 0 end), 6) from sets""", "decisions", sets=_SETS))
def _(v: Views):
    scores = evaluate.hamming_summary(_decisions(v))
    return _rounded(scores, "score")


CURVE = {
    "steps": "select cast(k as double) / 10 as threshold from (select unnest(range(11)) as k)",
    "raw_curve": """select part, threshold, sum(case when conf >= threshold then gt else 0 end) as tp,
        sum(case when conf >= threshold then 1 else 0 end) as said, sum(gt) as given, count(*) as n
        from (select part, conf, gt from predictions) cross join steps group by part, threshold""",
    "curve": """select part, threshold, coalesce(tp / nullif(said, 0), 0) as precision, tp / nullif(given, 0) as recall,
        (said - tp) / nullif(n - given, 0) as fpr from raw_curve""",
    "curve_f1": "select *, 2 * precision * recall / nullif(precision + recall, 0) as f1 from curve",
}
_SHOWN = "part, threshold, round(precision, 6) as precision, round(recall, 6) as recall, round(fpr, 6) as fpr, round(f1, 6) as f1"


@query("pr_curve", with_views(f"select {_SHOWN} from curve_f1", "predictions", **CURVE))
def _(v: Views):
    return _rounded(evaluate.pr_curve(v.predictions), "precision", "recall", "fpr", "f1")


@query("best_threshold", with_views(f"""select {_SHOWN} from curve_f1 qualify row_number() over
    (partition by part order by round(f1, 12) desc nulls last, threshold) = 1""", "predictions", **CURVE))
def _(v: Views):
    return _rounded(evaluate.best_threshold(evaluate.pr_curve(v.predictions)), "precision", "recall", "fpr", "f1")


@query("threshold_at_rate", with_views("""select part, 'fpr' as rule, min(threshold) as threshold from curve where fpr <= 0.1 group by part
    union all select part, 'fnr', max(threshold) from curve where 1 - recall <= 0.2 group by part""", "predictions", **CURVE))
def _(v: Views):
    curve = evaluate.pr_curve(v.predictions)
    by_fpr = evaluate.threshold_at(curve, fpr=0.1).withColumn("rule", F.lit("fpr"))
    return by_fpr.unionByName(evaluate.threshold_at(curve, fnr=0.2).withColumn("rule", F.lit("fnr")))


# --- case study ---

_STUDY = """select d.case_id, d.part, coalesce(v.v_pred, -1) as v_pred, d.pred, d.gt,
    case when d.gt = 0 and d.pred = 1 then 1 else 0 end as fp, case when d.gt = 1 and d.pred = 0 then 1 else 0 end as fn,
    case d.case_id % 4 when 0 then 'error' when 1 then 'label error' when 2 then 'hard sample' end as remarks
    from decisions d left join (select case_id, part, case when pos * 2 > n then 1 else 0 end as v_pred from votes
    where part <> 'PROMO') v on d.case_id = v.case_id and d.part = v.part"""


def _vision(predictions: DataFrame) -> DataFrame:
    """Photo-model decisions, which one part lacks."""
    seen = evaluate.count_votes(predictions.filter("part <> 'PROMO'"), tie="zero")
    return seen.select("case_id", "part", F.col("pred").alias("v_pred"))


def _remarks() -> Column:
    turn = F.col("case_id") % 4
    return F.when(turn == 0, "error").when(turn == 1, "label error").when(turn == 2, "hard sample")


def _long_study(v: Views) -> DataFrame:
    """The same study straight from the long decisions."""
    gt, pred = F.col("gt"), F.col("pred")
    study = joins.lookup_or(_decisions(v), _vision(v.predictions), ["case_id", "part"], "v_pred", F.lit(-1))
    return study.withColumns({
        "fp": ((gt == 0) & (pred == 1)).cast("int"),
        "fn": ((gt == 1) & (pred == 0)).cast("int"),
        "remarks": _remarks(),
    })


def _study(v: Views) -> DataFrame:
    predictions = v.by_case(v.predictions)
    decided = evaluate.ensemble_vote(predictions, v.by_case(v.label_grid), v.parts)

    def wide(value: str) -> DataFrame:
        return decided.groupBy("case_id").agg(*joins.cells("part", value, v.parts, F.max))

    return labels.case_study(wide("pred"), wide("gt"), _vision(predictions), v.parts).withColumn("remarks", _remarks())


@query("case_study", with_views("select * from study", "decisions", "votes", study=_STUDY))
def _(v: Views):
    return _study(v)


@query("global_rates", with_views("""select round(sum(fp) / sum(1 - gt), 6) as fpr, round(sum(fn) / sum(gt), 6) as fnr,
    round(avg(cast(gt = pred as double)), 6) as acc, (select round(avg(a), 6) from (select avg(cast(gt = pred as double)) as a
    from study where part <> 'PROMO' group by case_id)) as mean_case_acc from study where part <> 'PROMO'""", "decisions", "votes", study=_STUDY))
def _(v: Views):
    rates = evaluate.global_rates(_decisions(v), [p for p in v.parts if p != "PROMO"])
    return _rounded(rates, *rates.columns)


_KINDS = """select part, count(*) filter (where v_pred <> -1 and pred <> gt) / (select count(distinct case_id) from study) as error,
    count(*) filter (where v_pred <> -1 and remarks = 'label error' and pred <> gt) / (select count(distinct case_id) from study) as different,
    count(*) filter (where v_pred <> -1 and remarks = 'label error' and pred = gt) / (select count(distinct case_id) from study) as same,
    count(*) filter (where v_pred <> -1 and remarks = 'hard sample' and pred <> gt) / (select count(distinct case_id) from study) as hard
    from study group by part"""


@query("error_attribution", with_views("""select part, round(error, 6) as error, round(different, 6) as label_error_different,
    round(same, 6) as label_error_same, round(hard, 6) as hard_sample, round(error - hard - different + same, 6) as unexplained
    from kinds where error + different + same + hard > 0""", "decisions", "votes", study=_STUDY, kinds=_KINDS))
def _(v: Views):
    found = evaluate.error_attribution(_long_study(v))
    return _rounded(found, *[c for c in found.columns if c != "part"])


@query("remark_counts", with_views("""select part, fp, fn, count(*) as count,
    round(count(*) / (select count(distinct case_id) from study), 6) as ratio from study where remarks = 'error' group by part, fp, fn""",
    "decisions", "votes", study=_STUDY))
def _(v: Views):
    return _rounded(evaluate.remark_counts(_long_study(v), "error", ["part", "fp", "fn"]), "ratio")


@query("after_repair", with_views("""select case_id, count(*) as label_error_count, case when count(*) > 2 then 1 else 0 end as after_repair
    from study where remarks = 'label error' and pred <> gt group by case_id""", "decisions", "votes", study=_STUDY))
def _(v: Views):
    return evaluate.after_repair_cases(_long_study(v).filter("pred <> gt"))


# --- calibration and scores ---

@query("calibration", with_views("""select round(sum(abs(acc - c) * n) / sum(n), 6) as ece from
    (select least(cast(floor(greatest(conf, 1 - conf) * 15) as integer), 14) as bin, count(*) as n,
     avg(greatest(conf, 1 - conf)) as c, avg(cast(cast(conf > 0.5 as integer) = gt as double)) as acc from predictions group by 1)""", "predictions"))
def _(v: Views):
    return _rounded(evaluate.calibration(v.predictions), "ece")


@query("multilabel_scores", with_views("""select 'macro' as average, round(avg(acc), 6) as acc, round(avg(coalesce(precision, 0)), 6) as precision,
    round(avg(coalesce(recall, 0)), 6) as recall, round(avg(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0)), 6) as f1 from by_count
    union all select 'micro', round(sum(tp + tn) / sum(tp + tn + fp + fn), 6), round(sum(tp) / sum(tp + fp), 6), round(sum(tp) / sum(tp + fn), 6),
    round(2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)), 6) from cells""",
    "decisions", graded_rows="select *, 1 as w from decisions", **CELLS))
def _(v: Views):
    decided = _decisions(v)
    both = evaluate.multilabel_scores(decided, "macro").unionByName(evaluate.multilabel_scores(decided, "micro"))
    return _rounded(both, "acc", "precision", "recall", "f1")


@query("accuracy_quantiles", with_views("""select cast(unnest([0.25, 0.75]) as double) as prob, round(unnest([quantile_cont(a, 0.25), quantile_cont(a, 0.75)]), 6)
    as quantile from (select avg(cast(gt = pred as double)) as a from decisions group by case_id)""", "decisions"))
def _(v: Views):
    accuracy = evaluate.case_accuracy(_decisions(v))
    return _rounded(ranking.exact_quantile(accuracy, "case_acc", [0.25, 0.75]), "quantile")


@query("accuracy_histogram", with_views("""select least(cast(floor(a * 10) as integer), 9) as bin, count(*) as count from
    (select avg(cast(gt = pred as double)) as a from decisions group by case_id) group by 1""", "decisions"))
def _(v: Views):
    return aggregates.histogram(evaluate.case_accuracy(_decisions(v)), "case_acc", 10)


@query("class_probability", with_views("""select sample_id, round(list_max(probs), 6) as pred_prob,
    cast(list_position(probs, list_max(probs)) - 1 as integer) as pred from class_probs""", "class_probs"))
def _(v: Views):
    scored = evaluate.class_probability(v.class_probs, "probs")
    return _rounded(scored.select("sample_id", "pred_prob", "pred"), "pred_prob")
