"""Label-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelloom.operators import quality
from labelloom.operators.models import out_of_fold
from labelloom.plans.registry import query
from labelloom.plans.views import CLASSES, Views, with_views

TARGETS = ("ECONOMY", "LARGE", "MEDIUM", "STANDARD")

ISSUE_VIEWS = {
    "thresholds": """select part, avg(1 - conf) filter (where gt = 0) as t0, avg(conf) filter (where gt = 1) as t1
        from case_predictions group by part""",
    "guesses": """select case_id, part, conf, gt, case when gt = 1 then conf else 1 - conf end as self_confidence,
        case when 1 - conf >= t0 and conf >= t1 then case when conf > 1 - conf then 1 else 0 end
             when conf >= t1 then 1 when 1 - conf >= t0 then 0 end as confident
        from case_predictions join thresholds using (part)""",
    "issues": "select *, case when confident is not null and confident <> gt then 1 else 0 end as is_issue from guesses",
    "by_case": "select case_id, max(is_issue) as is_issue, min(self_confidence) as quality from issues group by case_id",
}


def _issue_sql(sql: str, **more: str) -> str:
    return with_views(sql, "case_predictions", "labels_long", **ISSUE_VIEWS, **more)


def _materialized(sql: str, **more: str) -> str:
    """The same with every view computed once, for statements that use some of them several times."""
    return _issue_sql(sql, **more).replace(" as (", " as materialized (")


def _rounded(df, *names: str, digits: int = 6):
    return df.withColumns({n: F.round(n, digits) for n in names})


def _issues(v: Views):
    return quality.find_label_issues(v.case_predictions, v.parts)


@query("confident_thresholds", _issue_sql("select part, round(t0, 6) as t0, round(t1, 6) as t1 from thresholds"))
def _(v: Views):
    return _rounded(quality.confident_thresholds(v.case_predictions), "t0", "t1")


@query("label_issues", _issue_sql(
    "select case_id, part, gt, confident, is_issue, round(self_confidence, 6) as self_confidence from issues"))
def _(v: Views):
    return _rounded(_issues(v).drop("conf"), "self_confidence")


@query("label_issues_unbounded", _issue_sql("select part, confident, is_issue, count(*) as n from issues group by all"))
def _(v: Views):
    flagged = quality.find_label_issues(v.case_predictions)
    return flagged.groupBy("part", "confident", "is_issue").agg(F.count("*").alias("n"))


@query("ranked_issues", _issue_sql("""select case_id, round(quality, 6) as quality, cast(row_number() over (order by quality, case_id) as integer) as rank
    from by_case where is_issue = 1 qualify rank <= 1500"""))
def _(v: Views):
    return _rounded(quality.rank_issues(_issues(v), 1500), "quality")


@query("issue_coverage", _issue_sql(
    "select count(*) as cases, cast(sum(is_issue) as bigint) as issues, round(sum(is_issue) / count(*), 6) as coverage from by_case"))
def _(v: Views):
    return _rounded(quality.issue_coverage(_issues(v)), "coverage")


HEALTH_VIEWS = {
    "long_probs": """select sample_id, label, dataset_index, cast(unnest(range(10)) as integer) as j, unnest(probs) as p from class_probs""",
    "cuts": "select dataset_index, j, avg(p) as t from long_probs where label = j group by all",
    "sure": """select sample_id, dataset_index, label, min(j) as confident from (select l.*, max(p) over (partition by sample_id) as top
        from long_probs l join cuts using (dataset_index, j) where p >= t) where p = top group by all""",
    "guess": """select c.sample_id, c.dataset_index, c.label, s.confident from class_probs c left join sure s using (sample_id)""",
    "sizes": "select dataset_index, label as given, count(*) as rows from guess group by all",
    "cells": """select dataset_index, given, j as guess, rows, greatest(coalesce(n, 0), case when given = j then 1 else 0 end) as n
        from sizes cross join (select cast(unnest(range(10)) as integer) as j) left join
        (select dataset_index, label as given, confident as j, count(*) as n from guess group by all) using (dataset_index, given, j)""",
    "joint": "select dataset_index, given, guess, n * rows / sum(n) over (partition by dataset_index, given) as mass from cells",
    "row_side": """select dataset_index, given as class, sum(mass) as given_rows, sum(case when given <> guess then mass else 0 end) as off_given
        from joint group by all""",
    "column_side": """select dataset_index, guess as class, sum(mass) as true_rows, sum(case when given <> guess then mass else 0 end) as off_true
        from joint group by all""",
    "health": """select dataset_index, class, cast(round_even(round(off_given, 6), 0) as bigint) as label_issues,
        cast(round_even(round(off_true, 6), 0) as bigint) as inverse_issues,
        round(off_given / given_rows, 6) as label_noise, round(off_true / true_rows, 6) as inverse_noise,
        round(1 - off_given / given_rows, 6) as quality from row_side join column_side using (dataset_index, class)""",
}


@query("class_issues", with_views("""select sample_id, label, confident,
    case when confident is not null and confident <> label then 1 else 0 end as is_issue from guess""", "class_probs", **HEALTH_VIEWS))
def _(v: Views):
    flagged = quality.class_issues(v.class_probs, "probs", "label", CLASSES, ["dataset_index"])
    return flagged.select("sample_id", "label", "confident", "is_issue")


@query("class_health", with_views("select * from health", "class_probs", **HEALTH_VIEWS))
def _(v: Views):
    health = quality.class_health(v.class_probs, "probs", "label", CLASSES, ["dataset_index"])
    return _rounded(health, "label_noise", "inverse_noise", "quality")


@query("compare_health", with_views("""select coalesce(a.class, b.class) as class, a.quality as quality_before, a.label_issues as issues_before,
    b.quality as quality_after, b.label_issues as issues_after, round(b.quality - a.quality, 4) as gain
    from (select * from health where dataset_index = 1) a full join (select * from health where dataset_index = 2) b
    on a.class = b.class""", "class_probs", **HEALTH_VIEWS))
def _(v: Views):
    def part(index: int):
        rows = v.class_probs.filter(F.col("dataset_index") == index)
        return _rounded(quality.class_health(rows, "probs", "label", CLASSES), "quality")
    return _rounded(quality.compare_health(part(1), part(2)), "gain", digits=4)


OOD_VIEWS = {
    "flat": "select sample_id, label, cast(unnest(range(10)) as integer) as j, unnest(probs) as p from class_probs",
    "limits": "select j, coalesce(t, 0) as t from (select cast(unnest(range(10)) as integer) as j) left join "
              "(select label as j, avg(p) as t from flat where label = j group by label) using (j)",
    "raised": "select sample_id, j, p + (select max(t) from limits) - t as r from flat join limits using (j)",
    "normed": "select sample_id, r / sum(r) over (partition by sample_id) as q from raised",
    "ood": "select sample_id, 1 + sum(case when q > 0 then q * ln(q) else 0 end) / ln(10) as ood_score from normed group by sample_id",
}


@query("ood_score", with_views("select sample_id, round(ood_score, 6) as ood_score from ood", "class_probs", **OOD_VIEWS))
def _(v: Views):
    scored = quality.ood_score(v.class_probs, "probs", "label", CLASSES)
    return _rounded(scored.select("sample_id", "ood_score"), "ood_score")


AUM_VIEWS = {
    "flat_logits": "select sample_id, epoch, label, cast(unnest(range(10)) as integer) as j, unnest(logits) as x from epoch_logits",
    "margins": """select sample_id, epoch, max(x) filter (where j = label) - max(x) filter (where j <> label) as m
        from flat_logits group by sample_id, epoch""",
    "aums": "select sample_id, avg(m) as aum from margins group by sample_id",
}


@query("aum", with_views("select sample_id, round(aum, 6) as aum from aums", "epoch_logits", **AUM_VIEWS))
def _(v: Views):
    return _rounded(quality.aum(v.epoch_logits), "aum")


def _known_aum(v: Views):
    """AUM of the samples that have one; every seventh is left without."""
    return _rounded(quality.aum(v.epoch_logits.filter("sample_id % 7 <> 0")), "aum", digits=9)


_KNOWN = "select sample_id, round(aum, 9) as aum from aums where sample_id % 7 <> 0"


@query("select_clean", with_views("""select sample_id, label, round(aum, 6) as aum from class_probs join known using (sample_id)
    where aum >= (select quantile_cont(aum, 0.6) from known)""", "class_probs", "epoch_logits", **AUM_VIEWS, known=_KNOWN))
def _(v: Views):
    rows = v.class_probs.select("sample_id", "label")
    return _rounded(quality.select_clean(rows, _known_aum(v), "sample_id"), "aum")


@query("select_clean_bounded", with_views("""select sample_id, label from class_probs join known using (sample_id) join scores using (sample_id)
    where aum >= (select quantile_cont(aum, 0.2) from known) and aum <= (select quantile_cont(aum, 0.8) from known)
    and ood_score >= (select quantile_cont(ood_score, 0.1) from scores)""", "class_probs", "epoch_logits", **AUM_VIEWS, **OOD_VIEWS, known=_KNOWN,
    scores="select sample_id, round(ood_score, 9) as ood_score from ood"))
def _(v: Views):
    scored = quality.ood_score(v.class_probs, "probs", "label", CLASSES)
    rows = _rounded(scored.select("sample_id", "label", "ood_score"), "ood_score", digits=9)
    return quality.select_clean(rows, _known_aum(v), "sample_id", lo=0.2, hi=0.8, ood=0.1).select("sample_id", "label")


@query("selection_report", with_views("""select label, count(*) as rows, cast(sum(keep) as bigint) as kept, round(sum(keep) / count(*), 6) as share from
    (select label, case when aum >= (select quantile_cont(aum, 0.6) from known) then 1 else 0 end as keep
     from class_probs join known using (sample_id)) group by label""", "class_probs", "epoch_logits", **AUM_VIEWS, known=_KNOWN))
def _(v: Views):
    rows, known = v.class_probs.select("sample_id", "label"), _known_aum(v)
    kept = quality.select_clean(rows, known, "sample_id")
    return _rounded(quality.selection_report(rows.join(known, "sample_id"), kept, "label"), "share")


@query("cap_selected", with_views("""select sample_id, label from class_probs join known using (sample_id)
    where aum >= (select quantile_cont(aum, 0.6) from known) qualify row_number() over
    (partition by label order by md5(concat(cast(sample_id as varchar), '-', '3')), sample_id) <= 12""", "class_probs", "epoch_logits", **AUM_VIEWS, known=_KNOWN))
def _(v: Views):
    kept = quality.select_clean(v.class_probs.select("sample_id", "label"), _known_aum(v), "sample_id")
    return quality.cap_per_class(kept.select("sample_id", "label"), "label", "sample_id", 12, 3)


SUSPICIOUS = {
    "counted": """select case_id, sum(case when part not in ('SMALL') then gt else 0 end) as given,
        sum(case when part in ('ECONOMY', 'LARGE', 'MEDIUM', 'STANDARD') and conf > 0.5 then 1 else 0 end) as predicted
        from case_predictions group by case_id""",
    "suspicious": """select case_id from counted where given >= 2 and predicted <= 1
        and case_id in (select case_id from by_case where is_issue = 1)""",
    "corrected": """select case_id, part, case when case_id in (select case_id from suspicious)
        and part in ('ECONOMY', 'LARGE', 'MEDIUM', 'STANDARD') then 0 else gt end as gt from labels_long""",
}


def _suspicious(v: Views, **options):
    flagged = quality.case_issues(_issues(v))
    return quality.suspicious_cases(
        v.case_predictions, flagged, TARGETS, exclude=["SMALL"], min_given=2, max_predicted=1, **options
    )


@query("correct_labels", _issue_sql("select case_id, part, gt from corrected", **SUSPICIOUS))
def _(v: Views):
    return quality.correct_labels(v.labels, _suspicious(v), TARGETS)


@query("correction_report", _issue_sql("""select part, cast(sum(b.gt) as bigint) as pos_before, cast(sum(1 - b.gt) as bigint) as neg_before,
    cast(sum(a.gt) as bigint) as pos_after, cast(sum(1 - a.gt) as bigint) as neg_after from labels_long b join corrected a using (case_id, part) group by part""", **SUSPICIOUS))
def _(v: Views):
    return quality.correction_report(v.labels, quality.correct_labels(v.labels, _suspicious(v), TARGETS))


@query("mirror_cases", _issue_sql("""select case_id from counted where given <= 1 and predicted >= 2
    and case_id in (select case_id from by_case where is_issue = 1)""", **SUSPICIOUS))
def _(v: Views):
    return _suspicious(v, mirror=True)


HALF = {
    "half": """select case_id from (select case_id, row_number() over (order by quality, case_id) as rn, count(*) over () as n
        from by_case where is_issue = 1) where rn <= floor(n / 2)""",
}


@query("worst_half", _issue_sql("select case_id from half", **HALF))
def _(v: Views):
    return quality.worst_half(_issues(v))


@query("correct_guarded", _materialized("""select case_id, part, case when listed and apply then 0 else gt end as gt from marked
    join shares using (part)""", **HALF,
    marked="select l.case_id, part, gt, h.case_id is not null as listed from labels_long l left join half h on l.case_id = h.case_id",
    shares="select part, sum(case when listed then 0 else gt end) / count(*) >= 0.2 as apply from marked group by part"))
def _(v: Views):
    return quality.correct_guarded(v.labels, quality.worst_half(_issues(v)), v.parts, min_pos=0.2)


@query("noisy_cases", _issue_sql("""select case_id from (select case_id from by_case where is_issue = 1 order by quality, case_id limit 500)
    union select case_id from (select case_id, min(self_confidence) as quality from issues where part = 'PROMO' group by case_id
    having max(is_issue) = 1 order by quality, case_id limit 300) except select case_id from files""",
    files="select user_id * 100 + day(ts) as case_id from events"))
def _(v: Views):
    issues = _issues(v)
    lists = [quality.rank_issues(issues, 500), quality.rank_issues(issues.filter("part = 'PROMO'"), 300)]
    return quality.noisy_cases(lists, v.files)


BALD_VIEWS = {
    "flat_draws": "select sample_id, epoch, cast(unnest(range(10)) as integer) as j, unnest(probs) as p from softmaxed",
    "mean_p": "select sample_id, j, avg(p) as p from flat_draws group by all",
    "h_mean": "select sample_id, -sum(case when p > 0 then p * ln(p) else 0 end) as h from mean_p group by all",
    "h_each": "select sample_id, -sum(case when p > 0 then p * ln(p) else 0 end) / 7 as h from flat_draws group by all",
    "balds": "select sample_id, a.h - b.h as bald from h_mean a join h_each b using (sample_id)",
}


def _draws(v: Views):
    from labelloom.functions import softmax

    return v.epoch_logits.select("sample_id", softmax(F.col("logits")).alias("probs"))


@query("bald", with_views("select sample_id, round(bald, 6) as bald from balds", "softmaxed", **BALD_VIEWS))
def _(v: Views):
    return _rounded(quality.bald(_draws(v), "sample_id", "probs", CLASSES), "bald")


@query("most_uncertain", with_views("""select sample_id, round(bald, 6) as bald from balds
    order by round(bald, 9) desc, sample_id limit 50""", "softmaxed", **BALD_VIEWS))
def _(v: Views):
    scores = _rounded(quality.bald(_draws(v), "sample_id", "probs", CLASSES), "bald", digits=9)
    return _rounded(quality.most_uncertain(scores, "sample_id", 50), "bald")


@query("first_batch", with_views("""select view, gt, sample_id from (select sample_id, label as gt, sample_id % 3 as view, round(aum, 9) as aum
    from class_probs join aums using (sample_id)) qualify row_number() over
    (partition by view, gt order by aum desc, sample_id) <= 10""", "class_probs", "epoch_logits", **AUM_VIEWS))
def _(v: Views):
    values = _rounded(quality.aum(v.epoch_logits), "aum", digits=9)
    rows = v.class_probs.select("sample_id", F.col("label").alias("gt"), (F.col("sample_id") % 3).alias("view"))
    return quality.first_batch(rows.join(values, "sample_id"), 10).select("view", "gt", "sample_id")


@query("out_of_fold_predictions", """with r as (select doc_id, quality, toxic,
    cast((row_number() over (order by md5(cast(doc_id as varchar) || '-5'), doc_id) - 1) % 2 as integer) as fold
    from labels join documents using (doc_id))
    select doc_id, 'quality' as part, quality as gt, fold, true as conf_valid from r
    union all select doc_id, 'toxic', toxic, fold, true from r""")
def _(v: Views):
    rows = v.two_label.withColumn("n_chars", F.col("n_chars").cast("double"))
    scored = out_of_fold(rows, ["quality", "toxic"], ["lang"], ["n_chars"], "doc_id", 2, 5, max_iter=3, max_depth=2)
    return scored.select("doc_id", "part", "gt", "fold", F.col("conf").between(0, 1).alias("conf_valid"))


@query("part_models", """with r as (select doc_id, quality, toxic, count(*) over (partition by quality) as n,
    row_number() over (partition by quality order by md5(cast(doc_id as varchar) || '-1'), doc_id) as place
    from labels join documents using (doc_id)), test as (select * from r where place <= round_even(0.2 * n, 0))
    select doc_id, 'quality' as part, quality as gt, true as conf_valid from test
    union all select doc_id, 'toxic', toxic, true from test""")
def _(v: Views):
    from labelloom.operators.models import fit_parts, predict_parts
    from labelloom.operators.sampling import split_stratified

    split = split_stratified(v.two_label.withColumn("n_chars", F.col("n_chars").cast("double")), "quality", "doc_id", 0.2, 1)
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    features, models = fit_parts(train, ["quality", "toxic"], ["lang"], ["n_chars"], 5, max_iter=3, max_depth=2)
    scored = predict_parts(test, features, models, "doc_id")
    return scored.select("doc_id", "part", "gt", F.col("conf").between(0, 1).alias("conf_valid"))
