"""Sampling, split, fold and balancing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelloom.operators import sampling
from labelloom.operators.aggregates import label_balance
from labelloom.plans.registry import query
from labelloom.plans.views import Views, with_views

PARTS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
WIDE_SQL = "select case_id, model, " + ", ".join(
    f"""max(gt) filter (where part = '{p}') as "{p}" """ for p in PARTS
) + """ from labels_long join (select o_orderkey as case_id, o_orderpriority as model from orders) using (case_id)
    group by case_id, model"""
COMBO_SQL = " || ".join(f"""cast("{p}" as varchar)""" for p in PARTS)


def _md5(column: str, seed: int) -> str:
    return f"md5(concat(cast({column} as varchar), '-', '{seed}'))"


@query("sample_rows", f"select o_orderkey, o_totalprice from orders order by {_md5('o_orderkey', 7)}, o_orderkey limit 2500")
def _(v: Views):
    return sampling.sample_n(v.table("orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 2500, 7)


@query("sample_per_class", f"""select o_orderkey, o_orderstatus from orders qualify row_number() over
    (partition by o_orderstatus order by {_md5('o_orderkey', 7)}, o_orderkey) <= 1200""")
def _(v: Views):
    orders = v.table("orders").select("o_orderkey", "o_orderstatus")
    return sampling.sample_n_per(orders, ["o_orderstatus"], "o_orderkey", 1200, 7)


@query("sample_share_per_class", f"""select o_orderkey, o_orderpriority from (select *, row_number() over
    (partition by o_orderpriority order by {_md5('o_orderkey', 3)}, o_orderkey) as rn,
    count(*) over (partition by o_orderpriority) as n from orders) where rn <= round_even(0.15::double * n, 0)""")
def _(v: Views):
    orders = v.table("orders").select("o_orderkey", "o_orderpriority")
    return sampling.sample_frac_per(orders, ["o_orderpriority"], "o_orderkey", 0.15, 3)


@query("balance_down", f"""select o_orderkey, o_orderstatus from (select *, row_number() over
    (partition by o_orderstatus order by {_md5('o_orderkey', 5)}, o_orderkey) as rn from orders)
    where rn <= (select min(n) from (select count(*) as n from orders group by o_orderstatus))""")
def _(v: Views):
    orders = v.table("orders").select("o_orderkey", "o_orderstatus")
    return sampling.balance_down(orders, "o_orderstatus", "o_orderkey", 5)


@query("sample_ids", with_views(f"""select case_id from (select distinct case_id from files)
    order by {_md5('case_id', 1)}, case_id limit 1500""", "files"))
def _(v: Views):
    return sampling.sample_ids_topped(v.files, "case_id", 1500, 1)


@query("balance_pool", with_views(f"""select distinct case_id from (select * from labels_long where gt = 1
    and part in ('LARGE', 'PROMO', 'SMALL') qualify row_number() over
    (partition by part order by {_md5('case_id', 9)}, case_id) <= 1500)""", "labels_long"))
def _(v: Views):
    return sampling.balance_pool(v.label_grid, ["LARGE", "PROMO", "SMALL"], 1500, 9)


@query("stratified_split", f"""select vec_id, label, case when rn <= round_even(0.2::double * n, 0) then 'test' else 'train' end as split
    from (select *, row_number() over (partition by label order by {_md5('vec_id', 11)}, vec_id) as rn,
    count(*) over (partition by label) as n from embeddings)""")
def _(v: Views):
    vectors = v.table("embeddings").select("vec_id", "label")
    return sampling.split_stratified(vectors, "label", "vec_id", 0.2, 11)


@query("kfold", f"""select o_orderkey, cast((row_number() over (order by {_md5('o_orderkey', 2)}, o_orderkey) - 1) % 5 as integer) as fold
    from orders""")
def _(v: Views):
    return sampling.kfold(v.table("orders").select("o_orderkey"), 5, "o_orderkey", 2)


@query("kfold_stratified", f"""select o_orderkey, o_orderpriority, cast((row_number() over
    (partition by o_orderpriority order by {_md5('o_orderkey', 2)}, o_orderkey) - 1) % 2 as integer) as fold from orders""")
def _(v: Views):
    orders = v.table("orders").select("o_orderkey", "o_orderpriority")
    return sampling.kfold(orders, 2, "o_orderkey", 2, ["o_orderpriority"])


@query("kfold_multilabel", with_views(f"""select case_id, cast((row_number() over
    (partition by stratum order by {_md5('case_id', 4)}, case_id) - 1) % 3 as integer) as fold from
    (select case_id, case when count(*) over (partition by combo) >= 3 then combo else 'rare:' || coalesce((
        select part from part_totals t join labels_long l using (part) where l.case_id = c.case_id and l.gt = 1
        order by t.n, part limit 1), '') end as stratum from combos c)""", "labels_long",
    combos=f"select case_id, {COMBO_SQL} as combo from ({WIDE_SQL})",
    part_totals="select part, sum(gt) as n from labels_long group by part"))
def _(v: Views):
    folded = sampling.kfold_multilabel(v.wide_labels, v.parts, 3, "case_id", 4)
    return folded.select("case_id", "fold")


@query("fold_balance", f"""with folds as (select o_orderkey as case_id, cast((row_number() over
    (order by {_md5('o_orderkey', 2)}, o_orderkey) - 1) % 2 as integer) as fold from orders),
    parts as (select distinct p_type as part from part)
    select fold, part, count(*) as rows, cast(sum(gt) as bigint) as positives, round(sum(gt) / count(*), 4) as ratio from
    (select fold, part, case when (case_id * 7 + length(part) * 3) % 11 < length(part) - 3 then 1 else 0 end as gt
     from folds cross join parts) group by all""")
def _(v: Views):
    folded = sampling.kfold(v.wide_labels, 2, "case_id", 2)
    return label_balance(folded, v.parts, ["fold"]).withColumn("ratio", F.round("ratio", 4))


@query("label_combos", with_views(f"select {COMBO_SQL} as combo, count(*) as rows from ({WIDE_SQL}) group by 1", "labels_long"))
def _(v: Views):
    return sampling.label_combos(v.wide_labels, v.parts)


_SEEN = with_views(
    f"""select {COMBO_SQL} as combo, case_id from (select case_id, """ + ", ".join(
        f"""max(case when part = '{p}' then 1 else 0 end) as "{p}" """ for p in PARTS)
    + " from part_lines group by case_id)", "part_lines")


@query("drop_rare_combos", _SEEN + " qualify count(*) over (partition by combo) > 200")
def _(v: Views):
    kept = sampling.drop_rare_combos(v.observed.select("case_id", *v.parts), v.parts, 200)
    return kept.select("case_id", F.concat_ws("", *v.parts).alias("combo"))


@query("oversample", with_views("""select case_id, cast(unnest(range(1 + 2 * cast(extra as bigint))) as integer) as copy from
    (select case_id, sum(case when scarce then gt else 0 end) as extra from
     (select case_id, part, gt, avg(cast(gt as double)) over (partition by part) < 0.2 as scarce from labels_long) group by case_id)""",
    "labels_long"))
def _(v: Views):
    return sampling.oversample(v.wide_labels, v.parts).select("case_id", "copy")


@query("holdout", with_views("""select case_id, model, 'rest' as side from cases where case_id not in (select case_id from files)
    union all select case_id, model, 'held out' from cases where case_id in (select case_id from files)""", "cases", "files"))
def _(v: Views):
    rest, held = sampling.holdout(v.cases.select("case_id", "model"), v.files, "case_id")
    return rest.withColumn("side", F.lit("rest")).unionByName(held.withColumn("side", F.lit("held out")))


@query("eval_train_split", f"""with lines as (select o_orderkey as id, o_custkey as owner, o_orderpriority as model from orders),
    eval as (select * from lines order by {_md5('id', 6)}, id limit 500),
    others as (select * from lines where owner not in (select owner from eval)),
    capped as (select * from others qualify row_number() over (partition by model order by {_md5('id', 6)}, id) <= 700),
    train as (select * from capped order by {_md5('id', 6)}, id limit 3000)
    select id, model, 'eval' as side from eval union all select id, model, 'train' from train""")
def _(v: Views):
    rows = v.table("orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("owner"), F.col("o_orderpriority").alias("model")
    )
    train, evaluation = sampling.split_eval_train(rows, "id", "owner", "model", 500, 700, 3000, 6)
    sides = evaluation.withColumn("side", F.lit("eval")).unionByName(train.withColumn("side", F.lit("train")))
    return sides.select("id", "model", "side")


@query("common_model_sample", f"""with lines as (select o_orderkey as id, o_orderstatus as label, c_name as model
    from orders join customer on o_custkey = c_custkey),
    top as (select model from lines group by model order by count(*) desc, model limit 150)
    select id, label, model from lines where model in (select model from top)
    qualify row_number() over (partition by label, model order by {_md5('id', 8)}, id) <= 5""")
def _(v: Views):
    rows = v.table("orders").join(v.table("customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("label"), F.col("c_name").alias("model")
    )
    return sampling.sample_common_models(rows, "label", "model", "id", 150, 5, 8)


@query("class_weights", with_views("""select lang, count(*) as count, round(sum(count(*)) over () / (count(*) over () * count(*)), 6) as weight
    from two_label group by lang""", "two_label"))
def _(v: Views):
    return sampling.class_weights(v.two_label, "lang").withColumn("weight", F.round("weight", 6))


@query("weighted_rows", with_views("""select doc_id, toxic, round(n / (k * own), 6) as weight from (select doc_id, toxic, count(*) over () as n,
    count(*) over (partition by toxic) as own, (select count(distinct toxic) from two_label) as k from two_label)""", "two_label"))
def _(v: Views):
    weighted = sampling.with_class_weights(v.two_label.select("doc_id", "toxic"), "toxic")
    return weighted.withColumn("weight", F.round("weight", 6))


@query("pos_weights", with_views("""select 'quality' as part, round(sum(1 - quality) / sum(quality), 6) as pos_weight from two_label
    union all select 'toxic', round(sum(1 - toxic) / sum(toxic), 6) from two_label""", "two_label"))
def _(v: Views):
    return sampling.pos_weights(v.two_label, ["quality", "toxic"]).withColumn("pos_weight", F.round("pos_weight", 6))


@query("id_batches", with_views(f"""select case_id, cast(floor((row_number() over (order by {_md5('case_id', 0)}, case_id) - 1) / 1000) as bigint)
    as batch_id from cases""", "cases"))
def _(v: Views):
    return sampling.id_batches(v.cases, "case_id", 1000, 0)


@query("split_overlap", """select o_custkey, cast(2 as bigint) as frames from
    (select o_custkey from orders where o_orderstatus = 'F' intersect select o_custkey from orders where o_orderstatus = 'O')""")
def _(v: Views):
    orders = v.table("orders")
    return sampling.all_disjoint([orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderstatus = 'O'")], "o_custkey")
