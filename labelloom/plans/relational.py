"""Scope, join, aggregate, window and set queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.functions import (
    case_from_path, clip, file_key, flag_gt, label_key, label_state, positive_labels,
    safe_ratio, sigmoid, strip_position,
)
from labelloom.operators import aggregates, expect, joins, labels, matching, ranking, scope, taxonomy
from labelloom.operators.evaluate import case_accuracy, ensemble_vote, part_metrics
from labelloom.operators.frontier import pareto_front
from labelloom.plans.registry import query
from labelloom.session import scratch_path, small_side
from labelloom.plans.views import ALL_PARTS, Views, given_label, per_case, with_views
from labelloom.sources import documents

CFG = scope.ScopeConfig(
    min_cost=20000.0,
    vehicle_class=2,
    claim_types=("O", "P"),
    excluded_circumstances=("reason 3", "reason 5"),
    undamaged=("r",),
    required_views=("click", "view", "purchase"),
)
FILE_SCOPE = """select case_id from files where view in ('click', 'view', 'purchase')
    group by case_id having count(distinct view) = 3"""
PART_SCOPE = "select * from part_lines where fval > 20000 and damage_cond <> 'r' and description <> '-'"


# --- projections, filters, rules ---

@query("pruned_scan", """select o_orderkey, o_totalprice from orders
    where o_orderpriority in ('1-URGENT', '5-LOW') and o_orderstatus = 'F'""")
def _(v: Views):
    where = F.col("o_orderpriority").isin("1-URGENT", "5-LOW") & (F.col("o_orderstatus") == "F")
    return v.table("orders").where(where).select("o_orderkey", "o_totalprice")


@query("select_columns", "select l_orderkey, l_partkey, l_linenumber from lineitem")
def _(v: Views):
    return scope.select_by(v.table("lineitem"), prefix="l_", regex="key$|number$", exclude=["l_suppkey"])


@query("scope_parts", with_views("select case_id, line, description, fval from scoped", "part_lines", scoped=PART_SCOPE))
def _(v: Views):
    return scope.scope_parts(v.part_lines, CFG).select("case_id", "line", "description", "fval")


@query("not_in_keeps_rows", with_views(
    "select case_id, vehicle_type from cases where circumstances not in ('reason 3', 'reason 5')", "cases"))
def _(v: Views):
    return v.cases.filter(scope.not_in(F.col("circumstances"), CFG.excluded_circumstances)).select("case_id", "vehicle_type")


@query("blacklist_terms", with_views(
    """select case_id, line, description from part_lines
       where not regexp_matches(description, 'widget|ring|anvil')""", "part_lines"))
def _(v: Views):
    kept = scope.remove_blacklisted(v.part_lines, "description", ["widget", "ring", "anvil"])
    return kept.select("case_id", "line", "description")


@query("null_ratio", """select round(avg(case when l_returnflag = 'R' then 1.0::double else 0 end), 6) as null_share,
    count(*) filter (where l_returnflag <> 'R') as rows_left,
    round(sum(case when l_returnflag = 'R' then 0 else l_quantity end), 2) as filled_sum from lineitem""")
def _(v: Views):
    holes = v.table("lineitem").select(F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).alias("q"))
    filled = holes.withColumn("filled", F.coalesce("q", F.lit(0.0)))
    return filled.agg(
        F.round(F.avg(F.col("q").isNull().cast("double")), 6).alias("null_share"),
        F.count("q").alias("rows_left"),
        F.round(F.sum("filled"), 2).alias("filled_sum"),
    )


@query("file_names", with_views("""select doc_id, cast(case_id as varchar) || '_' || cast(doc_id as varchar) || '.JPG'
    as filename, case_id as parsed from files""", "files"))
def _(v: Views):
    named = v.files.withColumn("filename", file_key(F.col("case_id"), F.col("doc_id")))
    path = F.concat(F.lit("/photos/by_day/"), "filename")
    return named.select("doc_id", "filename", case_from_path(path).alias("parsed"))


@query("remap_rules", with_views("""select case_id, line, case when description in ('red ring', 'blue bolt', 'old rod')
    then 'WHEEL' else part end as part from part_lines""", "part_lines"))
def _(v: Views):
    rules = v.spark.createDataFrame(
        [("red ring", "WHEEL"), ("blue bolt", "WHEEL"), ("old rod", "WHEEL")], "description string, part string"
    )
    return scope.apply_remap(v.part_lines, rules, "description", ["part"]).select("case_id", "line", "part")


@query("label_states", with_views("""select case_id, case when discount > 0.07 then 'x_N/A' when gt = 1 then 'x_dmg'
    else 'x_no_dmg' end as state, count(*) as n from graded group by all""", "graded"))
def _(v: Views):
    known = F.when(F.col("l_discount") <= 0.07, F.col("gt"))
    graded = v.table("lineitem").join(v.table("part"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("case_id"),
        "l_discount",
        given_label(F.col("l_orderkey"), F.col("p_type")).alias("gt"),
    )
    return graded.groupBy("case_id", label_state(known, "x").alias("state")).agg(F.count("*").alias("n"))


@query("threshold_flags", with_views("""select case_id, cast(sum(cast(conf > threshold as integer)) as bigint) as flagged,
    cast(sum(cast(conf > threshold as integer)) > 2 as integer) as many from predictions group by case_id""", "predictions"))
def _(v: Views):
    flagged = v.predictions.groupBy("case_id").agg(F.sum(flag_gt(F.col("conf"), F.col("threshold"))).alias("flagged"))
    return flagged.withColumn("many", flag_gt(F.col("flagged"), 2))


@query("part_funnel", with_views("""select 'low_cost' as rule, count(*) filter (where fval <= 20000) as rows from part_lines
    union all select 'no_cost', count(*) filter (where fval is null) from part_lines
    union all select 'condition', count(*) filter (where damage_cond = 'r') from part_lines
    union all select 'dash', count(*) filter (where description = '-') from part_lines
    union all select 'used', count(*) filter (where fval > 20000 and damage_cond <> 'r' and description <> '-') from part_lines
    union all select 'removed', count(*) filter (where not (fval > 20000 and damage_cond <> 'r' and description <> '-'))
    from part_lines""", "part_lines"))
def _(v: Views):
    return scope.part_funnel(v.part_lines, CFG)


_CASE_RULES = {
    "claim_type": "not regexp_matches(claim_type, 'O|P')",
    "vehicle_class": "vehicle_class <> 2",
    "circumstances": "circumstances in ('reason 3', 'reason 5')",
    "gross_offer": "gross_offer <= 0",
    "incomplete_views": "case_id not in (select case_id from complete)",
    "no_part_lines": "case_id not in (select case_id from scoped)",
}


@query("scope_funnel", with_views(
    " union all ".join(
        [f"select '{n}' as rule, count(*) filter (where {r}) as rows from cases" for n, r in _CASE_RULES.items()]
        + [f"select 'used', count(*) filter (where not ({' or '.join(_CASE_RULES.values())})) from cases",
           f"select 'removed', count(*) filter (where {' or '.join(_CASE_RULES.values())}) from cases"]),
    "cases", "part_lines", "files", complete=FILE_SCOPE, scoped=PART_SCOPE))
def _(v: Views):
    return scope.scope_funnel(v.cases, v.part_lines, v.files, CFG)


@query("scope_cases", with_views(
    f"select case_id, vehicle_type, gross_offer from cases where not ({' or '.join(_CASE_RULES.values())})",
    "cases", "part_lines", "files", complete=FILE_SCOPE, scoped=PART_SCOPE))
def _(v: Views):
    return scope.scope_cases(v.cases, v.part_lines, v.files, CFG).select("case_id", "vehicle_type", "gross_offer")


def _raw_cases(v: Views) -> DataFrame:
    """The case, part-line and photo views as raw documents and file listings."""
    line = F.struct(F.initcap("description").alias("Description"), F.col("fval").alias("fVAL"),
                    F.upper("damage_cond").alias("DamageCond"), F.lit("a").alias("CoType"))
    parts = v.part_lines.groupBy("case_id").agg(F.collect_list(line).alias("parts"))
    photo = F.struct(F.col("doc_id").alias("iDOCID"), F.col("final_date").cast("string").alias("FinalDate"),
                     F.col("view").alias("StdDocDesc"))
    photos = v.files.groupBy("case_id").agg(F.to_json(F.collect_list(photo)).alias("files"))
    main = F.struct(
        F.col("case_id").alias("CaseID"), F.col("vehicle_class").alias("Vehicle_Class"), F.col("vehicle_type").alias("Vehicle_Type"),
        F.col("gross_offer").alias("Gross_Offer_Insurer"), F.col("circumstances").alias("Circumstances_of_Accident"),
        F.col("claim_type").alias("Claim_Type"), F.col("model").alias("Model"))
    data = F.struct(F.struct(main.alias("main"), F.struct("parts").alias("est_details")).alias("data"))
    joined = v.cases.join(parts, "case_id", "left").join(photos, "case_id", "left")
    return joined.select(F.to_json(F.struct(F.lit("OK").alias("status"), data.alias("data"))).alias("doc"), "files")


@query("raw_to_scope", with_views(
    f"select case_id, vehicle_type, gross_offer from cases where not ({' or '.join(_CASE_RULES.values())})",
    "cases", "part_lines", "files", complete=FILE_SCOPE, scoped=PART_SCOPE))
def _(v: Views):
    landing, folder = scratch_path(v.spark, "raw"), scratch_path(v.spark, "scoped")
    _raw_cases(v).write.parquet(landing)
    parsed = documents.flatten_cases(v.spark.read.parquet(landing), keep=scratch_path(v.spark, "parsed"))
    named = documents.scope_names(parsed)
    scope.write_scoped(scope.scoped_tables(*named, CFG), folder)
    return v.spark.read.parquet(f"{folder}/case").select("case_id", "vehicle_type", "gross_offer")


# --- joins and sets ---

@query("case_lines_join", with_views("""select c.case_id, c.model, p.line, p.part from cases c
    join part_lines p on c.case_id = p.case_id""", "cases", "part_lines"))
def _(v: Views):
    return v.cases.join(v.part_lines, "case_id").select("case_id", "model", "line", "part")


@query("taxonomy_lookup", with_views("""select p.case_id, p.line, t.lvl_3 from part_lines p
    join taxonomy t on p.description = t.lvl_1""", "part_lines",
    taxonomy="select lower(p_name) as lvl_1, arg_min(p_type, p_partkey) as lvl_3 from part group by 1"))
def _(v: Views):
    levels = v.table("part").groupBy(F.lower("p_name").alias("lvl_1")).agg(F.min_by("p_type", "p_partkey").alias("lvl_3"))
    lines = v.part_lines.select("case_id", "line", "description")
    return lines.join(small_side(levels), F.col("description") == F.col("lvl_1")).select("case_id", "line", "lvl_3")


@query("attach_photos", with_views("""select c.case_id, f.photos from cases c
    left join (select case_id, count(*) as photos from files group by case_id) f on c.case_id = f.case_id""", "cases", "files"))
def _(v: Views):
    photos = v.files.groupBy("case_id").agg(F.count("*").alias("photos"))
    return v.cases.select("case_id").join(photos, "case_id", "left")


@query("outer_chain", with_views("""select part, coalesce(big, 0) as big, coalesce(cheap, 0) as cheap, coalesce(late, 0) as late
    from (select part, count(*) as big from part_lines where quantity > 49 and fval > 90000 group by part)
    full join (select part, count(*) as cheap from part_lines where fval < 1000 group by part) using (part)
    full join (select part, count(*) as late from part_lines where ship_date >= timestamp '2001-12-01' group by part) using (part)""",
    "part_lines"))
def _(v: Views):
    def tally(condition, name):
        return v.part_lines.filter(condition).groupBy("part").agg(F.count("*").alias(name))
    frames = {
        "big": tally("quantity > 49 and fval > 90000", "big"),
        "cheap": tally("fval < 1000", "cheap"),
        "late": tally("ship_date >= timestamp '2001-12-01'", "late"),
    }
    return joins.outer_chain(frames, "part")


@query("cases_with_photos", with_views("select case_id, model from cases where case_id in (select case_id from files)", "cases", "files"))
def _(v: Views):
    return v.cases.join(joins.ids_of(v.files, "case_id"), "case_id", "left_semi").select("case_id", "model")


@query("work_list", with_views("""select case_id from cases where case_id not in (select case_id from files)
    and case_id not in (select case_id from part_lines where fval > 90000)""", "cases", "files", "part_lines"))
def _(v: Views):
    return joins.work_list(v.cases, v.files, v.part_lines.filter("fval > 90000"), key="case_id")


@query("assemble_wide", with_views(f"""select case_id,
    {', '.join(f"max(conf) filter (where part = '{p}') as \"vision_{p}\"" for p in ALL_PARTS)} from case_predictions group by case_id
    having count(distinct part) = {len(ALL_PARTS)}""", "case_predictions"))
def _(v: Views):
    return joins.assemble_wide(per_case(v.by_case(v.predictions)), ["case_id"], "part", "conf", ALL_PARTS, prefix="vision_")


@query("complete_views", with_views(FILE_SCOPE, "files"))
def _(v: Views):
    return aggregates.complete_views(v.files, CFG.required_views)


@query("prefer_unseen", with_views("""select a.case_id, a.part, a.view, case when b.conf is null then a.conf else b.conf end as conf,
    case when b.conf is null then 0 else 1 end as replaced
    from (select case_id, part, view, max(conf) as conf from predictions group by all) a
    left join (select case_id, part, view, min(conf) / 2 as conf from predictions where case_id % 3 = 0 group by all) b
    on a.case_id = b.case_id and a.part = b.part and a.view = b.view""", "predictions"))
def _(v: Views):
    keys = ["case_id", "part", "view"]
    seen = v.predictions.groupBy(*keys).agg(F.max("conf").alias("conf"))
    unseen = v.predictions.filter("case_id % 3 = 0").groupBy(*keys).agg((F.min("conf") / 2).alias("conf"))
    return joins.prefer(seen, unseen, keys, ["conf"])


_COUNTS_SQL = """with recursive counts as (select lower(p_name) as text, count(*) as n from part group by 1),
majors as (select text, n from counts where n > (select count(*) from counts) * 0.55),
minors as (select text, n from counts where not n > (select count(*) from counts) * 0.55)"""

_LCS_SQL = _COUNTS_SQL + """,
pairs as (select a.text as a, b.text as b, b.n as b_n,
    list_sort(list_distinct(string_split(a.text, ' '))) as ta, list_sort(list_distinct(string_split(b.text, ' '))) as tb
    from minors a cross join majors b),
sides as (select a, b, b_n, list_filter(ta, lambda x: list_contains(tb, x)) as both_,
    list_filter(ta, lambda x: not list_contains(tb, x)) as only_a, list_filter(tb, lambda x: not list_contains(ta, x)) as only_b from pairs),
texts as (select a, b, b_n, len(both_) as n_both, len(only_a) as n_a, len(only_b) as n_b,
    coalesce(array_to_string(both_, ' '), '') as s, coalesce(array_to_string(only_a, ' '), '') as x,
    coalesce(array_to_string(only_b, ' '), '') as y from sides),
dp as (
  select a, b, x, y, 0 as i, list_transform(range(length(y) + 1), lambda k: 0) as d from texts
  union all
  select a, b, x, y, i + 1, list_transform(range(length(y) + 1), lambda j: list_max(list_transform(range(j + 1), lambda k:
      case when k > 0 and y[k] = x[i + 1] then d[k] + 1 else d[k + 1] end))) from dp where i < length(x)),
lcs as (select a, b, d[-1] as l from dp where i = length(x)),
scored as (select t.a, t.b, t.b_n, case when n_both > 0 and (n_a = 0 or n_b = 0) then 100.0::double else greatest(
    100.0::double - 100.0::double * (length(x) + length(y) - 2 * l) / (2 * (length(s) + (n_both > 0)::int) + length(x) + length(y)),
    case when n_both > 0 then 100.0::double - 100.0::double * (1 + length(x)) / (2 * length(s) + 1 + length(x)) else 0 end,
    case when n_both > 0 then 100.0::double - 100.0::double * (1 + length(y)) / (2 * length(s) + 1 + length(y)) else 0 end) end as score
    from texts t join lcs using (a, b)),
best as (select a, b, score from scored where score >= 60
    qualify row_number() over (partition by a order by score desc, b_n desc, b) = 1),
mapping as (select text, text as match, 100.0::double as score from majors
    union all select m.text, coalesce(best.b, 'none'), best.score from minors m left join best on m.text = best.a)
"""


@query("fuzzy_vocabulary", _LCS_SQL + "select text, match, round(score, 6) as score from mapping")
def _(v: Views):
    counts = v.table("part").groupBy(F.lower("p_name").alias("text")).agg(F.count("*").alias("count"))
    return matching.fuzzy_matches(counts, 55, 60).select("text", "match", F.round("score", 6).alias("score"))


@query("fuzzy_group_rows", _LCS_SQL + """select p_partkey, lower(p_name) as description, match as fuzzy_match
    from part join mapping on lower(p_name) = text""")
def _(v: Views):
    parts = v.table("part").select("p_partkey", F.lower("p_name").alias("description"))
    return matching.fuzzy_group(parts, "description", 55, 60)


_LINE_COUNTS_SQL = """with recursive part_lines as (select l_orderkey as case_id, l_linenumber as line, lower(p_name) as description,
    lower(l_returnflag) as damage_cond from lineitem join part on l_partkey = p_partkey),
counts as (select description as text, count(*) as n from part_lines group by 1),
majors as (select text, n from counts where n > (select count(*) from counts) * 14.5),
minors as (select text, n from counts where not n > (select count(*) from counts) * 14.5)"""


@query("part_labels", _LCS_SQL.replace(_COUNTS_SQL, _LINE_COUNTS_SQL) + """, taxonomy as (select lower(p_name) as lvl_1,
    arg_min(p_brand, p_partkey) as lvl_2, arg_min(p_type, p_partkey) as lvl_3 from part group by 1)
    select case_id, line, match as lvl_1_desc, case when description = 'red ring' then 'WHEEL' else lvl_2 end as lvl_2_desc,
    case when description = 'red ring' then 'WHEEL' else lvl_3 end as lvl_3_desc
    from part_lines join mapping on description = text join taxonomy on match = lvl_1
    where damage_cond <> 'r' and not regexp_matches(description, 'small b|large .i') and not contains(description, 'anvil')""")
def _(v: Views):
    levels = v.table("part").groupBy(F.lower("p_name").alias("lvl_1_desc")).agg(
        F.min_by("p_brand", "p_partkey").alias("lvl_2_desc"), F.min_by("p_type", "p_partkey").alias("lvl_3_desc")
    )
    rules = v.spark.createDataFrame(
        [("red ring", "WHEEL", "WHEEL")], "description string, lvl_2_desc string, lvl_3_desc string"
    )
    cases = v.table("orders").select(F.col("o_orderkey").alias("case_id"))
    lines = v.part_lines.select("case_id", "line", "description", "damage_cond")
    labelled = taxonomy.part_labels(
        lines, cases, levels, rules, 1450, 60,
        condition_terms=["r"], description_terms=["small b", "large .i"], component_terms=["anvil"],
    )
    return labelled.select("case_id", "line", "lvl_1_desc", "lvl_2_desc", "lvl_3_desc")


@query("sentinel_lookup", with_views("""select c.case_id, c.part, coalesce(v.conf, -1) as conf from labels_long c
    left join (select * from case_predictions where part in ('LARGE', 'PROMO')) v on c.case_id = v.case_id and c.part = v.part""",
    "labels_long", "case_predictions"))
def _(v: Views):
    seen = v.case_predictions.filter(F.col("part").isin("LARGE", "PROMO"))
    return joins.lookup_or(v.labels_by_part.select("case_id", "part"), seen, ["case_id", "part"], "conf", F.lit(-1.0))


@query("photo_coverage", with_views("""select count(f.case_id) as available, count(*) - count(f.case_id) as not_available,
    round(count(f.case_id) / count(*), 6) as ratio from (select distinct case_id from cases) c
    left join (select distinct case_id from files) f using (case_id)""", "cases", "files"))
def _(v: Views):
    return aggregates.coverage(v.cases, v.files, "case_id").withColumn("ratio", F.round("ratio", 6))


@query("union_by_name", """select o_orderkey as id, o_totalprice as amount, null as name from orders
    union all select c_custkey, c_acctbal, c_name from customer""")
def _(v: Views):
    orders = v.table("orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))
    customers = v.table("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"), F.col("c_name").alias("name")
    )
    return joins.union_all(orders, customers)


@query("common_ids", with_views("select case_id from cases intersect select case_id from files", "cases", "files"))
def _(v: Views):
    return joins.common_ids(v.cases, v.files, "case_id")


@query("without_ids", with_views("select case_id from cases except select case_id from files", "cases", "files"))
def _(v: Views):
    return joins.without_ids(v.cases, v.files, "case_id")


@query("expect_disjoint", with_views("""select 'disjoint_case_id' as "check", count(*) as failed_rows
    from (select case_id from cases intersect select case_id from files)""", "cases", "files"))
def _(v: Views):
    return expect.expect_disjoint(v.cases, v.files, "case_id")


@query("expectations", with_views("""select 'unique_case_id_view' as "check", count(*) as failed_rows from
    (select case_id, view from files group by all having count(*) > 1)
    union all select 'unique_case_id', count(*) from (select case_id from cases group by all having count(*) > 1)
    union all select 'min_prob', count(*) from class_probs where not list_max(probs) >= 0.5
    union all select 'positive_cost', count(*) from part_lines where not fval > 1000
    union all select 'tpr_fnr_sum', 0
    union all select 'same_keys', count(*) from (select coalesce(a.case_id, b.case_id) from
        (select distinct case_id from cases) a full join (select distinct case_id from part_lines) b on a.case_id = b.case_id
        where a.case_id is null or b.case_id is null)
    union all select 'equal_lengths', count(*) from epoch_logits where len(logits) <> 10""",
    "files", "cases", "class_probs", "part_lines", "epoch_logits"))
def _(v: Views):
    lengths = v.epoch_logits.withColumn("names", F.sequence(F.lit(1), F.lit(10)))
    return joins.union_all(
        expect.expect_unique(v.files, ["case_id", "view"]),
        expect.expect_unique(v.cases, ["case_id"]),
        expect.expect_min_prob(v.class_probs, "probs"),
        expect.expect_that(v.part_lines, "positive_cost", F.col("fval") > 1000),
        expect.expect_rates_sum(part_metrics(ensemble_vote(v.predictions, v.labels, v.parts))),
        expect.expect_same_keys(v.cases, v.part_lines.select("case_id").distinct(), ["case_id"]),
        expect.expect_equal_lengths(lengths, ["logits", "names"]),
    )


# --- aggregates ---

@query("count_by", with_views("select part, damage_cond, count(*) as count from part_lines group by all", "part_lines"))
def _(v: Views):
    return aggregates.count_by(v.part_lines, ["part", "damage_cond"])


@query("level_sums", with_views("""select part, cast(sum(n) as bigint) as count, count(*) as descriptions from
    (select part, description, count(*) as n from part_lines group by all) group by part""", "part_lines"))
def _(v: Views):
    sizes = v.part_lines.groupBy("part", "description").agg(F.count("*").alias("n"))
    return sizes.groupBy("part").agg(F.sum("n").alias("count"), F.count("*").alias("descriptions"))


@query("view_counts", with_views("""select n_views, count(*) as cases from
    (select case_id, count(distinct view) as n_views from files group by case_id) group by n_views""", "files"))
def _(v: Views):
    return aggregates.view_counts(v.files).groupBy("n_views").agg(F.count("*").alias("cases"))


@query("pivot_mean", with_views("""select case_id, """ + ", ".join(
    f"""round(avg(conf) filter (where part = '{p}'), 6) as "{p}" """
    for p in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")) + " from predictions group by case_id", "predictions"))
def _(v: Views):
    wide = labels.pivot_mean(v.predictions, "case_id", "part", "conf", v.parts)
    return wide.select("case_id", *[F.round(p, 6).alias(p) for p in v.parts])


@query("value_coverage", with_views("""select
    round(sum(case when fval > 20000 and damage_cond <> 'r' then fval end) / sum(fval), 6) as value_share,
    round(avg(case when fval is null then 1.0::double else 0 end), 6) as null_share,
    count(*) filter (where fval > 20000 and damage_cond <> 'r') as used,
    count(*) filter (where not (fval > 20000 and damage_cond <> 'r')) as removed from part_lines""", "part_lines"))
def _(v: Views):
    kept = (F.col("fval") > 20000) & (F.col("damage_cond") != "r")
    shares = aggregates.coverage_sum(v.part_lines, "fval", kept)
    return shares.withColumns({c: F.round(c, 6) for c in ("value_share", "null_share")})


@query("first_value_per", with_views("""select case_id, arg_min(part, line * 1000000 + fval) as part,
    arg_min(description, line * 1000000 + fval) filter (where damage_cond <> 'r') as description
    from part_lines group by case_id""", "part_lines"))
def _(v: Views):
    masked = v.part_lines.select(
        "case_id",
        "part",
        F.when(F.col("damage_cond") != "r", F.col("description")).alias("description"),
        (F.col("line") * 1000000 + F.col("fval")).alias("at"),
    )
    return aggregates.first_value_per(masked, ["case_id"], ["part", "description"], "at")


@query("mode_per", with_views("""select case_id, max(part) as mode from
    (select case_id, part, count(*) as n, max(count(*)) over (partition by case_id) as top from part_lines group by case_id, part)
    where n = top group by case_id""", "part_lines"))
def _(v: Views):
    return aggregates.mode_per(v.part_lines, ["case_id"], "part")


@query("quantiles", with_views("""select cast(unnest([0.1, 0.25, 0.6, 0.75, 0.8]) as double) as prob,
    round(unnest([quantile_cont(fval, 0.1), quantile_cont(fval, 0.25), quantile_cont(fval, 0.6), quantile_cont(fval, 0.75),
    quantile_cont(fval, 0.8)]), 6) as quantile from part_lines""", "part_lines"))
def _(v: Views):
    found = ranking.exact_quantile(v.part_lines, "fval", [0.1, 0.25, 0.6, 0.75, 0.8])
    return found.withColumn("quantile", F.round("quantile", 6))


@query("distinct_values", with_views("""select count(distinct description) as descriptions, count(distinct part) as parts,
    count(distinct case_id) as cases from part_lines""", "part_lines"))
def _(v: Views):
    return v.part_lines.agg(
        F.count_distinct("description").alias("descriptions"),
        F.count_distinct("part").alias("parts"),
        F.count_distinct("case_id").alias("cases"),
    )


@query("distinct_rows", with_views("select distinct part, damage_cond from part_lines", "part_lines"))
def _(v: Views):
    return v.part_lines.select("part", "damage_cond").distinct()


@query("cost_histogram", with_views("""select least(cast(floor((fval - 0) / (110000 - 0) * 20) as integer), 19) as bin,
    count(*) as count from part_lines where fval between 0 and 110000 group by 1""", "part_lines"))
def _(v: Views):
    return aggregates.histogram(v.part_lines, "fval", 20, 0.0, 110000.0)


@query("label_balance", with_views("""select cast(view as integer) as view, part, count(*) as rows, cast(sum(gt) as bigint) as positives,
    round(sum(gt) / count(*), 6) as ratio from (select p.case_id % 4 as view, p.part, p.gt from labels_long p) group by all""",
    "labels_long"))
def _(v: Views):
    wide = v.wide_labels.withColumn("view", (F.col("case_id") % 4).cast("int"))
    return aggregates.label_balance(wide, v.parts, ["view"]).withColumn("ratio", F.round("ratio", 6))


# --- windows, top-k, order ---

@query("first_photo", with_views("""select case_id, view, doc_id, strftime(final_date, '%Y-%m-%d %H:%M:%S.%f') as taken from files
    qualify row_number() over (partition by case_id, view order by final_date, doc_id) = 1""", "files"))
def _(v: Views):
    first = ranking.first_per(v.files, ["case_id", "view"], [F.col("final_date"), F.col("doc_id")])
    return first.select("case_id", "view", "doc_id", F.date_format("final_date", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("taken"))


@query("top_lines_per_part", with_views("""select part, case_id, line, fval, rank from (select *, cast(row_number() over
    (partition by part order by fval desc, case_id, line) as integer) as rank from part_lines) where rank <= 200""", "part_lines"))
def _(v: Views):
    order = [F.desc("fval"), F.col("case_id"), F.col("line")]
    return ranking.top_n_per(v.part_lines, ["part"], order, 200).select("part", "case_id", "line", "fval", "rank")


@query("keep_top_groups", with_views("""select case_id, line, description from part_lines where description in
    (select description from part_lines group by 1 order by count(*) desc, description limit 15)""", "part_lines"))
def _(v: Views):
    return ranking.keep_top_groups(v.part_lines, "description", 15).select("case_id", "line", "description")


@query("dedup_lines", with_views("""select case_id, part, line, fval from part_lines
    qualify row_number() over (partition by case_id, part order by line, fval) = 1""", "part_lines"))
def _(v: Views):
    kept = ranking.dedup(v.part_lines, ["case_id", "part"], [F.col("line"), F.col("fval")])
    return kept.select("case_id", "part", "line", "fval")


@query("top_cases", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 100")
def _(v: Views):
    ranked = v.table("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return ranked.limit(100)


@query("running_mean", with_views("""select case_id, rank, round(running_mean, 6) as running_mean from
    (select case_id, row_number() over (order by case_id) as rank,
    avg(correct) over (order by case_id rows unbounded preceding) as running_mean from
    (select case_id, sum(cast(gt = pred as integer)) as correct from decisions group by case_id)) where rank % 50 = 0""", "decisions"))
def _(v: Views):
    accuracy = case_accuracy(ensemble_vote(v.predictions, v.labels, v.parts))
    means = ranking.running_mean(accuracy, "case_id", "correct", every=50)
    return means.withColumn("running_mean", F.round("running_mean", 6))


@query("pareto_front", """with t as (select s_suppkey, s_acctbal as balance, cast(-s_nationkey as double) as nation,
    cast(s_suppkey % 7 as double) as slot from supplier)
    select s_suppkey, balance, nation, slot from t a where not exists (select 1 from t b where b.balance >= a.balance
    and b.nation >= a.nation and b.slot >= a.slot and (b.balance > a.balance or b.nation > a.nation or b.slot > a.slot))""")
def _(v: Views):
    trials = v.table("supplier").select(
        "s_suppkey",
        F.col("s_acctbal").alias("balance"),
        (-F.col("s_nationkey")).alias("nation"),
        (F.col("s_suppkey") % 7).alias("slot"),
    )
    return pareto_front(trials, "s_suppkey", ["balance", "nation", "slot"])


# --- scalar functions ---

@query("text_functions", """select p_partkey, trim(replace(replace(replace(replace(replace(lower(t), 'lh', ''), 'rh', ''),
    'right', ''), 'left', ''), 'upper', '')) as stripped, contains(lower(p_name), 'ring') as has_ring,
    upper(trim(replace(p_name, ' ', '_'))) as joined
    from (select *, p_name || ' Front LH upper' as t from part)""")
def _(v: Views):
    described = F.concat("p_name", F.lit(" Front LH upper"))
    return v.table("part").select(
        "p_partkey",
        strip_position(described).alias("stripped"),
        F.lower("p_name").contains("ring").alias("has_ring"),
        F.upper(F.trim(F.replace("p_name", F.lit(" "), F.lit("_")))).alias("joined"),
    )


@query("parsed_dates", """select cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month, count(*) as n
    from orders group by all""")
def _(v: Views):
    text = v.table("orders").select(F.date_format("o_orderdate", "dd/MM/yyyy HH:mm").alias("written"))
    parsed = F.to_timestamp("written", "dd/MM/yyyy HH:mm")
    return text.groupBy(F.year(parsed).alias("year"), F.month(parsed).alias("month")).agg(F.count("*").alias("n"))


@query("json_path", """select cast(json_extract_string(props, '$.k') as integer) as k, count(*) as n, round(sum(value), 2) as total
    from events group by 1""")
def _(v: Views):
    k = F.get_json_object("props", "$.k").cast("int")
    return v.table("events").groupBy(k.alias("k")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("scalar_math", """select c_custkey, case when c_nationkey = 0 then null else round(c_acctbal / c_nationkey, 6) end as ratio,
    least(greatest(c_acctbal, 0), 5000) as clipped, round(1 / (1 + exp(-c_acctbal / 1000)), 6) as squashed from customer""")
def _(v: Views):
    return v.table("customer").select(
        "c_custkey",
        F.round(safe_ratio(F.col("c_acctbal"), F.col("c_nationkey")), 6).alias("ratio"),
        clip(F.col("c_acctbal"), 0.0, 5000.0).alias("clipped"),
        F.round(sigmoid(F.col("c_acctbal") / 1000), 6).alias("squashed"),
    )


@query("label_texts", with_views("""select case_id, string_agg(cast(gt as varchar), '' order by part) as bits,
    coalesce(string_agg(case when gt = 1 then part end, ',' order by part), '') as positives
    from labels_long group by case_id""", "labels_long"))
def _(v: Views):
    return v.wide_labels.select(
        "case_id", label_key(v.parts).alias("bits"), F.array_join(positive_labels(v.parts), ",").alias("positives")
    )
