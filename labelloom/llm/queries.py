"""Registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op3_ngram_jaccard_join")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelloom.llm.jaccard import jaccard_classes

    return jaccard_classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op5_exact_dedup", """
with d as (select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz')) as text_sha256 from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept,
       text_sha256
from d window w as (partition by text_sha256)""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelloom.llm.exact import exact_groups

    return exact_groups(table(spark, sf_dir, "documents"))


@query("op6_quality_classifier")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelloom.llm.quality import quality_scores

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_sharding")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelloom.llm.shards import shard_rows

    return shard_rows(table(spark, sf_dir, "documents"))


@query("op9_benchmark_decontamination", """
with i as (select distinct item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w
           from benchmark),
s as (select row_number() over () as item, item_id, w, least(5, len(w)) as k from i where len(w) > 0),
x as (select item, item_id, k, unnest(list_distinct(list_transform(range(1, len(w) - k + 2), lambda a: array_to_string(w[a:a + k - 1], ' '))))
      as run from s),
n as (select item, count(*) as n_item from x group by 1),
d as (select row_number() over () as doc, doc_id,
      list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w from documents),
r as (select doc, doc_id, k, unnest(list_distinct(list_transform(range(1, len(w) - k + 2), lambda a: array_to_string(w[a:a + k - 1], ' '))))
      as run from d, (select distinct k from s) where len(w) >= k),
m as (select doc, doc_id, item, item_id, count(*) as n_shared from r join x using (k, run) group by all)
select doc_id, item_id, n_item, max(n_shared) as n_shared, max(n_shared) / n_item as containment
from m join n using (item) where n_shared * 100 >= n_item * 75 group by doc_id, item_id, n_item""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelloom.llm.leaks import leaks

    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_target_mixture")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelloom.llm.mixture import mixture

    return mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_line_dedup", """
with l as (
    select doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos,
           unnest(string_split(coalesce(text, ''), chr(10))) as line
    from documents),
k as (select *, translate(regexp_replace(line, '^[ \\t\\n\\x0B\\f\\r]+|[ \\t\\n\\x0B\\f\\r]+$', '', 'g'),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
r as (select key, max(doc_id) as last_id from k where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
m as (select k.*, r.key is not null and k.doc_id <> r.last_id as gone from k left join r using (key))
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from m group by doc_id""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from labelloom.llm.lines import dedup_lines

    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_language_model")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelloom.llm.language import language_scores

    return language_scores(table(spark, sf_dir, "documents"))


@query("op1_html_extraction")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelloom.llm.html import extract

    return extract(table(spark, sf_dir, "pages"))


@query("op10_warc_index", """
with p as (select page_id, url, octet_length(encode(coalesce(html, ''))) as bytes, sha256(coalesce(html, '')) as digest from pages),
f as (select digest, min(page_id) as first_id from p where bytes >= 100 group by 1 having count(*) > 1 and min(page_id) is not null),
u as (select *, regexp_extract(url, '^[^:/?#]+://(?:[^/?#]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)(?:[?]([^#]*))?', ['host', 'path', 'query']) as x
      from p left join f using (digest)),
k as (select *, case when x.host like 'www.%' then substr(lower(x.host), 5) else lower(x.host) end as host from u)
select page_id, url, array_to_string(list_reverse(string_split(host, '.')), ',') || ')' ||
       case when x.path = '' then '/' else lower(x.path) end || case when x.query = '' then '' else '?' || lower(x.query) end as url_key,
       strftime(make_timestamp(((coalesce(page_id, 0) % 253402300800 + 253402300800) % 253402300800) * 1000000), '%Y-%m-%dT%H:%M:%SZ')
       as capture_time, bytes as payload_bytes, digest as payload_digest,
       case when first_id is null or page_id = first_id then 'response' else 'revisit' end as record_type,
       case when page_id <> first_id then first_id end as refers_to
from k""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelloom.llm.warc import archive_round_trip

    return archive_round_trip(table(spark, sf_dir, "pages"))


def _rounds_sql(table: str, first: str, rounds: int, key: str, on: str) -> str:
    """Common table expressions of exact k-means in SQL: `a<i>` are assignments, `c<i>` centres, c0 given by `first`.

    `key` are the columns that tell a row of `table` (which has the list `v`), `on` the column that centres share with it.
    """
    steps, using, both = [f"c0 as materialized ({first})"], f"using ({on})" if on else "on true", f"{on}, " if on else ""
    for i in range(rounds + 1):
        steps.append(f"""a{i} as materialized (
    select {key}, x.v, arg_min(c.g, struct_pack(d := list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), g := c.g)) as g,
           min(list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) as d
    from {table} x join c{i} c {using} group by {key}, x.v)""")
        if i < rounds:
            steps.append(f"""m{i} as materialized (
    select {both}g, list(m order by p) as v from (
        select {both}g, p, cast(floor(sum(x) / count(*)) as bigint) as m
        from (select {both}g, unnest(v) as x, generate_subscripts(v, 1) as p from a{i}) group by {both}g, p)
    group by {both}g),
c{i + 1} as materialized (select {', '.join(f'c.{c}' for c in (on, 'g') if c)}, coalesce(m.v, c.v) as v from c{i} c left join m{i} m using ({both}g))""")
    return ",\n".join(steps)


_STEPS = "list_transform(embedding, lambda x: cast(floor({scale} * cast(x as double)) as bigint)) as v"
_COMPLETE = ("embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0")


@query("op11_centroid_clustering", f"""
with recursive e as materialized (
    select vec_id, {_STEPS.format(scale=256)} from embeddings where len(embedding) = 64 and {_COMPLETE}),
{_rounds_sql('e', '''
    select row_number() over (order by sha256('2:' || coalesce(cast(vec_id as varchar), '')), v) - 1 as g, v from e
    qualify row_number() over (order by sha256('2:' || coalesce(cast(vec_id as varchar), '')), v) <= 40''', 5, 'vec_id', '')}
select a.vec_id, cast(a.g as integer) as cluster, cast(a.d as bigint) as distance,
       cast(sum(a.d) over (partition by a.g) as bigint) as cluster_inertia, cast(sum(a.d) over () as bigint) as inertia,
       sha256(array_to_string(c.v, ',')) as centroid_sha256
from a5 a join c5 c using (g)""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelloom.llm.clusters import clusters

    return clusters(table(spark, sf_dir, "embeddings"))


# The rules of the query, by host and path.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query("op12_url_filters", """
with u as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
h as (select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                'abcdefghijklmnopqrstuvwxyz') as host,
             regexp_extract(substr(rest, length(regexp_extract(rest, '^([^/?#]*)', 1)) + 1), '^([^?#]*)', 1) as path from u),
r(rule_host, rule_path, action) as (
    values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow'))
select page_id, host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
       coalesce(arg_max(action, length(rule_host || rule_path)), 'allow') as verdict
from h left join r on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
group by page_id, host, path""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelloom.llm.urls import judge_urls

    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


@query("op13_vector_codes", f"""
with recursive e as materialized (
    select vec_id, label, {_STEPS.format(scale=4096)} from embeddings where {_COMPLETE}),
q(part) as (select * from range(8)),
x as materialized (select vec_id, label, part, list_slice(v, part * len(v) // 8 + 1, (part + 1) * len(v) // 8) as v from e, q),
f as (select vec_id, v, row_number() over (order by vec_id, v) - 1 as g from e qualify row_number() over (order by vec_id, v) <= 16),
{_rounds_sql('x', 'select x.part, f.g, x.v from f join x using (vec_id)', 6, 'vec_id, x.part, x.label', 'part')},
t as (select vec_id, label, string_agg(format('{{:02x}}', g), '' order by part) as code, cast(sum(d) as bigint) as error
      from a6 group by vec_id, label)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
       (select sha256(string_agg(array_to_string(v, ','), ',' order by part, g)) from c6) as codebooks_sha256
from t""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelloom.llm.codes import codes

    return codes(table(spark, sf_dir, "embeddings"))
