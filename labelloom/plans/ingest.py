"""Source, sink and streaming queries. Files go below the shared folder the session names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.plans.registry import query
from labelloom.plans.views import Views, with_views
from labelloom.session import save_point, scratch_path
from labelloom.sources import archives, documents, tables
from labelloom.streaming import incremental

# Archive files that lie in one folder.
FOLDER_FILES = 10_000

_LINES_OF_GOOD = """select o.o_orderkey as "CaseID", lower(p_name) as "Description", l_extendedprice as "fVAL",
    lower(l_returnflag) as "DamageCond", l_linestatus as "CoType" from orders o join lineitem on o_orderkey = l_orderkey join part on l_partkey = p_partkey
    where o_orderkey % 50 <> 0"""


@query("flatten_case_rows", """select o_orderkey as "CaseID", o_orderpriority as "Vehicle_Type", o_orderstatus as "Claim_Type", 'm' as "Model",
    o_totalprice as "Gross_Offer_Insurer" from orders where o_orderkey % 50 <> 0""")
def _(v: Views):
    case = documents.flatten_cases(v.raw_json).case
    return case.select("CaseID", "Vehicle_Type", "Claim_Type", "Model", "Gross_Offer_Insurer")


@query("document_report", """select case when o_orderkey % 50 = 0 then 'rejected' else 'ok' end as outcome, count(*) as documents
    from orders group by 1""")
def _(v: Views):
    return documents.document_report(v.raw_json)


@query("flatten_part_rows", _LINES_OF_GOOD)
def _(v: Views):
    return documents.flatten_cases(v.raw_json).part


@query("flatten_file_rows", """select o_orderkey as "CaseID", o_orderkey as "iDOCID", strftime(o_orderdate, '%Y-%m-%d') as "FinalDate",
    o_orderstatus as "StdDocDesc" from orders where o_orderkey % 50 <> 0""")
def _(v: Views):
    return documents.flatten_cases(v.raw_json).file


@query("view_part_map", with_views("select distinct damage_cond as view, part from part_lines", "part_lines"))
def _(v: Views):
    sets = v.part_lines.groupBy("damage_cond").agg(F.collect_set("part").alias("parts"))
    entry = F.map_from_arrays(F.array("damage_cond"), F.array("parts"))
    return documents.explode_view_parts(sets.select(F.to_json(entry).alias("mapping")), "mapping")


@query("list_literals", """select vec_id, label, count(*) as n, round(sum(x), 5) as total from
    (select vec_id, label, unnest(embedding) as x from embeddings) group by all""")
def _(v: Views):
    text = v.table("embeddings").select(
        "vec_id", "label", F.to_json(F.col("embedding").cast("array<double>")).alias("literal")
    )
    flat = text.select("vec_id", "label", F.explode(documents.parse_list("literal")).alias("x"))
    return flat.groupBy("vec_id", "label").agg(F.count("*").alias("n"), F.round(F.sum("x"), 5).alias("total"))


@query("parquet_round_trip", with_views("""select vehicle_type, count(*) as n, round(sum(gross_offer), 1) as total from cases
    where vehicle_type in ('1-URGENT', '2-HIGH') group by vehicle_type""", "cases"))
def _(v: Views):
    path = scratch_path(v.spark, "cases")
    tables.write_table(v.cases, path, ["vehicle_type"])
    pruned = tables.read_table(
        v.spark, path, ["vehicle_type", "gross_offer"], F.col("vehicle_type").isin("1-URGENT", "2-HIGH")
    )
    return pruned.groupBy("vehicle_type").agg(F.count("*").alias("n"), F.round(F.sum("gross_offer"), 1).alias("total"))


@query("tagged_csv", with_views("""select part, view, count(*) as n, round(sum(conf), 4) as conf from
    (select part, cast(view as varchar) as view, conf from predictions where case_id % 9 <> 0) group by part, view""", "predictions"))
def _(v: Views):
    path = scratch_path(v.spark, "scores")
    named = v.predictions.select(
        F.when(F.col("case_id") % 9 != 0, F.col("case_id").cast("string")).alias("file"),
        "conf",
        F.concat_ws("_", F.lit("cv_pred"), "part", F.col("view").cast("string")).alias("run"),
    )
    tables.write_groups(named, path, ["run"])
    back = tables.read_tagged_csv(
        v.spark, f"{path}/*/*.csv", "file string, conf double", r"cv_pred_([A-Z]+)_(\d+)", ["part", "view"]
    )
    return back.groupBy("part", "view").agg(F.count("*").alias("n"), F.round(F.sum("conf"), 4).alias("conf"))


@query("ids_from_listing", "select distinct user_id * 100 + day(ts) as id from events")
def _(v: Views):
    keys = v.files.select(F.concat(F.lit("raw/"), "case_id", F.lit("_"), "doc_id", F.lit(".JPG")).alias("path"))
    return archives.ids_from_paths(keys, "path", r"/(\d+)_\d+\.JPG$")


@query("latest_artifacts", """select p_brand as model, split_part(p_brand, '#', 1) as part, arg_max(p_size, p_size * 1000000 + p_partkey) as epoch,
    round(arg_max(p_partkey % 100, p_size * 1000000 + p_partkey) / 100, 2) as acc from part group by p_brand""")
def _(v: Views):
    step = F.lpad(F.col("p_partkey").cast("string"), 9, "0")
    share = F.format_string("%.2f", (F.col("p_partkey") % 100) / 100)
    path = F.concat(
        F.lit("logs/"), "p_brand", F.lit("/checkpoints/epoch="), F.col("p_size").cast("string"),
        F.lit("-step="), step, F.lit("-e_acc="), share, F.lit(".ckpt"),
    )
    latest = archives.parse_artifacts(v.table("part").select(path.alias("path")))
    part, _ = archives.part_and_view(F.concat(F.replace("model", F.lit("#"), F.lit("_")), F.lit("_img_labels")))
    return latest.select("model", part.alias("part"), "epoch", "acc")


def _zipped(v: Views, folder: str | None = None) -> DataFrame:
    """One archive file per document with its text and its source as members, in folders of bounded size: (case_id, path)."""
    import io
    import zipfile

    import pyarrow as pa
    from pyarrow import fs

    folder = folder or scratch_path(v.spark, "zips")
    store, root = (fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:")))
    folders = -(-v.table("documents").count() // FOLDER_FILES) or 1
    for i in range(folders):
        store.create_dir(f"{root}/{i}")

    def pack(batches):
        for batch in batches:
            paths = []
            for doc_id, text, source in zip(*(batch.column(c) for c in ("doc_id", "text", "source"))):
                doc_id, packed = doc_id.as_py(), io.BytesIO()
                with zipfile.ZipFile(packed, "w") as archive:
                    archive.writestr("text.txt", text.as_py())
                    if doc_id is None or doc_id % 5:
                        archive.writestr("source.txt", source.as_py())
                name = f"{(doc_id or 0) % folders}/{doc_id}.zip"
                with store.open_output_stream(f"{root}/{name}") as file:
                    file.write(packed.getbuffer())
                paths.append(f"{folder}/{name}")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(paths, pa.string())], names=["case_id", "path"])

    docs = v.table("documents").select("doc_id", "text", "source")
    return save_point(docs.mapInArrow(pack, "case_id long, path string"))


def _manifest(v: Views) -> DataFrame:
    names = F.explode(F.array(F.lit("text.txt"), F.lit("source.txt")))
    return v.table("documents").select(F.col("doc_id").alias("case_id"), names.alias("member"))


@query("listed_ids", "select distinct doc_id as id from documents")
def _(v: Views):
    folder = scratch_path(v.spark, "zips")
    _zipped(v, folder)
    return archives.list_ids(v.spark, f"{folder}/*/*.zip", r"/(\d+)\.zip$")


@query("extract_members", """select doc_id as case_id, 'text.txt' as member, cast(strlen(text) as integer) as bytes from documents
    union all select doc_id, 'source.txt', cast(strlen(source) as integer) from documents where doc_id % 5 <> 0""")
def _(v: Views):
    extracted = archives.extract_from_files(_zipped(v), _manifest(v))
    return extracted.select("case_id", "member", F.octet_length("content").alias("bytes"))


@query("archive_completeness", "select doc_id as case_id, cast(2 as bigint) as wanted, cast(1 as bigint) as extracted from documents where doc_id % 5 = 0")
def _(v: Views):
    manifest = _manifest(v)
    return archives.archive_completeness(manifest, archives.extract_from_files(_zipped(v), manifest))


@query("member_directory", """select doc_id as case_id, 'text.txt' as member, cast(strlen(text) as bigint) as bytes from documents
    union all select doc_id, 'source.txt', cast(strlen(source) as bigint) from documents where doc_id % 5 <> 0""")
def _(v: Views):
    return archives.member_directory(_zipped(v)).select("case_id", "member", "bytes")


# --- streams: each runs over the whole table and stops when nothing is left ---

def _stream(v: Views, table: str) -> DataFrame:
    schema = v.table(table).schema
    path = f"{v.sf_dir}/{table}.parquet"
    # A file source takes folders; a table that is one file is picked out of the folder it stands in.
    single = v.table(table).select("_metadata.file_path").limit(1).first()
    if single is None or f"{table}.parquet/" in single[0]:
        return v.spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(path)
    return v.spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet").parquet(v.sf_dir)


@query("ingest_stream", f"""select 'part' as sink, "CaseID" as case_id, "Description" as a, "DamageCond" as b, "CoType" as c, "fVAL" as x
    from ({_LINES_OF_GOOD})
    union all select 'case', o_orderkey, o_orderpriority, o_orderstatus, 'm', o_totalprice from orders where o_orderkey % 50 <> 0
    union all select 'file', o_orderkey, strftime(o_orderdate, '%Y-%m-%d'), o_orderstatus, null, cast(o_orderkey as double)
    from orders where o_orderkey % 50 <> 0
    union all select 'quarantine', o_orderkey, 'rejected', 'ERR', null, null from orders where o_orderkey % 50 = 0""")
def _(v: Views):
    landing, sink = scratch_path(v.spark, "landing"), scratch_path(v.spark, "ingested")
    v.raw_json.write.parquet(landing)
    raw = v.spark.readStream.schema("doc string, files string").parquet(landing)
    incremental.ingest_stream(raw, sink, scratch_path(v.spark, "progress")).awaitTermination()
    columns = {
        "part": ("Description", "DamageCond", "CoType", "fVAL"), "case": ("Vehicle_Type", "Claim_Type", "Model", "Gross_Offer_Insurer"),
        "file": ("FinalDate", "StdDocDesc", None, "iDOCID"), "quarantine": ("outcome", "status", None, None),
    }

    def written(name: str) -> DataFrame:
        table = v.spark.read.parquet(f"{sink}/{name}")
        return table.select(F.lit(name).alias("sink"), F.col("CaseID").alias("case_id"), *[
            (F.lit(None) if source is None else F.col(source)).cast("double" if target == "x" else "string").alias(target)
            for source, target in zip(columns[name], "abcx", strict=True)])

    part, case, file, quarantine = (written(name) for name in columns)
    return part.unionByName(case).unionByName(file).unionByName(quarantine)


@query("first_photo_stream", with_views("""select case_id, view, doc_id, strftime(final_date, '%Y-%m-%d %H:%M:%S.%f') as taken from files
    qualify row_number() over (partition by case_id, view order by final_date, doc_id) = 1""", "files"))
def _(v: Views):
    events = _stream(v, "events").select(
        (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("case_id"),
        F.col("event_id").alias("doc_id"),
        F.col("event_type").alias("view"),
        F.col("ts").cast("timestamp").alias("final_date"),
    )
    sink = scratch_path(v.spark, "first")
    keys = ["case_id", "view"]
    incremental.first_per_stream(
        events, keys, ["final_date", "doc_id"], sink, scratch_path(v.spark, "progress")
    ).awaitTermination()
    first = incremental.read_first_per(v.spark, sink, keys)
    return first.select("case_id", "view", "doc_id", F.date_format("final_date", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("taken"))


@query("running_metrics_stream", """select strftime(time_bucket(interval 1 day, ts), '%Y-%m-%d') as day, event_type as part,
    count(*) filter (where g = 1 and p = 1) as tp, count(*) filter (where g = 0 and p = 0) as tn,
    count(*) filter (where g = 0 and p = 1) as fp, count(*) filter (where g = 1 and p = 0) as fn,
    round(count(*) filter (where g = p) / count(*), 6) as acc
    from (select ts, event_type, case when event_id % 3 = 0 then 1 else 0 end as g, case when value > 20 then 1 else 0 end as p from events)
    group by 1, 2""")
def _(v: Views):
    graded = _stream(v, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("part"),
        (F.col("event_id") % 3 == 0).cast("int").alias("gt"),
        (F.col("value") > 20).cast("int").alias("pred"),
    )
    sink = scratch_path(v.spark, "metrics")
    incremental.running_metrics(
        graded, "ts", "1 day", None, ["part"], sink, scratch_path(v.spark, "progress")
    ).awaitTermination()
    metrics = incremental.read_running_metrics(v.spark, sink, ["part"])
    return metrics.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "part", "tp", "tn", "fp", "fn", F.round("acc", 6).alias("acc")
    )


@query("late_rows_stream", """with e as (select event_type as part, ts, time_bucket(interval 1 day, ts) + interval 1 day as closes, event_id % 4 as arrival from events),
    m as (select arrival, max(ts) as latest from e group by 1),
    s as (select a.arrival, max(b.latest) as seen from m a left join m b on b.arrival < a.arrival group by 1)
    select part, count(*) filter (where not coalesce(closes <= seen - interval 7 day, false)) as counted,
        count(*) filter (where coalesce(closes <= seen - interval 7 day, false)) as late, count(*) as arrived
    from e join s using (arrival) group by 1""")
def _(v: Views):
    landing, sink, progress = (scratch_path(v.spark, name) for name in ("arrivals", "late", "progress"))
    events = v.table("events").select(
        F.col("event_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("part"),
        (F.col("event_id") % 3 == 0).cast("int").alias("gt"), (F.col("value") > 20).cast("int").alias("pred"))
    for arrival in range(4):  # files that come one after another, each with rows of all times
        events.filter(F.col("event_id") % 4 == arrival).write.mode("append").parquet(landing)
        stream = v.spark.readStream.schema(events.schema).parquet(landing)
        incremental.metrics_with_late_rows(stream, "ts", "1 day", "7 days", ["part"], sink, progress).awaitTermination()
    counted = incremental.read_counted(v.spark, sink, ["part"]).groupBy("part").agg(F.sum("rows").alias("counted"))
    late = v.spark.read.parquet(f"{sink}/late").groupBy("part").agg(F.count("*").alias("late"))
    arrived = v.table("events").groupBy(F.col("event_type").alias("part")).agg(F.count("*").alias("arrived"))
    return (arrived.join(counted, "part", "left").join(late, "part", "left")
            .select("part", F.coalesce("counted", F.lit(0)).alias("counted"), F.coalesce("late", F.lit(0)).alias("late"), "arrived"))
