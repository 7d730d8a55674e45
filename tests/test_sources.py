"""Files in and out, archives, documents and streams."""

from __future__ import annotations

import datetime
import io
import json
import random
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from labelloom import session
from labelloom.sources import archives, documents, tables
from labelloom.streaming import incremental


def test_tagged_csv(spark, rows, tmp_path):
    (tmp_path / "cv_pred_Saloon - 4 Dr_front_view.csv").write_text("Unnamed: 0,file,conf,parts\n0,1_2.JPG,0.5,a\n1,,0.4,b\n")
    (tmp_path / "cv_pred_Saloon - 4 Dr_rear_view.csv").write_text("file,parts,conf\n3_4.JPG,b,0.25\n")
    got = tables.read_tagged_csv(
        spark, f"{tmp_path}/cv_pred_*.csv", "file string, parts string, conf double",
        r"cv_pred_(.+?)_((?:front|rear)_view)\.csv", ["type", "view"])
    assert rows(got) == [("1_2.JPG", "a", 0.5, "Saloon - 4 Dr", "front_view"), ("3_4.JPG", "b", 0.25, "Saloon - 4 Dr", "rear_view")]


def test_tagged_csv_keeps_headers_of_large_files(spark, tmp_path):
    lines = "\n".join(f"{i},{i}_1.JPG,0.5" for i in range(3000))
    (tmp_path / "cv_pred_a.csv").write_text(f"Unnamed: 0,file,conf\n{lines}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = tables.read_tagged_csv(spark, f"{tmp_path}/*.csv", "file string, conf double", r"cv_pred_(\w+)\.csv", ["view"])
        assert got.filter("file like '%_1.JPG' and conf = 0.5 and view = 'a'").count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_partitioned_round_trip_prunes(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, kind string")
    tables.write_table(df, f"{tmp_path}/t", ["kind"])
    back = tables.read_table(spark, f"{tmp_path}/t", ["id"], F.col("kind") == "a")
    assert rows(back) == [(1,)]
    assert "PartitionFilters: [isnotnull(kind" in back._jdf.queryExecution().executedPlan().toString()


def test_list_ids(spark, rows, tmp_path):
    for name in ("10_1.JPG", "10_2.JPG", "11_1.JPG", "notes.txt"):
        (tmp_path / name).write_bytes(b"x")
    assert rows(archives.list_ids(spark, f"{tmp_path}/*", r"/(\d+)_\d+\.JPG$")) == [(10,), (11,)]


def test_artifacts_keep_latest(spark):
    paths = [("x/m1/checkpoints/epoch=2-e_acc=0.90-e_tp=0.8.ckpt",), ("x/m1/checkpoints/epoch=10-e_acc=0.85--e_tn=0.75.ckpt",)]
    row = archives.parse_artifacts(spark.createDataFrame(paths, "path string")).first()
    assert (row.model, row.epoch, row.acc, row.tpr, row.tnr) == ("m1", 10, 0.85, None, 0.75)


def test_model_names(spark):
    df = spark.createDataFrame([("bumper_front_Front View_img_labels", "Rear View_tail_lamp_lh")], "a string, b string")
    part, view = archives.part_and_view(F.col("a"))
    other_part, other_view = archives.part_and_view(F.col("b"), view_first=True)
    assert tuple(df.select(part, view, other_part, other_view).first()) == ("bumper_front", "Front View", "tail_lamp_lh", "Rear View")


def _zip(**members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for name, text in members.items():
            archive.writestr(name, text)
    return buffer.getvalue()


def test_archives_with_missing_member_and_damage(spark, rows):
    data = [(1, bytearray(_zip(a="one", b="two"))), (2, bytearray(_zip(a="three"))), (3, bytearray(b"no zip"))]
    zips = spark.createDataFrame(data, "case_id long, content binary")
    manifest = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (3, "a")], "case_id long, member string")
    got = archives.extract_members(zips, manifest)
    assert rows(got.select("case_id", "member", F.col("content").cast("string"))) == [(1, "a", "one"), (2, "a", "three")]
    assert rows(archives.archive_completeness(manifest, got)) == [(2, 2, 1), (3, 1, 0)]


def _doc(case_id, status="OK", parts=()):
    return json.dumps({"status": status, "data": {"data": {"main": {"CaseID": case_id}, "est_details": {"parts": list(parts)}}}})


def test_flatten_skips_bad_documents(spark, rows):
    raw = spark.createDataFrame([
        (_doc(1, parts=[{"Description": "x", "fVAL": 1.5}]), json.dumps([{"iDOCID": 9}])),
        (_doc(2, status="ERR", parts=[{"Description": "y"}]), None),
        ("{broken", None),
        (_doc(3), None),
    ], "doc string, files string")
    case, part, file = documents.flatten_cases(raw)
    assert rows(case, "CaseID") == [(1,), (3,)]
    assert rows(part) == [(1, "x", 1.5, None, None)]
    assert rows(file, "CaseID", "iDOCID") == [(1, 9)]


def test_json_map_and_list_literals(spark, rows):
    df = spark.createDataFrame([('{"front": ["a", "b"], "rear": ["a", "a"]}', "['x', 'y']")], "m string, l string")
    assert rows(documents.explode_view_parts(df, "m")) == [("front", "a"), ("front", "b"), ("rear", "a")]
    assert df.select(documents.parse_list("l", "string")).first()[0] == ["x", "y"]


def test_ingest_stream_flushes_everything_once(spark, tmp_path):
    schema = "doc string, files string"
    source, sink, progress = (f"{tmp_path}/{n}" for n in ("in", "out", "cp"))

    def arrive(ids):
        docs = [(_doc(i, parts=[{"Description": "d"}]), None) for i in ids]
        spark.createDataFrame(docs, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        incremental.ingest_stream(stream, sink, progress).awaitTermination()

    arrive(range(7))
    arrive(range(7, 10))
    assert sorted(r.CaseID for r in spark.read.parquet(f"{sink}/part").collect()) == list(range(10))


def test_first_per_stream_accepts_late_rows(spark, rows, tmp_path):
    schema = "case_id long, view string, at long, doc long"
    source, sink, progress = (f"{tmp_path}/{n}" for n in ("in", "out", "cp"))
    for batch in ([(1, "f", 50, 5), (2, "f", 70, 7)], [(1, "f", 10, 1), (2, "f", 90, 9)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        incremental.first_per_stream(stream, ["case_id", "view"], ["at", "doc"], sink, progress).awaitTermination()
    assert rows(incremental.read_first_per(spark, sink, ["case_id", "view"])) == [(1, "f", 10, 1), (2, "f", 70, 7)]


def test_running_metrics_stream_continues(spark, tmp_path):
    schema = "ts timestamp, part string, gt int, pred int"
    source, sink, progress = (f"{tmp_path}/{n}" for n in ("in", "out", "cp"))
    day = "2024-01-01 0{}:00:00"
    for hour, pairs in ((1, [(1, 1), (1, 0)]), (2, [(0, 0), (1, 1)])):
        data = spark.createDataFrame([(day.format(hour), "p", g, p) for g, p in pairs], "t string, part string, gt int, pred int")
        data.select(F.to_timestamp("t").alias("ts"), "part", "gt", "pred").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        incremental.running_metrics(stream, "ts", "1 day", "1 day", ["part"], sink, progress).awaitTermination()
    row = incremental.read_running_metrics(spark, sink, ["part"]).first()
    assert (row.tp, row.tn, row.fp, row.fn, row.acc) == (2, 1, 0, 1, 0.75)


def test_shared_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://somewhere"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})

    with pytest.raises(ValueError):
        session.shared_folder(Session())


def test_damaged_member_spares_the_others(spark, rows):
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_STORED) as archive:
        archive.writestr("good.jpg", b"good bytes")
        archive.writestr("bad.jpg", b"bad bytes")
    raw = bytearray(packed.getvalue())
    at = raw.index(b"bad bytes")
    raw[at] ^= 0xFF
    given = spark.createDataFrame([(1, bytearray(raw)), (2, bytearray(b"no zip"))], "case_id long, content binary")
    manifest = spark.createDataFrame([(1, "good.jpg"), (1, "bad.jpg"), (1, "absent.jpg"), (2, "x")], "case_id long, member string")
    got = archives.extract_members(given, manifest)
    assert [(r["case_id"], r["member"], bytes(r["content"])) for r in got.collect()] == [(1, "good.jpg", b"good bytes")]
    assert rows(archives.archive_completeness(manifest, got)) == [(1, 3, 1), (2, 1, 0)]


def test_document_report(spark, rows):
    raw = spark.createDataFrame([(_doc(1), None), (_doc(2, status="ERR"), None), ("{broken", None), (None, None)],
                                "doc string, files string")
    assert rows(documents.document_report(raw)) == [("ok", 1), ("rejected", 1), ("unreadable", 2)]


def test_members_of_archive_files(spark, rows, tmp_path):
    (tmp_path / "1.zip").write_bytes(_zip(a="one", b="two" * 1000))
    (tmp_path / "2.zip").write_bytes(_zip(a="three"))
    (tmp_path / "3.zip").write_bytes(b"no zip")
    files = spark.createDataFrame([(1, f"{tmp_path}/1.zip"), (2, f"file://{tmp_path}/2.zip"), (3, f"file:{tmp_path}/3.zip"), (4, f"{tmp_path}/4.zip")],
                                  "case_id long, path string")
    manifest = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b"), (3, "a"), (4, "a"), (5, "a")], "case_id long, member string")
    got = archives.extract_from_files(files, manifest)
    assert rows(got.select("case_id", "member", F.col("content").cast("string"))) == [(1, "a", "one"), (2, "a", "three")]
    assert rows(archives.member_directory(files), "case_id", "member", "bytes") == [(1, "a", 3), (1, "b", 3000), (2, "a", 5)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan[plan.index("Exchange"):]  # names and paths are shuffled, contents are not


def test_only_wanted_ranges_of_an_archive_are_read(tmp_path):
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_STORED) as archive:
        for i in range(50):
            archive.writestr(f"{i}.bin", bytes(200_000))
    read = 0

    class Counted(io.FileIO):
        def read(self, size=-1):
            nonlocal read
            data = super().read(size)
            read += len(data)
            return data

    with Counted(str(tmp_path / "big.zip")) as file:
        assert [(name, len(data)) for name, data in archives._members(file, {"7.bin", "none"})] == [("7.bin", 200_000)]
    assert read < 400_000


def test_ingest_keeps_bad_documents_and_replays_without_repeats(spark, rows, tmp_path):
    schema = "doc string, files string"
    source, sink, progress = (f"{tmp_path}/{n}" for n in ("in", "out", "cp"))
    docs = [(_doc(1, parts=[{"Description": "d", "CoType": "x"}]), '[{"iDOCID": 4, "StdDocDesc": "front"}]'), (_doc(2, status="ERR"), None),
            ("{broken", None), (None, None)]
    spark.createDataFrame(docs, schema).coalesce(1).write.parquet(source)

    def run():
        incremental.ingest_stream(spark.readStream.schema(schema).parquet(source), sink, progress).awaitTermination()
        bad = spark.read.parquet(f"{sink}/quarantine")
        assert Counter(tuple(r) for r in bad.select("CaseID", "status", "outcome", "doc").collect()) == Counter(
            [(2, "ERR", "rejected", docs[1][0]), (None, None, "unreadable", "{broken"), (None, None, "unreadable", None)])
        assert [spark.read.parquet(f"{sink}/{name}").count() for name in ("case", "part", "file")] == [1, 1, 1]

    run()
    for commit in (tmp_path / "cp" / "commits").iterdir():  # the batch was written, but not marked as done
        commit.unlink()
    run()


def test_counted_and_late_rows_are_the_input(spark, tmp_path):
    source, sink, progress = (f"{tmp_path}/{n}" for n in ("in", "out", "cp"))
    schema = "id int, ts timestamp, part string, gt int, pred int"
    rng = random.Random(6)
    start = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
    want_late, want, latest, total = set(), Counter(), None, 0
    for batch in range(5):
        given = [(batch * 100 + i, start + datetime.timedelta(hours=rng.randrange(0, 24 * 6 * (batch + 1))), rng.choice("pq"), rng.randrange(2), 1)
                 for i in range(40)] + [(batch * 100 + 99, None, "p", 1, 1)]
        spark.createDataFrame(given, schema).coalesce(1).write.mode("append").parquet(source)
        for i, at, part, gt, _ in given:
            closes = at and at.replace(hour=0) + datetime.timedelta(days=1)
            if at is None or (latest and closes <= latest - datetime.timedelta(days=2)):
                want_late.add(i)
            else:
                want[at.replace(hour=0, tzinfo=None), part, "tp" if gt else "fp"] += 1
        total += len(given)
        latest = max(filter(None, [latest, *(g[1] for g in given)]))

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    incremental.metrics_with_late_rows(stream, "ts", "1 day", "2 days", ["part"], sink, progress).awaitTermination()
    late = spark.read.parquet(f"{sink}/late")
    assert {r.id for r in late.collect()} == want_late and len(want_late) > 10
    counted = incremental.read_counted(spark, sink, ["part"]).collect()
    assert sum(r["rows"] for r in counted) + late.count() == total
    got = Counter({(r.window_start, r.part, c): r[c] for r in counted for c in ("tp", "fp") if r[c]})
    assert got == want
