"""Archives: opened and listed in tasks of bounded size."""

from __future__ import annotations

import re
import zipfile

import pytest

from labelloom.sources import archives


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_members_leave_tasks_in_batches_and_archives_are_dealt(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "ARCHIVES_PER_TASK", 2)
    paths = []
    for i in range(40):
        with zipfile.ZipFile(tmp_path / f"{i}.zip", "w") as archive:
            archive.writestr("a", f"text {i}")
        paths.append((i, f"{tmp_path}/{i}.zip"))
    files = spark.createDataFrame(paths, "case_id long, path string").coalesce(1)
    manifest = files.selectExpr("case_id", "'a' as member")
    got = archives.extract_from_files(files, manifest)
    assert got.rdd.getNumPartitions() == archives.member_directory(files).rdd.getNumPartitions() == 20
    assert {(r.case_id, bytes(r.content)) for r in got.collect()} == {(i, f"text {i}".encode()) for i in range(40)}
    assert archives.member_directory(files).count() == 40
    many = [b.num_rows for b in archives._batches(iter([(1, "a", b"x")] * 25_000), archives._MEMBER)]
    assert many == [10_000, 10_000, 5_000]
    large = [b.num_rows for b in archives._batches(iter([(1, "a", bytes(3 << 20))] * 3), archives._MEMBER)]
    assert large == [2, 1]


def test_paths_are_listed_in_tasks_as_spark_finds_them(spark, tmp_path):
    for name in ("a/1.zip", "a/2.txt", "b/3.zip", "b/_4.zip", "b/.5.zip", "c/d/6.zip", "c/_e/7.zip", "8.zip", "x=1/9.zip", "b/d.zip/10.zip"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    (tmp_path / "a" / "0.zip").write_bytes(b"")
    for glob in ("*/*.zip", "*", "[ab]/*", "[^a]/?.zip", "{a,b}/{1,3}.*", "b/3.zip", "c", "*/*/*.zip", "b/*.zip", "x=1/*", "c/*"):
        want = {r.path.removeprefix("file:") for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{tmp_path}/{glob}").select("path").collect()}
        for head in ("", "file:", "file://"):
            got = archives.list_paths(spark, f"{head}{tmp_path}/{glob}")
            assert sorted(re.sub("^file:(//)?", "", r.path) for r in got.collect()) == sorted(want), glob
    assert "FileScan" not in plan(archives.list_ids(spark, f"{tmp_path}/*/*.zip", r"(\d+)\.zip$"))
    with pytest.raises(FileNotFoundError):
        archives.list_paths(spark, f"{tmp_path}/none/*.zip")
