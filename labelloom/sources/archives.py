"""Object listings, artifact names and zip archives."""

from __future__ import annotations

import io
import lzma
import os
import re
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.session import save_point, small_side, spread

# Archives that one task opens, folders that one task lists, and bounds of a batch of rows that a task passes on.
ARCHIVES_PER_TASK = 5_000
FOLDERS_PER_TASK = 4
BATCH_ROWS = 10_000
BATCH_BYTES = 4 << 20
_MEMBER = pa.schema([("case_id", pa.int64()), ("member", pa.string()), ("content", pa.binary())])

def list_ids(spark: SparkSession, glob: str, regex: str) -> DataFrame:
    """Distinct ids parsed from the names of the objects under a glob; contents are not read."""
    return ids_from_paths(list_paths(spark, glob), "path", regex)


def list_paths(spark: SparkSession, glob: str) -> DataFrame:
    """(path) of the files under a glob, as Spark's readers find them: hidden and empty ones are left out, and folders that
    match are read to their ends. Nothing found is an error.

    Tasks list the folders level by level, each folder in one task, so that no name passes the driver.
    """
    head = re.match(r"[a-z][a-z0-9+.-]*:(//[^/]*)?|", glob)[0]
    levels = (glob[len(head):] if head else os.path.abspath(glob)).strip("/").split("/")
    first = next((i for i, level in enumerate(levels) if re.search(r"[*?\[{\\]", level)), len(levels) - 1)
    found = spark.createDataFrame([("/".join([head, *levels[:first]]),)], "path string")
    for level in levels[first:-1]:
        found = _dealt(_listed(found, level, folders=True), FOLDERS_PER_TASK)
    found = _listed(found, levels[-1])
    if not found.take(1):
        raise FileNotFoundError(f"nothing matches {glob}")
    return found


def _listed(within: DataFrame, level: str, folders: bool = False) -> DataFrame:
    """The folders, or else the files, (path) that fit one level of a glob below the folders (path)."""
    fits = re.compile(_level_regex(level))

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str]]:
        for path in (p for batch in batches for p in batch.column("path").to_pylist()):
            store, name = _store(path)
            for entry in store.get_file_info(fs.FileSelector(name or "/", allow_not_found=True)):
                own = f"{path}/{entry.base_name}"
                if not fits.fullmatch(entry.base_name):
                    continue
                if folders or entry.type == fs.FileType.File:
                    if entry.type == fs.FileType.Directory or not folders and entry.size and _shown(entry.base_name):
                        yield (own,)
                else:
                    for below in store.get_file_info(fs.FileSelector(entry.path, recursive=True)):
                        rest = below.path[len(entry.path):]
                        if below.type == fs.FileType.File and below.size and all(map(_shown, rest.strip("/").split("/"))):
                            yield (own + rest,)

    schema = pa.schema([("path", pa.string())])
    return within.mapInArrow(lambda batches: _batches(paths(batches), schema), "path string")


def _shown(name: str) -> bool:
    """Spark's readers pass over other names."""
    return not (name.startswith(".") or name.startswith("_") and "=" not in name)


def _level_regex(level: str) -> str:
    """One level of a glob with `*`, `?`, `[a-c]`, `[^a]` and `{a,b}` as a regular expression."""
    parts = re.findall(r"\\.|\[[^]]*\]|.", level)
    deep, out = 0, []
    for part in parts:
        deep += (part == "{") - (part == "}")
        if part[0] == "[" and len(part) > 1:
            out.append(f"[{'^' if part[1] in '^!' else ''}{re.sub(r'([\\[])', r'\\\1', part[1:-1].lstrip('^!'))}]")
        elif part in ("{", "}") or part == "," and deep:
            out.append({"{": "(?:", "}": ")", ",": "|"}[part])
        else:
            out.append({"*": ".*", "?": "."}.get(part) or re.escape(part[-1]))
    return "".join(out)


def _dealt(df: DataFrame, share: int) -> DataFrame:
    """A small table whose rows each stand for much work, saved and dealt evenly to tasks of `share` rows."""
    saved = save_point(df)
    return spread(saved, saved.count(), share=share)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in Arrow batches of about `BATCH_ROWS` rows or `BATCH_BYTES` of values; one row may be longer."""
    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)

    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, (bytes, str)))
        if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def ids_from_paths(paths: DataFrame, column: str, regex: str) -> DataFrame:
    """Distinct ids from a table of object names."""
    found = F.regexp_extract(F.col(column), regex, 1).try_cast("long")
    return paths.select(found.alias("id")).filter(F.col("id").isNotNull()).distinct()


def parse_artifacts(df: DataFrame, path: str = "path") -> DataFrame:
    """Model folder and the epoch and metrics written into checkpoint names, latest file per model.

    A path ends like `<model>/checkpoints/epoch=4-e_acc=0.94-e_tp=0.93--e_tn=0.95.ckpt`; what a name
    does not mention is null. The latest file has the highest epoch, then the last name.
    """
    text = F.col(path)

    def number(name: str):
        return F.regexp_extract(text, rf"(?<![A-Za-z]){name}=([0-9]+(?:\.[0-9]+)?)", 1).try_cast("double")

    parsed = df.select(
        F.regexp_extract(text, r"([^/]+)/checkpoints/[^/]+$", 1).alias("model"),
        text.alias("path"),
        number("epoch").cast("int").alias("epoch"),
        number("acc").alias("acc"),
        number("tp").alias("tpr"),
        number("tn").alias("tnr"),
    )
    latest = F.max_by(F.struct("path", "epoch", "acc", "tpr", "tnr"), F.struct("epoch", "path"))
    return parsed.groupBy("model").agg(latest.alias("last")).select("model", "last.*")


def part_and_view(name: Column, view_first: bool = False) -> tuple[Column, Column]:
    """Part and view of a model name: `<part>_<view>_img_labels`, or `<view>_<part>`."""
    bare = F.regexp_replace(name, "_img_labels$", "")
    if view_first:
        return F.regexp_extract(bare, "^[^_]*_(.*)$", 1), F.regexp_extract(bare, "^([^_]*)_", 1)
    return F.regexp_extract(bare, "^(.*)_[^_]*$", 1), F.regexp_extract(bare, "_([^_]*)$", 1)


def extract_members(archives: DataFrame, manifest: DataFrame) -> DataFrame:
    """Named members of per-case zip archives held as bytes: (case_id, member, content).

    `archives` is (case_id, content) and `manifest` is (case_id, member). The wanted names travel
    with the archive as one array, so an archive is opened once; a manifest of small size goes to
    the archives, so that contents stay where they were read. Archives that the tasks can open
    themselves are better read by `extract_from_files`. Absent members and unreadable
    archives or members (damaged, encrypted, packed in an unknown way) yield nothing and take no other
    member with them; `archive_completeness` reports them. Members are passed on in small batches.
    """
    wanted = manifest.groupBy("case_id").agg(F.collect_set("member").alias("members"))
    jobs = archives.select("case_id", "content").join(small_side(wanted), "case_id")

    def unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for case_id, content, members in _rows(batches, "case_id", "content", "members"):
            for name, data in _members(io.BytesIO(content), set(members)):
                yield case_id, name, data

    return jobs.mapInArrow(lambda batches: _batches(unzip(batches), _MEMBER), "case_id long, member string, content binary")


def _rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Rows of Arrow batches, one at a time."""
    for batch in batches:
        for values in zip(*(batch.column(c) for c in columns)):
            yield tuple(v.as_py() for v in values)


# Damage and unknown packing. Errors of the storage itself are not among them: they fail the task, which Spark repeats.
_UNREADABLE = (zipfile.BadZipFile, zlib.error, lzma.LZMAError, EOFError, RuntimeError, NotImplementedError, pa.ArrowInvalid)


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The shared storage that a URI or local path points to, and the name there."""
    if "://" not in path:
        return fs.LocalFileSystem(), path.removeprefix("file:")
    if path == "file://":
        return fs.LocalFileSystem(), "/"
    return fs.FileSystem.from_uri(path)


def _open(path: str):
    """A file of the shared storage for reads at any place, by its URI or local path."""
    store, name = _store(path)
    return store.open_input_file(name)


def member_directory(archives: DataFrame) -> DataFrame:
    """(case_id, path, member, bytes, packed_bytes) of the archives (case_id, path), from their central directories alone.

    Archives that are absent or have no readable directory yield nothing.
    """
    schema = pa.schema([("case_id", pa.int64()), ("path", pa.string()), ("member", pa.string()),
                        ("bytes", pa.int64()), ("packed_bytes", pa.int64())])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for case_id, path in _rows(batches, "case_id", "path"):
            try:
                with _open(path) as file, zipfile.ZipFile(file) as archive:
                    found = [(case_id, path, m.filename, m.file_size, m.compress_size) for m in archive.infolist()]
            except (*_UNREADABLE, FileNotFoundError):
                continue
            yield from found

    return _dealt(archives.select("case_id", "path"), ARCHIVES_PER_TASK).mapInArrow(
        lambda batches: _batches(listed(batches), schema),
        "case_id long, path string, member string, bytes long, packed_bytes long")


def extract_from_files(archives: DataFrame, manifest: DataFrame) -> DataFrame:
    """Named members of zip archives in shared storage: (case_id, member, content).

    `archives` is (case_id, path) and `manifest` is (case_id, member). Only names and paths are joined, and dealt
    evenly to tasks of `ARCHIVES_PER_TASK`, since a path says nothing of the work behind it; the tasks then read each archive's directory and the byte ranges of its wanted members, one member at a
    time, so contents pass no shuffle and an archive may be larger than a worker's memory. What is absent or
    unreadable yields nothing, as in `extract_members`.
    """
    wanted = manifest.groupBy("case_id").agg(F.collect_set("member").alias("members"))
    jobs = _dealt(archives.select("case_id", "path").join(wanted, "case_id"), ARCHIVES_PER_TASK)

    def unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for case_id, path, members in _rows(batches, "case_id", "path", "members"):
            try:
                file = _open(path)
            except FileNotFoundError:
                continue
            with file:
                for name, data in _members(file, set(members)):
                    yield case_id, name, data

    return jobs.mapInArrow(lambda batches: _batches(unzip(batches), _MEMBER), "case_id long, member string, content binary")


def _members(file, wanted: set[str]) -> Iterator[tuple[str, bytes]]:
    """Readable wanted members of one archive, an open file."""
    try:
        archive = zipfile.ZipFile(file)
    except _UNREADABLE:
        return
    with archive:
        for name in sorted(wanted & set(archive.namelist())):
            try:
                data = archive.read(name)
            except _UNREADABLE:
                continue
            except OSError:
                if archive.getinfo(name).compress_type != zipfile.ZIP_BZIP2:
                    raise
                continue  # bz2 reports damage so
            yield name, data


def archive_completeness(manifest: DataFrame, extracted: DataFrame) -> DataFrame:
    """Wanted and extracted members per case, for cases where they differ."""
    got = extracted.select("case_id", "member").withColumn("_got", F.lit(1))
    flagged = manifest.distinct().join(got, ["case_id", "member"], "left")
    counts = flagged.groupBy("case_id").agg(F.count("*").alias("wanted"), F.count("_got").alias("extracted"))
    return counts.filter("wanted <> extracted")
