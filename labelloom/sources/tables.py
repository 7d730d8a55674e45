"""Parquet and CSV tables with partition folders."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_table(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, where: Column | str | None = None
) -> DataFrame:
    """Parquet table; a predicate prunes partition folders and row groups, `columns` prunes the scan."""
    table = spark.read.parquet(path)
    if where is not None:
        table = table.where(where)
    return table if columns is None else table.select(*columns)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Partitioned Parquet; rows are not regrouped, so a large partition value stays spread over tasks."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_groups(df: DataFrame, path: str, by: Sequence[str], fmt: str = "csv", mode: str = "overwrite") -> None:
    """One folder of files per group, written by a single job."""
    writer = df.write.mode(mode).partitionBy(*by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def read_tagged_csv(
    spark: SparkSession,
    glob: str,
    schema: StructType | str,
    name_regex: str,
    tags: Sequence[str],
    required: str = "file",
) -> DataFrame:
    """CSV files matching a glob, each row tagged with the groups of `name_regex` found in its path.

    Rows without the `required` column are dropped. The schema names the wanted columns; each file's
    own header decides where they are, so files may order them differently and carry others (such
    as an unnamed index).
    """
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    path = F.url_decode(F.col("_metadata.file_path"))
    found = [F.regexp_extract(path, name_regex, i + 1).alias(t) for i, t in enumerate(tags)]
    frames = []
    for header, files in _files_by_header(spark, glob).items():
        # Every field is read as text in the order of the files' own header, so no value is altered.
        names = next(csv.reader([header]), [])
        as_text = StructType([StructField(f"_c{i}", StringType()) for i in range(max(1, len(names)))])
        rows = spark.read.schema(as_text).option("header", True).csv(files)
        at = {name: f"_c{i}" for i, name in reversed(list(enumerate(names)))}
        columns = [
            (F.col(at[f.name]).try_cast(f.dataType) if f.name in at else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in wanted.fields
        ]
        frames.append(rows.select(*columns, *found))
    if not frames:
        empty = StructType([*wanted.fields, *[StructField(t, StringType()) for t in tags]])
        return spark.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, frames).filter(F.col(required).isNotNull())


def _files_by_header(spark: SparkSession, glob: str) -> dict[str, list[str]]:
    """Paths of the non-empty files under a glob by their first line.

    One pass that keeps one line per file; the driver lists the files of a table anyway.
    """
    lines = spark.read.text(glob).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"))
    heads = lines.filter("start = 0").groupBy("path").agg(F.min_by("value", "at").alias("header")).collect()
    found: dict[str, list[str]] = {}
    for row in sorted(heads, key=lambda r: r["path"]):
        found.setdefault(row["header"], []).append(unquote(row["path"]))
    return found
