"""Tables that cut a plan in the shared folder, and small helpers over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.session import scratch_path

LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Rows of a few numbers (at most some 30 MB in memory) that are sent to every executor.
KEY_ROWS = 500_000
# Column of a row's own number.
ROW = "_row"
SPACES = "[\\x20\\x09-\\x0D]+"


def land(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again.

    Later jobs start from the files, which survive lost executors, and see one and the same result.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unland(landed: DataFrame) -> None:
    """Remove the files of a landed table that nothing reads any more."""
    spark = landed.sparkSession
    for folder in {path.rsplit("/", 1)[0] for path in landed.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def with_row_id(landed: DataFrame) -> DataFrame:
    """A landed table with `row_file, row_index`: an identity of its rows that no retry changes."""
    return landed.select(
        "*", F.col("_metadata.file_name").alias("row_file"), F.col("_metadata.row_index").alias("row_index"))


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with as many underscores before it as make it none of the columns', whatever their case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def numbered(docs: DataFrame, row: str = ROW) -> DataFrame:
    """All columns, landed, and `row`: a number of each row, which is read and never made again."""
    return land(docs.withColumn(row, F.monotonically_increasing_id()), "rows")


def light(keys: DataFrame) -> DataFrame:
    """A landed table of a few fixed-width key columns, broadcast if it is counted to be at most KEY_ROWS.

    So a large table that keeps or loses few rows is not shuffled for them; beyond that bound it is.
    """
    return F.broadcast(keys) if keys.limit(KEY_ROWS + 1).count() <= KEY_ROWS else keys


def width(df: DataFrame) -> int:
    """Shuffle partitions of the session, to which numbers of blocks are tied."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, *LOWER)


def text_of(text: str) -> Column:
    """Null texts count as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))
