"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of a few fixed-width columns that may be sent to every executor, and bytes of any rows.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20
# Rows that one task groups, sorts or writes, where a table is dealt by its row count.
TASK_ROWS = 1_000_000

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("labelloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in `spark.checkpoint.dir`.

    Only a local master may fall back to a temporary folder of this machine, which goes with the process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="labelloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def save_point(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors and cuts the lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def spread(df: DataFrame, size: int, *keys: Column | str, share: int = TASK_ROWS) -> DataFrame:
    """A table of `size` rows, or other units, dealt by its keys (without any: evenly) to a task per `share`, at least one per core.

    The share of a task then stays the same however large the table is, whatever the session's number of
    shuffle partitions. Tables dealt by the same count and keys are grouped and joined on them where they lie.
    """
    return df.repartition(max(-(-size // share), df.sparkSession.sparkContext.defaultParallelism), *keys)


def small_side(summary: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A summary table to join back to the rows it came from.

    It is computed once and saved, then counted and measured: up to `max_rows` rows and
    `BROADCAST_BYTES` bytes of values it is broadcast, so the large side is not shuffled on what may be
    a hot key; beyond that it is left to a shuffle join.
    """
    saved = save_point(summary)
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in saved.columns])))
    rows, size = saved.limit(max_rows + 1).agg(F.count("*"), F.sum(width)).first()
    return F.broadcast(saved) if rows <= max_rows and (size or 0) <= BROADCAST_BYTES else saved
