"""Structured Streaming jobs over file sources.

Every sink writes one folder per batch and overwrites it on a retry, so a batch that is replayed
after a failure leaves the same rows once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from labelloom.session import spread
from labelloom.sources.documents import flatten_parsed, judge_documents, quarantine


# The column that each ingested table is partitioned by.
PARTITION_COLUMNS = {"case": "Vehicle_Type", "part": "CoType", "file": "StdDocDesc"}
# Bytes of documents that one task parses and keeps.
BATCH_BYTES = 64 << 20


def _save_batch(df: DataFrame, path: str, batch_id: int, by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*by).parquet(f"{path.rstrip('/')}/batch={batch_id}")


def ingest_stream(raw: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """New documents to `<sink>/case`, `/part` and `/file`, partitioned, and what cannot be used to `<sink>/quarantine`.

    A batch is parsed once, and all its documents are flushed under its number. They are dealt to tasks of `BATCH_BYTES` of
    text before, so that what a task keeps of them does not grow with the batch; of usable ones the text is not kept.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        size = batch.agg(F.sum(sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in ("doc", "files")))).first()[0] or 0
        dealt = spread(batch, size, F.xxhash64(F.monotonically_increasing_id()), share=BATCH_BYTES)
        judged = judge_documents(dealt).withColumn("doc", F.when(F.col("outcome") != "ok", F.col("doc"))).persist()
        try:
            for name, table in flatten_parsed(judged.filter("outcome = 'ok'"))._asdict().items():
                _save_batch(table, f"{sink}/{name}", batch_id, [PARTITION_COLUMNS[name]])
            _save_batch(quarantine(judged), f"{sink}/quarantine", batch_id)
        finally:
            judged.unpersist()

    return (
        raw.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def first_per_stream(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], sink: str, checkpoint: str
) -> StreamingQuery:
    """Earliest row per key with any lateness.

    The state store keeps one row per key, spread over the cluster; each batch appends only the
    keys whose earliest row changed. `read_first_per` folds the changes.
    """
    rest = [c for c in stream.columns if c not in keys]
    ordered = [*order, *[c for c in rest if c not in order]]
    earliest = stream.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("first"))
    return (
        earliest.writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: _save_batch(batch, sink, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_first_per(spark: SparkSession, sink: str, keys: Sequence[str]) -> DataFrame:
    """Earliest row per key from the change files of `first_per_stream`."""
    changes = spark.read.parquet(sink)
    return changes.groupBy(*keys).agg(F.min("first").alias("first")).select(*keys, "first.*")


def _cell(given: int, said: int) -> Column:
    return F.count_if((F.col("gt") == given) & (F.col("pred") == said))


def running_metrics(
    stream: DataFrame, time: str, window: str, lateness: str | None, by: Sequence[str], sink: str, checkpoint: str
) -> StreamingQuery:
    """Confusion counts per tumbling window and group as predictions (`gt`, `pred`) arrive.

    With a `lateness` the state of older windows is dropped and rows that come later than that are not
    counted; Spark reports how many in the query's progress (`numRowsDroppedByWatermark`), and
    `metrics_with_late_rows` keeps them. Without one no row is too late, at the price of a state of one
    row per window and group. A replay of finite input, whose files need not be in order of time, takes None.
    """
    counted = (
        (stream if lateness is None else stream.withWatermark(time, lateness))
        .groupBy(F.window(time, window).alias("w"), *by)
        .agg(_cell(1, 1).alias("tp"), _cell(0, 0).alias("tn"), _cell(0, 1).alias("fp"), _cell(1, 0).alias("fn"))
        .select(F.col("w.start").alias("window_start"), *by, "tp", "tn", "fp", "fn")
    )
    return (
        counted.writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: _save_batch(batch, sink, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_running_metrics(spark: SparkSession, sink: str, by: Sequence[str]) -> DataFrame:
    """Latest counts per window and group with accuracy, hit rate and true-negative rate."""
    updates = spark.read.parquet(sink)
    cells = ["tp", "tn", "fp", "fn"]
    latest = updates.groupBy("window_start", *by).agg(F.max_by(F.struct(*cells), "batch").alias("last"))
    tp, tn, fp, fn = (F.col(c) for c in cells)
    ratio = lambda a, b: F.try_divide(a.cast("double"), b.cast("double"))
    return latest.select("window_start", *by, "last.*").select(
        "*",
        ratio(tp + tn, tp + tn + fp + fn).alias("acc"),
        ratio(tp, tp + fn).alias("tpr"),
        ratio(tn, tn + fp).alias("tnr"),
    )


def metrics_with_late_rows(
    stream: DataFrame, time: str, window: str, lateness: str, by: Sequence[str], sink: str, checkpoint: str
) -> StreamingQuery:
    """Confusion counts as in `running_metrics`, and the rows that come too late as a table of their own.

    A row is late if its window ends at or before the latest time of all earlier batches less `lateness`.
    Each batch is split there: late rows go whole to `<sink>/late`, the others' counts to `<sink>/counts`, and
    the batch's latest time to `<sink>/seen`. A batch reads the `seen` of smaller numbers only, so a
    replay splits alike and counted plus late rows are the input. Rows without a time are late.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = None
        if batch_id:
            earlier = spark.read.schema("latest timestamp, batch long").parquet(f"{sink}/seen").filter(F.col("batch") < batch_id)
            seen = earlier.agg(F.max("latest")).first()[0]
        # Windows leave out rows without a time.
        timed, untimed = batch.filter(F.col(time).isNotNull()), batch.filter(F.col(time).isNull())
        placed = timed.withColumn("_w", F.window(time, window)).persist()
        is_late = F.lit(False) if seen is None else F.col("_w.end") <= F.lit(seen) - F.expr(f"interval {lateness}")
        try:
            _save_batch(placed.filter(is_late).drop("_w").unionByName(untimed), f"{sink}/late", batch_id)
            counts = (placed.filter(~is_late).groupBy(F.col("_w.start").alias("window_start"), *by)
                      .agg(F.count("*").alias("rows"), _cell(1, 1).alias("tp"), _cell(0, 0).alias("tn"),
                           _cell(0, 1).alias("fp"), _cell(1, 0).alias("fn")))
            _save_batch(counts, f"{sink}/counts", batch_id)
            _save_batch(batch.agg(F.max(F.col(time).cast("timestamp")).alias("latest")), f"{sink}/seen", batch_id)
        finally:
            placed.unpersist()

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_counted(spark: SparkSession, sink: str, by: Sequence[str]) -> DataFrame:
    """Counts per window and group over all batches of `metrics_with_late_rows`."""
    sums = [F.sum(c).alias(c) for c in ("rows", "tp", "tn", "fp", "fn")]
    return spark.read.parquet(f"{sink}/counts").groupBy("window_start", *by).agg(*sums)
