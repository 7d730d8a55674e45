"""Documents: parsed once, and dealt to tasks by their bytes."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelloom.sources import documents
from labelloom.streaming import incremental


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_batch_of_documents_is_dealt_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "BATCH_BYTES", 500)
    source, sink, progress = (f"{tmp_path}/{n}" for n in ("in", "out", "cp"))
    docs = spark.range(400).select(
        F.format_string('{"status": "OK", "data": {"data": {"main": {"CaseID": %d}}}}', "id").alias("doc"), F.lit(None).cast("string").alias("files"))
    docs.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(docs.schema).parquet(source)
    incremental.ingest_stream(stream, sink, progress).awaitTermination()
    written = spark.read.parquet(f"{sink}/case")
    counts = [r["count"] for r in written.groupBy(F.input_file_name()).count().collect()]
    assert sum(counts) == 400 and len(counts) > 20 and max(counts) < 40


def test_kept_documents_are_parsed_once(spark, tmp_path, rows):
    raw = spark.createDataFrame([
        ('{"status": "OK", "data": {"data": {"main": {"CaseID": 1}, "est_details": {"parts": [{"fVAL": 2.5}]}}}}', '[{"iDOCID": 4}]'),
        ('{"status": "ERR"}', None), (None, None)], "doc string, files string")
    once, again = documents.flatten_cases(raw, keep=f"{tmp_path}/parsed"), documents.flatten_cases(raw)
    for kept, parsed in zip(once, again):
        assert kept.schema == parsed.schema and kept.collect() == parsed.collect()
        assert "from_json" in plan(parsed) and "from_json" not in plan(kept)
