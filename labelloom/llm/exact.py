"""Exact duplicates with a heavy-hitter split.

Texts are equal when they are identical after lower-casing A-Z. Only 32-byte digests and ids travel.
Every task keeps a Misra-Gries summary of its digests; their sum names the few digests that may hold
more than one in SHARE rows, and an exact count verifies them. The winners of the verified digests are
broadcast, at most 2 * SHARE rows whatever the corpus, and their rows are settled where they are
read. All other digests have few rows each and are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelloom.llm.store import land, with_row_id

# Digests with at least a 1/SHARE of all rows are settled without a shuffle.
SHARE = 1000


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary())
        found = [hashlib.sha256(t.as_buffer().to_pybytes().lower() if t.is_valid else b"").digest() for t in texts]
        yield pa.record_batch([batch.column(0), pa.array(found, pa.binary())], names=["doc_id", "digest"])


def _summaries(batches: Iterator[pa.RecordBatch], slots: int) -> Iterator[pa.RecordBatch]:
    """Misra-Gries counters of a task; each is too low by at most rows / (slots + 1)."""
    kept: dict[bytes, int] = {}
    for batch in batches:
        counted = pc.value_counts(batch.column(0))
        for digest, n in zip(counted.field(0).to_pylist(), counted.field(1).to_pylist(), strict=True):
            kept[digest] = kept.get(digest, 0) + n
        if len(kept) > slots:
            cut = sorted(kept.values(), reverse=True)[slots]
            kept = {d: n - cut for d, n in kept.items() if n > cut}
    yield pa.record_batch([pa.array(list(kept), pa.binary()), pa.array(list(kept.values()), pa.int64())],
                          names=["digest", "n"])


def frequent(rows: DataFrame, column: str, share: int = SHARE) -> tuple[DataFrame, int]:
    """Candidates that include every value with at least rows / share rows, and that number of rows.

    There are at most 2 * share + 1 candidates: their counters sum to no more than all rows.
    """
    total = rows.count()
    least = max(2, -(-total // share))
    slots = 2 * share
    found = (rows.select(F.col(column).alias("digest")).mapInArrow(partial(_summaries, slots=slots), "digest binary, n long")
             .groupBy("digest").agg(F.sum("n").alias("n")).filter(F.col("n") >= least - total / (slots + 1)))
    return found.select("digest"), least


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row.

    Of equal texts the row with the largest id is kept; null texts count as empty, a null id is
    smaller than any. Of rows that repeat an id and a text one is kept. Other columns are ignored.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = with_row_id(land(narrow.mapInArrow(_digests, "doc_id long, digest binary"), "digests"))
    candidates, least = frequent(rows, "digest", share)
    winner = F.max(F.struct("doc_id", "row_file", "row_index")).alias("w")
    heavy = land(
        rows.join(F.broadcast(candidates), "digest").groupBy("digest").agg(F.count("*").alias("group_size"), winner)
        .filter(F.col("group_size") >= least).select("digest", "group_size", "w"), "heavy")
    settled = rows.join(F.broadcast(heavy), "digest").select(
        "doc_id", F.col("w.doc_id").alias("keep_id"), "group_size",
        ((F.col("row_file") == F.col("w.row_file")) & (F.col("row_index") == F.col("w.row_index"))).alias("kept"), "digest")
    same = Window.partitionBy("digest")
    first = same.orderBy(F.desc_nulls_last("doc_id"), F.desc("row_file"), F.desc("row_index"))
    shuffled = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti").select(
        "doc_id", F.first("doc_id").over(first).alias("keep_id"), F.count("*").over(same).alias("group_size"),
        (F.row_number().over(first) == 1).alias("kept"), "digest")
    return settled.unionByName(shuffled).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
