"""Line dedup by sharded cuckoo filters over exact reference-count tables.

The exact state is a table of references (key, doc_id): which documents hold a line's key. From it
comes the count table (key, n_docs, last_id). The keys that count as repeated, those in at least
`min_docs` documents, also stand as 16-bit fingerprints in cuckoo filters, one per shard of the key
space. A lookup meets the filters first and only what they let through meets the count table, so the
filters save joins and never decide. They allow deletion: when documents are inserted or removed,
references change, keys that cross the limit enter or leave their shard's filter, and lines come back
that were dropped only because of removed documents. Every state is written anew, none is altered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.store import land, width

MIN_CHARS = 40
MIN_DOCS = 5
# Mean number of keys per filter, and lookups per task of the probe.
SHARD_KEYS = 50_000
PROBE_ROWS = 500_000
_STRIP = b" \t\n\x0b\x0c\r"


def line_keys(text: bytes, min_chars: int = MIN_CHARS) -> list[bytes | None]:
    """Per line 16 bytes of the SHA-256 of its key, or None where the key has fewer code points."""
    keys: list[bytes | None] = []
    for line in text.split(b"\n"):
        key = line.strip(_STRIP).lower()
        long_enough = len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)
        keys.append(hashlib.sha256(key).digest()[:16] if long_enough else None)
    return keys


class Cuckoo:
    """Cuckoo filter: buckets of four 16-bit fingerprints, two buckets per key, 0 for a free place."""

    KICKS = 500

    def __init__(self, slots: np.ndarray):
        self.slots = slots
        self.mask = len(slots) - 1

    @classmethod
    def for_keys(cls, n: int) -> Cuckoo:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, n) / 4 / 0.75))))
        return cls(np.zeros((buckets, 4), dtype=np.uint16))

    @classmethod
    def build(cls, hashes: np.ndarray) -> Cuckoo:
        """Filter of distinct keys; a larger one if a key finds no place."""
        room = len(hashes)
        while True:
            made = cls.for_keys(room)
            if all(made.insert(h) for h in hashes.tolist()):
                return made
            room = 2 * max(1, room)

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First bucket, second bucket and fingerprint of 64-bit keys."""
        hashes = np.asarray(hashes, dtype=np.int64).view(np.uint64)
        prints = (hashes >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = (hashes & np.uint64(self.mask)).astype(np.int64)
        return first, first ^ self._leap(prints), prints

    def _leap(self, prints):
        return (np.asarray(prints).astype(np.int64) * 0x5BD1E995) & self.mask

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        first, second, prints = self.places(hashes)
        return (self.slots[first] == prints[:, None]).any(1) | (self.slots[second] == prints[:, None]).any(1)

    def insert(self, key: int) -> bool:
        first, second, prints = (int(x[0]) for x in self.places(np.array([key])))
        at, mark = first, prints
        for bucket in (first, second):
            if self._put(bucket, mark):
                return True
        for kick in range(self.KICKS):
            place = (at * 7 + kick) & 3
            mark, self.slots[at, place] = int(self.slots[at, place]), mark
            at ^= int(self._leap(np.array([mark]))[0])
            if self._put(at, mark):
                return True
        return False

    def _put(self, bucket: int, mark: int) -> bool:
        for place in range(4):
            if not self.slots[bucket, place]:
                self.slots[bucket, place] = mark
                return True
        return False

    def delete(self, key: int) -> bool:
        """Remove one fingerprint of a key that was inserted."""
        first, second, mark = (int(x[0]) for x in self.places(np.array([key])))
        for bucket in (first, second):
            for place in range(4):
                if self.slots[bucket, place] == mark:
                    self.slots[bucket, place] = 0
                    return True
        return False


@dataclass
class LineIndex:
    """references (key, doc_id), counts (key, shard, n_docs, last_id), filters (shard, slots)."""

    references: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int = MIN_DOCS
    min_chars: int = MIN_CHARS


def _keys_of(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys = [], []
        texts = batch.column(1).cast(pa.large_binary())
        for i, text in zip(batch.column(0).to_pylist(), texts, strict=True):
            if text.is_valid:
                own = {k for k in line_keys(text.as_buffer().to_pybytes(), min_chars) if k is not None}
                keys += own
                ids += [i] * len(own)
        yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], names=["key", "doc_id"])


def references_of(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Distinct (key, doc_id) of the long lines of (doc_id, text)."""
    return docs.select("doc_id", "text").mapInArrow(
        partial(_keys_of, min_chars=min_chars), "key binary, doc_id long").distinct()


def _shard(shards: int):
    return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")


def _counts(references: DataFrame, shards: int) -> DataFrame:
    return references.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_id")).withColumn(
        "shard", _shard(shards))


def _build_filter(rows: pd.DataFrame) -> pd.DataFrame:
    made = Cuckoo.build(np.unique(rows["hash"].to_numpy()))
    return pd.DataFrame({"shard": rows["shard"].iloc[:1], "slots": [made.slots.tobytes()]})


def _filters(counts: DataFrame, min_docs: int) -> DataFrame:
    repeated = counts.filter(F.col("n_docs") >= min_docs).select("shard", F.xxhash64("key", F.lit(1)).alias("hash"))
    return repeated.groupBy("shard").applyInPandas(_build_filter, "shard int, slots binary")


def build(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> LineIndex:
    """Index of (doc_id, text); shards follow the number of distinct keys, at least one per shuffle partition."""
    references = land(references_of(docs, min_chars), "references")
    n_keys = references.agg(F.approx_count_distinct("key")).first()[0]
    shards = 1 << int(np.ceil(np.log2(max(1, n_keys / SHARD_KEYS, width(docs)))))
    counts = land(_counts(references, shards), "counts")
    return LineIndex(references, counts, land(_filters(counts, min_docs), "filters"), shards, min_docs, min_chars)


def _update_filter(old: pd.DataFrame, delta: pd.DataFrame) -> pd.DataFrame:
    if delta.empty:
        return old
    slots = np.frombuffer(old["slots"].iloc[0], dtype=np.uint16).reshape(-1, 4).copy() if len(old) else None
    own = Cuckoo(slots) if slots is not None else Cuckoo.for_keys(len(delta))
    for key in delta["hash"][~delta["enters"]]:
        own.delete(key)
    fits = all(own.insert(key) for key in delta["hash"][delta["enters"]])
    return pd.DataFrame({"shard": delta["shard"].iloc[:1], "slots": [own.slots.tobytes() if fits else None]})


def _renew(index: LineIndex, references: DataFrame, touched: DataFrame) -> LineIndex:
    """The index with new references; only touched keys are counted anew, only their shards' filters change."""
    references = land(references, "references")
    fresh = _counts(references.join(touched, "key", "left_semi"), index.shards)
    counts = land(index.counts.join(touched, "key", "left_anti").unionByName(fresh), "counts")
    limit = index.min_docs
    before = index.counts.join(touched, "key", "left_semi").select("key", "shard", (F.col("n_docs") >= limit).alias("was"))
    after = counts.join(touched, "key", "left_semi").select("key", "shard", (F.col("n_docs") >= limit).alias("now"))
    delta = (before.join(after, ["key", "shard"], "full")
             .select("shard", F.xxhash64("key", F.lit(1)).alias("hash"), F.coalesce("was", F.lit(False)).alias("was"),
                     F.coalesce("now", F.lit(False)).alias("enters")).filter("was != enters").drop("was"))
    made = land(index.filters.groupBy("shard").cogroup(delta.groupBy("shard"))
                .applyInPandas(_update_filter, "shard int, slots binary"), "filters")
    # A filter that overflowed is built again from the exact table.
    full = made.filter("slots is null").select("shard")
    again = _filters(counts.join(full, "shard", "left_semi"), limit)
    filters = land(made.filter("slots is not null").unionByName(again), "filters")
    return LineIndex(references, counts, filters, index.shards, limit, index.min_chars)


def insert(index: LineIndex, docs: DataFrame) -> LineIndex:
    """The index with more documents (doc_id, text); references it already has change nothing."""
    new = land(references_of(docs, index.min_chars), "new")
    return _renew(index, index.references.union(new).distinct(), new.select("key").distinct())


def delete(index: LineIndex, ids: DataFrame) -> LineIndex:
    """The index without the documents of `ids` (doc_id)."""
    ids = ids.select("doc_id").distinct()
    gone = index.references.join(ids, "doc_id", "left_semi").select("key").distinct()
    return _renew(index, index.references.join(ids, "doc_id", "left_anti").select("key", "doc_id"), land(gone, "gone"))


def _probe(filters: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    if filters.empty or rows.empty:
        return rows.iloc[:0][["key", "doc_id"]]
    own = Cuckoo(np.frombuffer(filters["slots"].iloc[0], dtype=np.uint16).reshape(-1, 4))
    return rows[own.contains(rows["hash"].to_numpy())][["key", "doc_id"]]


def lost_lines(index: LineIndex, references: DataFrame) -> DataFrame:
    """(key, doc_id): references whose lines go, that is repeated keys outside the last document that holds them."""
    rows = references.select("key", F.struct("doc_id").alias("doc_id"), F.xxhash64("key", F.lit(1)).alias("hash"),
                             _shard(index.shards).alias("shard"))
    # A shard with many lookups, as of one very common line, is probed in several pieces.
    pieces = rows.groupBy("shard").count().select("shard", F.ceil(F.col("count") / PROBE_ROWS).cast("int").alias("pieces"))
    pieces = F.broadcast(pieces)  # one row per shard, of which there is one per SHARD_KEYS keys
    rows = rows.join(pieces, "shard").withColumn("piece", F.pmod(F.xxhash64("doc_id"), F.col("pieces")).cast("int"))
    spread = index.filters.join(pieces, "shard").select(
        "shard", "slots", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    # The id travels in a struct, so that nulls do not turn ids into floats.
    hits = (spread.groupBy("shard", "piece").cogroup(rows.groupBy("shard", "piece"))
            .applyInPandas(_probe, "key binary, doc_id struct<doc_id:bigint>"))
    repeated = index.counts.filter(F.col("n_docs") >= index.min_docs).select("key", "last_id")
    return (hits.select("key", "doc_id.doc_id").join(repeated, "key")
            .filter(~F.col("doc_id").eqNullSafe(F.col("last_id"))).select("key", "doc_id"))


def _rewrite(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, kept, total, dropped = batch.column(0), [], [], []
        texts = batch.column(1).cast(pa.large_binary())
        for text, gone in zip(texts, batch.column(2).to_pylist(), strict=True):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            lines = raw.split(b"\n")
            if gone:
                gone = set(gone)
                stay = [line for line, key in zip(lines, line_keys(raw, min_chars), strict=True) if key not in gone]
            else:
                stay = lines
            kept.append(b"\n".join(stay).decode())
            total.append(len(lines))
            dropped.append(len(lines) - len(stay))
        yield pa.record_batch([ids, pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(dropped, pa.int64())],
                              names=["doc_id", "kept", "n_lines", "n_dropped"])


def drop_lines(index: LineIndex, docs: DataFrame, references: DataFrame | None = None) -> DataFrame:
    """(doc_id, kept, n_lines, n_dropped): texts of (doc_id, text) without the lines that go.

    `references` are those of `docs` if they are at hand, else they are read from the texts. Null and
    empty texts are one empty line. A null id is one document, smaller than any other; rows that
    repeat an id are one document too, and each row loses the same lines. A key that stands several
    times in one document counts once there, and all its lines stay or go together.
    """
    references = references_of(docs, index.min_chars) if references is None else references
    gone = (lost_lines(index, references).groupBy(F.col("doc_id").alias("own"))
            .agg(F.collect_list("key").alias("gone")))
    docs = docs.select("doc_id", "text")
    return (docs.join(gone, docs["doc_id"].eqNullSafe(gone["own"]), "left").select("doc_id", "text", "gone")
            .mapInArrow(partial(_rewrite, min_chars=index.min_chars), "doc_id long, kept string, n_lines long, n_dropped long"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                min_chars: int = MIN_CHARS) -> DataFrame:
    """Build an index of a whole table and drop its repeated lines; see `drop_lines`. Other columns are ignored."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    index = build(docs, min_docs, min_chars)
    return drop_lines(index, docs, index.references)
