"""Quality classifier by supervised subword embeddings, trained by numpy stochastic gradient descent.

A text's features are hashed word n-grams (single words and pairs; a word equal to the one before it
counts as one repeat mark) and hashed character n-grams of 3 and 4 bytes that do not run across a
word's edge, in the case they have. Every bucket has a learned vector; a document is the average of
its word vectors and of its character vectors, half each; a softmax layer gives the score. A trained
model is linear in that average, so its vectors are folded into one number per bucket for scoring.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelloom.llm import tokens
from labelloom.llm.store import land

BITS = 18
DIM = 8
EPOCHS = 6
RATE = 0.4
# The model learns from at most so many labelled rows, those with the smallest hash of their id.
TRAIN_ROWS = 6000
# And from at most so many bytes of their texts.
TRAIN_BYTES = 48 << 20
# Texts are worked on in pieces of so many bytes, which take some hundred times as much memory.
CHUNK = 1 << 18
FOLDS = 5
CUT = 0.3

_SPACES = np.arange(256, dtype=np.uint32)
_SPACES[[9, 10, 11, 12, 13]] = 32
_REPEAT = np.uint64(0x5851F42D4C957F2D)


def _words(raw, starts, powers):
    """Hashes of words in order, and the number of words before each row."""
    if len(raw) <= 4 * CHUNK:
        return tokens.word_hashes(raw, starts, powers)
    # Some word is longer than a piece may be; pieces of long texts hold little else.
    begin, end, before = tokens.word_spans(raw, starts)
    return np.array([tokens.long_hash(raw[lo:hi], powers, CHUNK) for lo, hi in zip(begin, end, strict=True)], np.uint64), before


def _word_buckets(raw, starts, powers, known=0):
    """Buckets of words and word pairs, with the document of each; the first `known` words were counted before."""
    words, before = _words(raw, starts, powers)
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(before))
    again = np.zeros(len(words), dtype=bool)
    again[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    words = np.where(again, _REPEAT, words)
    inside = doc[1:] == doc[:-1]
    inside[:max(0, known - 1)] = False
    pairs = tokens.mix(words[:-1] * np.uint64(3) + words[1:])[inside]
    shift = np.uint64(64 - BITS)
    return (np.concatenate([words[known:] >> shift, pairs >> shift]).astype(np.int64),
            np.concatenate([doc[known:], doc[:-1][inside]]))


def _character_buckets(raw, starts, more=0):
    """Buckets of character n-grams, with the document of each; none begins in the last `more` bytes."""
    if len(raw) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = _SPACES[raw]
    space = code == 32
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    three = code[:-2] | (code[1:-1] << np.uint32(8)) | (code[2:] << np.uint32(16))
    shift = np.uint32(32 - BITS)
    inside = ~space[1:-1] & (doc[2:] == doc[:-2])
    four = three[:-1] | (code[3:] << np.uint32(24))
    longer = inside[:-1] & ~space[2:-1] & (doc[3:] == doc[:-3])
    if more:
        inside[len(raw) - more:] = longer[len(raw) - more:] = False
    buckets, owners = [(three * np.uint32(0x9E3779B1) >> shift)[inside]], [doc[:-2][inside]]
    buckets.append(((four ^ (four >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> shift)[longer])
    owners.append(doc[:-3][longer])
    return np.concatenate(buckets).astype(np.int64), np.concatenate(owners)


def _cuts(raw: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(from, to, words known) of the pieces of a long text, cut at white space and each reaching back two words."""
    at = 0
    while at < len(raw):
        to, back, known = min(len(raw), at + CHUNK), at, 0
        if to < len(raw):
            spaces = np.flatnonzero(_SPACES[raw[at:to]] == 32)
            if len(spaces):
                to = at + int(spaces[-1]) + 1
            else:  # a word that goes on
                while to < len(raw) and _SPACES[raw[to]] != 32:
                    ahead = np.flatnonzero(_SPACES[raw[to:to + CHUNK]] == 32)
                    to = to + int(ahead[0]) if len(ahead) else min(len(raw), to + CHUNK)
        while back and known < 2:
            while back and _SPACES[raw[back - 1]] == 32:
                back -= 1
            known += back > 0
            while back and _SPACES[raw[back - 1]] != 32:
                back -= 1
        yield back, to, known
        at = to


def _buckets(raw: np.ndarray, starts: np.ndarray, powers: tokens.Powers) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(0 for words or 1 for characters, buckets, rows) of a chunk of texts; a long text, which is a chunk alone, in pieces."""
    if len(raw) <= 2 * CHUNK:
        yield 0, *_word_buckets(raw, starts, powers)
        yield 1, *_character_buckets(raw, starts)
        return
    for lo, hi, known in _cuts(raw):
        yield 0, *_word_buckets(raw[lo:hi], np.array([0, hi - lo]), powers, known)
    for lo in range(0, len(raw), CHUNK):
        part = raw[lo:lo + CHUNK + 3]
        yield 1, *_character_buckets(part, np.array([0, len(part)]), max(0, len(part) - CHUNK))


def _counted(buckets: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket as one key, and the number of each."""
    return np.unique((owner << BITS) | buckets, return_counts=True)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_id, label, words, word_counts, chars, char_counts): distinct buckets of each labelled text with their counts."""
    powers = tokens.Powers()
    for batch in batches:
        for first, raw, starts in tokens.chunks(batch.column(2), CHUNK):
            sums: list[list] = [[], []]
            for kind, buckets, owner in _buckets(raw, starts, powers):
                sums[kind].append(_counted(buckets, owner))
            out: list[list] = [[], [], [], []]
            for kind in (0, 1):
                keys, at = np.unique(np.concatenate([k for k, _ in sums[kind]]), return_inverse=True)
                counts = np.bincount(at, weights=np.concatenate([n for _, n in sums[kind]]), minlength=len(keys))
                cuts = np.searchsorted(keys, np.arange(len(starts)) << BITS)
                for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                    out[2 * kind].append((keys[lo:hi] & ((1 << BITS) - 1)).astype(np.int32).tobytes())
                    out[2 * kind + 1].append(counts[lo:hi].astype(np.int32).tobytes())
            n = len(starts) - 1
            yield pa.record_batch([batch.column(0).slice(first, n), batch.column(1).slice(first, n), *(pa.array(c, pa.binary()) for c in out)],
                                  names=["_id", "label", "words", "word_counts", "chars", "char_counts"])


def train(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, float]:
    """Fold of the trained model: one number per bucket, and the bias. Rows are (label, buckets, weights)."""
    rng = np.random.default_rng(11)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (2 << BITS, DIM)).astype(np.float32)
    layer, bias = np.zeros((2, DIM), dtype=np.float32), np.zeros(2, dtype=np.float32)
    layer[1, 0] = 1.0
    layer[0, 1] = 1.0
    done, steps = 0, max(1, EPOCHS * len(rows))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            label, buckets, weights = rows[i]
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            hidden = weights @ vectors[buckets]
            logits = layer @ hidden + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            if len(buckets):
                # A step of the usual length for the hidden average, shared among its vectors by weight.
                vectors[buckets] -= (rate / (weights @ weights) * weights)[:, None] * (p @ layer)[None, :]
            layer -= rate * np.outer(p, hidden)
            bias -= rate * np.float32(0.1) * p
    return vectors @ (layer[1] - layer[0]), float(bias[1] - bias[0])


def _weights(counts: np.ndarray) -> np.ndarray:
    return (counts * (0.5 / max(1, counts.sum()))).astype(np.float32)


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        for i in range(batch.num_rows):
            w, wc, c, cc = (np.frombuffer(batch.column(j)[i].as_buffer(), np.int32) for j in range(2, 6))
            rows.append((batch.column(1)[i].as_py(), np.concatenate([w, c + (1 << BITS)]), np.concatenate([_weights(wc), _weights(cc)])))
    if not rows:
        return
    # An order that does not depend on how rows arrive.
    rows.sort(key=lambda r: (len(r[1]), r[0], hashlib.blake2b(r[1].tobytes(), digest_size=16).digest()))
    folded, bias = train(rows)
    yield pa.record_batch([pa.array([folded.astype(np.float32).tobytes()]), pa.array([bias], pa.float64())],
                          names=["folded", "bias"])


def _score(batches: Iterator[pa.RecordBatch], folded: np.ndarray, bias: float) -> Iterator[pa.RecordBatch]:
    powers, half = tokens.Powers(), 1 << BITS
    tables = folded[:half], folded[half:]
    for batch in batches:
        out = np.zeros(batch.num_rows)
        for first, raw, starts in tokens.chunks(batch.column(batch.num_columns - 1), CHUNK):
            n = len(starts) - 1
            sums, counts = np.zeros((2, n)), np.zeros((2, n), dtype=np.int64)
            for kind, buckets, owner in _buckets(raw, starts, powers):
                sums[kind] += np.bincount(owner, weights=tables[kind][buckets], minlength=n)
                counts[kind] += np.bincount(owner, minlength=n)
            z = bias + 0.5 * (sums / np.maximum(1, counts)).sum(axis=0)
            out[first:first + n] = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
        yield pa.record_batch([*batch.columns[:-1], pa.array(out)], names=[*batch.schema.names[:-1], "score"])


def fold_of(id_col: str) -> F.Column:
    """crc32 of the id as text, modulo FOLDS; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, most: int = TRAIN_BYTES) -> tuple[np.ndarray, float]:
    """Learn `labels.quality` from texts whose fold is not 0; whole texts of at most `rows` labelled documents and `most` bytes.

    Labels other than 0 and 1 and ids without a label are ignored; a document labelled both ways counts
    as bad. Of rows that share an id, the shortest text counts, once. Longer texts than `most`, and those after the bytes are used up, are not learned from.
    Without any labelled document every score is one half.
    """
    given = (labels.filter("quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("_id"))
             .agg(F.min("quality").alias("label")).filter(fold_of("_id") != 0))
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = F.struct(F.octet_length("text").alias("size"), F.xxhash64("text").alias("hash"))
    own = texts.filter("_id is not null").groupBy("_id").agg(F.min(size).alias("own")).select("_id", "own.*")
    # At most `rows` rows from here on, and one task for their running sum.
    first = land(given.join(own, "_id").filter(F.col("size") <= most).orderBy(F.xxhash64("_id"), "_id").limit(rows), "labelled")
    place = W.orderBy(F.xxhash64("_id"), "_id")
    chosen = first.withColumn("sum", F.sum(F.col("size").cast("long")).over(place.rowsBetween(W.unboundedPreceding, 0)))
    chosen = chosen.filter(F.col("sum") <= most).select("_id", F.col("label").cast("int").alias("label"), "size", "hash")
    wanted = texts.select("_id", "text", size.alias("own")).join(F.broadcast(chosen), "_id").filter("own.size = size and own.hash = hash")
    schema = "_id long, label int, words binary, word_counts binary, chars binary, char_counts binary"
    counted = wanted.select("_id", "label", "text").mapInArrow(_features, schema).dropDuplicates(["_id"])
    model = counted.repartition(1).mapInArrow(_fit, "folded binary, bias double").first()
    if model is None:
        return np.zeros(2 << BITS, dtype=np.float32), 0.0
    return np.frombuffer(model["folded"], dtype=np.float32), model["bias"]


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs` (doc_id, text).

    Null texts count as empty; an empty text gets the score of the bias alone. Repeated rows each come
    back. Scores see the text only.
    """
    folded, bias = fit(docs, labels, rows)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = narrow.mapInArrow(partial(_score, folded=folded, bias=bias), "doc_id long, score double")
    return scored.select("doc_id", (fold_of("doc_id") == 0).alias("held_out"), "score",
                         (F.col("score") >= CUT).cast("int").alias("predicted"))


def drop_bad(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Documents whose score is at least CUT; all columns stay, and rows keep their order in a partition."""
    folded, bias = fit(docs, labels, rows)
    # Rows travel as one column, so that any names will do.
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("text").cast("string").alias("text"))
    kind = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in docs.schema.fields)
    scored = packed.mapInArrow(partial(_score, folded=folded, bias=bias), f"row struct<{kind}>, score double")
    return scored.filter(F.col("score") >= CUT).select("row.*")
