"""Log-bilinear language model, trained in numpy by noise-contrastive estimation over the whole corpus.

Tokens are the words of a text, A-Z lower-cased, and one end mark. Counting gives every training
token's count; only counts of tokens above a fixed share of all tokens (at most HOT of them) reach
the driver. The commonest of these, the end mark and KINDS marks for all other words, by their last two bytes,
are the classes of the neural model: the score of a class after two classes is the product of its vector with the sum of
the two context vectors, one table per position, plus a bias. Tasks train on all training texts of
their part with noise words shared by a minibatch, and their parameters are averaged, weighted by
tokens. Since contexts are pairs of classes, the logarithm of every context's normaliser is tabulated
by batched matrix products, so every token probability is exactly normalised; a word that is not a
class shares its mark's probability by its count plus one, and one share is left to its unseen words.

Counts of the words that are not common are never gathered: their hashes are dealt to blocks, counted
there together with the texts that ask for them, and only sums per text come back.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm import tokens
from labelloom.llm.store import land, width

FOLDS, HELD = 7, 2
# Words with at least 1/HOT of all training tokens are looked up where the texts are read.
HOT = 20_000
CLASSES = 1024
# Classes below KINDS are marks of other words, then comes the end mark, then the common words.
KINDS = 251
END = KINDS
DIM = 16
NOISE = 64
BATCH = 2048
RATE = 0.2
PIECES, SPREAD = 16, 64
UNIT_BYTES = 4 << 20


def _split(h: np.ndarray, blocks: int):
    """Words dealt to blocks: (block, first entry, end) runs over words in block order, and that order."""
    block = (h >> np.uint64(48)) % np.uint64(blocks)
    order = np.argsort(block.astype(np.uint16) if blocks <= 65535 else block, kind="stable")
    ordered = block[order]
    present, cuts = np.unique(ordered, return_index=True)
    if not len(h):
        return order, []
    return order, list(zip(present.tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(h)], strict=True))


def _words(raw: np.ndarray, starts: np.ndarray, powers: tokens.Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and kinds of all words, and the number of words before each row."""
    begin, end, before = tokens.word_spans(raw, starts)
    return tokens.span_hashes(raw, begin, end, powers), tokens.word_ends(raw, begin, end, KINDS), before


def _count(batches: Iterator[pa.RecordBatch], blocks: int) -> Iterator[pa.RecordBatch]:
    """Counts of the words of training texts, by unit and block."""
    powers = tokens.Powers()
    for batch in batches:
        for _, raw, starts in tokens.chunks(batch.column(0), UNIT_BYTES):
            words, kinds, _ = _words(raw, starts, powers)
            words, first, counts = np.unique(words, return_index=True, return_counts=True)
            order, runs = _split(words, blocks)
            words, counts, kinds = words[order], counts[order].astype(np.uint32), kinds[first][order].astype(np.uint8)
            yield pa.record_batch([
                pa.array([b for b, _, _ in runs], pa.int32()),
                pa.array([words[lo:hi].tobytes() for _, lo, hi in runs], pa.binary()),
                pa.array([counts[lo:hi].tobytes() for _, lo, hi in runs], pa.binary()),
                pa.array([kinds[lo:hi].tobytes() for _, lo, hi in runs], pa.binary())], names=["block", "words", "counts", "kinds"])


def _total(rows: pd.DataFrame) -> pd.DataFrame:
    """Tokens and distinct words of a block, and its most frequent words."""
    flat = np.concatenate([np.frombuffer(x, np.uint64) for x in rows["words"]])
    times = np.concatenate([np.frombuffer(x, np.uint32) for x in rows["counts"]])
    kinds = np.concatenate([np.frombuffer(x, np.uint8) for x in rows["kinds"]])
    words, first, where = np.unique(flat, return_index=True, return_inverse=True)
    counts = np.bincount(where, weights=times, minlength=len(words)).astype(np.int64)
    kinds = kinds[first]
    top = np.lexsort((words, -counts))[:HOT]
    return pd.DataFrame({
        "block": rows["block"].iloc[:1], "n": [np.bincount(kinds, weights=counts, minlength=KINDS).astype(np.int64).tolist()],
        "v": [np.bincount(kinds, minlength=KINDS).tolist()],
        "words": [words[top].tobytes()], "counts": [counts[top].tobytes()], "kinds": [kinds[top].tobytes()]})


def _above(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for words, counts, kinds in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words, counts, kinds = np.frombuffer(words, np.int64), np.frombuffer(counts, np.int64), np.frombuffer(kinds, np.uint8)
            keep = counts >= least
            yield pa.record_batch([pa.array(words[keep]), pa.array(counts[keep]), pa.array(kinds[keep].astype(np.int32))],
                                  names=["word", "n", "kind"])


class Vocabulary:
    """Totals of the training tokens, the common words with their counts, and the classes."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, kinds: np.ndarray, n: np.ndarray, v: np.ndarray, texts: int):
        """Common words with counts and kinds; tokens and distinct words by kind; training texts."""
        order = np.argsort(words)
        self.words, self.counts, kinds = words[order], counts[order], kinds[order]
        self.n, self.v, self.ends = int(n.sum()) + texts, int(v.sum()) + (texts > 0), texts
        rank = np.lexsort((self.words, -self.counts))[:CLASSES - KINDS - 1]
        self.classes = kinds.astype(np.int64)
        self.classes[rank] = np.arange(KINDS + 1, KINDS + 1 + len(rank))
        own = kinds[rank]
        other_n = n - np.bincount(own, weights=self.counts[rank], minlength=KINDS)
        other_v = v - np.bincount(own, minlength=KINDS)
        sizes = np.concatenate([other_n, [texts], self.counts[rank]])
        # What a word that is no class pays within its mark.
        self.share = np.log10(other_n + other_v + 1)
        self.noise = (sizes + 1) / (sizes + 1).sum()

    @classmethod
    def of(cls, state: dict) -> Vocabulary:
        """From `vars` of another one; plain arrays travel to tasks, so they need not import this class."""
        own = cls.__new__(cls)
        vars(own).update(state)
        return own

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place of each word among the common ones, -1 for others."""
        if not len(self.words):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, at, -1)


def count(docs: DataFrame) -> Vocabulary:
    """Vocabulary of the texts (held, text) that are not held out."""
    training = docs.filter("not held").select("text")
    packed = training.mapInArrow(partial(_count, blocks=2 * width(docs)), "block int, words binary, counts binary, kinds binary")
    blocks = land(packed.groupBy("block").applyInPandas(_total, "block int, n array<long>, v array<long>, words binary, counts binary, kinds binary"), "words")
    texts = training.count()
    sums = blocks.select(F.posexplode(F.arrays_zip("n", "v")).alias("kind", "c")).groupBy("kind").agg(
        F.sum("c.n"), F.sum("c.v")).orderBy("kind").collect()
    n, v = (np.array([r[i] for r in sums] or [0] * KINDS, dtype=np.int64) for i in (1, 2))
    least = max(1, -(-(int(n.sum()) + texts) // HOT))
    common = blocks.select("words", "counts", "kinds").mapInArrow(
        partial(_above, least=least), "word long, n long, kind int").collect()
    words, counts, kinds = (np.array([r[i] for r in common], dtype=np.int64) for i in range(3))
    return Vocabulary(words.view(np.uint64), counts, kinds, n, v, texts)


def _sequence(classes: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Classes of all tokens with end marks, the two classes before each, and the row of each."""
    rows = len(before) - 1
    lengths = np.diff(before) + 1
    row = np.repeat(np.arange(rows), lengths)
    seq = np.full(len(classes) + rows, END, dtype=np.int64)
    seq[np.arange(len(classes)) + np.repeat(np.arange(rows), np.diff(before))] = classes
    one, two = np.full(len(seq), END), np.full(len(seq), END)
    one[1:] = seq[:-1]
    two[2:] = seq[:-2]
    two[one == END] = END
    return seq, one, two, row


class Model:
    """Parameters: a context table per position, output vectors, biases; with Adagrad sums while training."""

    def __init__(self, noise: np.ndarray):
        rng = np.random.default_rng(5)
        size = (len(noise), DIM)
        self.noise = noise
        self.values = [rng.normal(0, 0.05, size).astype(np.float32) for _ in range(3)]
        self.values.append(np.log(noise).astype(np.float32)[:, None])
        self.sums = [np.full(len(noise), 1e-2, dtype=np.float32) for _ in range(4)]
        self.rng = np.random.default_rng(17)

    def _step(self, which: int, rows: np.ndarray, grads: np.ndarray) -> None:
        """One Adagrad step of a table for summed gradients of its rows."""
        order = np.argsort(rows, kind="stable")
        ordered = rows[order]
        cuts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        own, summed = ordered[cuts], np.add.reduceat(grads[order], cuts, axis=0)
        self.sums[which][own] += (summed * summed).mean(axis=1)
        self.values[which][own] += RATE * summed / np.sqrt(self.sums[which][own])[:, None]

    def learn(self, seq: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        """One pass over tokens in minibatches; each shares NOISE noise classes."""
        draws = np.log(NOISE * self.noise).astype(np.float32)
        for lo in range(0, len(seq), BATCH):
            w, a, b = seq[lo:lo + BATCH], one[lo:lo + BATCH], two[lo:lo + BATCH]
            noise = self.rng.choice(len(self.noise), NOISE, p=self.noise)
            first, second, out, bias = self.values
            hidden = first[a] + second[b]
            good, bad = out[w], out[noise]
            right = 1 / (1 + np.exp((hidden * good).sum(1) + bias[w, 0] - draws[w]))
            wrong = -1 / (1 + np.exp(draws[noise] - bias[noise, 0] - hidden @ bad.T))
            scale = np.float32(1 / len(w))
            back = (right[:, None] * good + wrong @ bad) * scale
            up = np.concatenate([right[:, None] * hidden, wrong.T @ hidden]) * scale
            level = np.concatenate([right, wrong.sum(0)])[:, None] * scale
            both = np.concatenate([w, noise])
            self._step(0, a, back)
            self._step(1, b, back)
            self._step(2, both, up)
            self._step(3, both, level)


def _train(batches: Iterator[pa.RecordBatch], vocabulary) -> Iterator[pa.RecordBatch]:
    """A task's parameters after its texts, times its number of tokens, in PIECES."""
    v, powers, seen = Vocabulary.of(vocabulary.value), tokens.Powers(), 0
    model = Model(v.noise)
    for batch in batches:
        for _, raw, starts in tokens.chunks(batch.column(0), UNIT_BYTES):
            words, kinds, before = _words(raw, starts, powers)
            at = v.find(words)
            classes = np.where(at >= 0, v.classes[at], kinds) if len(v.words) else kinds
            seq, one, two, _ = _sequence(classes, before)
            model.learn(seq, one, two)
            seen += len(seq)
    if seen:
        flat = np.concatenate([x.ravel() for x in model.values]).astype(np.float64) * seen
        task = TaskContext.get().partitionId()
        yield pa.record_batch([
            pa.array([task] * PIECES, pa.int64()), pa.array(range(PIECES), pa.int32()), pa.array([seen] * PIECES, pa.int64()),
            pa.array([p.tobytes() for p in np.array_split(flat, PIECES)], pa.binary())], names=["task", "piece", "seen", "flat"])


def _sum_pieces(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("task")
    total = np.sum([np.frombuffer(x, np.float64) for x in rows["flat"]], axis=0)
    return pd.DataFrame({"task": rows["task"].iloc[:1].to_numpy(), "piece": rows["piece"].iloc[:1].to_numpy(),
                         "seen": [rows["seen"].sum()], "flat": [total.tobytes()]})


def train(docs: DataFrame, vocabulary: Vocabulary) -> list[np.ndarray]:
    """Averaged parameters [first, second, out, bias]; one pass over all texts (held, text) not held out."""
    schema = "task long, piece int, seen long, flat binary"
    shared = docs.sparkSession.sparkContext.broadcast(vars(vocabulary))
    own = docs.filter("not held").select("text").mapInArrow(partial(_train, vocabulary=shared), schema)
    # Sums of sums, so that no task adds up all tasks' parameters.
    some = own.groupBy("piece", F.pmod("task", F.lit(SPREAD)).alias("part")).applyInPandas(_sum_pieces, schema)
    rows = sorted(some.groupBy("piece").applyInPandas(_sum_pieces, schema).collect(), key=lambda r: r["piece"])
    start = Model(vocabulary.noise)
    if not rows:
        return start.values
    flat = np.concatenate([np.frombuffer(r["flat"], np.float64) / r["seen"] for r in rows])
    cuts = np.cumsum([x.size for x in start.values])[:-1]
    return [p.reshape(x.shape).astype(np.float32) for p, x in zip(np.split(flat, cuts), start.values, strict=True)]


def _normalisers(batches: Iterator[pa.RecordBatch], values: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    first, second, out, bias = values
    for batch in batches:
        rows = []
        for c in batch.column(0).to_pylist():
            logits = (first + second[c]) @ out.T + bias[:, 0]
            top = logits.max(1)
            rows.append((top + np.log(np.exp(logits - top[:, None]).sum(1))).astype(np.float32).tobytes())
        yield pa.record_batch([batch.column(0), pa.array(rows, pa.binary())], names=["id", "z"])


def normalisers(docs: DataFrame, values: list[np.ndarray]) -> np.ndarray:
    """log of the sum of exp(score) over all classes, [class one back, class two back]."""
    n = len(values[0])
    spark = docs.sparkSession
    rows = spark.range(0, n, 1, min(n, 4 * width(docs))).mapInArrow(partial(_normalisers, values=values), "id long, z binary").collect()
    return np.stack([np.frombuffer(r["z"], np.float32) for r in sorted(rows, key=lambda r: r["id"])], axis=1)


def _ask(batches: Iterator[pa.RecordBatch], shared, blocks: int) -> Iterator[pa.RecordBatch]:
    """What each text's own task knows (kind info), and its less common words dealt to blocks."""
    state, (first, second, out, bias), z = shared.value
    v = Vocabulary.of(state)
    pair_one, pair_two = first @ out.T, second @ out.T + bias[:, 0]
    powers, serial = tokens.Powers(), 0
    task = TaskContext.get().partitionId()
    logs = np.log10(v.counts + 1.0) if len(v.words) else np.zeros(1)
    for batch in batches:
        ids, held = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
        for start, raw, starts in tokens.chunks(batch.column(2), UNIT_BYTES):
            n = len(starts) - 1
            words, kinds, before = _words(raw, starts, powers)
            doc = np.repeat(np.arange(n), np.diff(before))
            at = v.find(words)
            common = at >= 0
            classes = np.where(common, v.classes[at], kinds) if len(v.words) else kinds
            seq, one, two, row = _sequence(classes, before)
            chance = (pair_one[one, seq] + pair_two[two, seq] - z[one, two]) / math.log(10)
            model = np.bincount(row, weights=chance, minlength=n)
            log_c = np.where(common, logs[at], 0.0) if len(v.words) else np.zeros(len(words))
            base = np.bincount(doc, weights=log_c, minlength=n) + math.log10(v.ends + 1)
            others = classes < KINDS
            model += np.bincount(doc[others], weights=log_c[others] - v.share[classes[others]], minlength=n)
            lengths = np.diff(before) + 1
            base -= lengths * math.log10(v.n + v.v + 1)
            known = np.bincount(doc[common], minlength=n) + (v.ends > 0)
            unit = (task << 32) + serial
            serial += 1
            info = pa.table({
                "doc_id": ids.slice(start, n), "held": pa.array(held[start:start + n]), "n": pa.array(lengths),
                "known": pa.array(known.astype(np.int64)), "base": pa.array(base), "model": pa.array(model)})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, info.schema) as writer:
                writer.write_table(info)
            rare, owner = words[~common], doc[~common]
            order, runs = _split(rare, blocks)
            rare, owner = rare[order], owner[order]
            learned = ~held[start:start + n].astype(bool)
            rows: list[list] = [[unit % blocks], [unit], [sink.getvalue().to_pybytes()], [b""], [b""], [b""], [b""]]
            for block, lo, hi in runs:
                own, counts = np.unique(owner[lo:hi], return_counts=True)
                part = rare[lo:hi]
                for column, value in zip(rows, (
                        block, unit, None, np.stack([own, counts, learned[own]]).astype(np.int32).tobytes(),
                        (part & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(),
                        ((part >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.uint16).tobytes(), b""), strict=True):
                    column.append(value)
            yield pa.record_batch([
                pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.int64()), *(pa.array(c, pa.binary()) for c in rows[2:6])],
                names=["block", "unit", "info", "docs", "low", "high"])


def _answer(rows: pd.DataFrame) -> pd.DataFrame:
    """Within a block: counts of its words in training texts, then per text the sum of log10(c + 1) and known tokens."""
    infos = rows[rows["info"].notna()]
    asks = rows[rows["info"].isna()]
    out = [pd.DataFrame({"unit": infos["unit"], "info": infos["info"], "docs": b"", "sums": b"", "known": b""})]
    if len(asks):
        docs = [np.frombuffer(x, np.int32).reshape(3, -1) for x in asks["docs"]]
        flat = np.concatenate(docs, axis=1)
        words = np.concatenate([np.frombuffer(x, np.uint32) for x in asks["low"]]).astype(np.uint64)
        words |= np.concatenate([np.frombuffer(x, np.uint16) for x in asks["high"]]).astype(np.uint64) << np.uint64(32)
        _, where = np.unique(words, return_inverse=True)
        counts = np.bincount(where, weights=np.repeat(flat[2], flat[1]))[where]
        starts = np.concatenate([[0], np.cumsum(flat[1])[:-1]])
        sums = np.add.reduceat(np.log10(counts + 1), starts)
        known = np.add.reduceat((counts > 0).astype(np.int64), starts)
        cuts = np.cumsum([d.shape[1] for d in docs])[:-1]
        out.append(pd.DataFrame({
            "unit": asks["unit"].to_numpy(), "info": None, "docs": [d[0].tobytes() for d in docs],
            "sums": [x.tobytes() for x in np.split(sums, cuts)], "known": [x.tobytes() for x in np.split(known, cuts)]}))
    return pd.concat(out)


def _join_unit(rows: pd.DataFrame) -> pd.DataFrame:
    """One unit's texts: what their task knew plus the answers of all blocks, added in a fixed order."""
    info = rows[rows["info"].notna()]["info"].iloc[0]
    table = pa.ipc.open_stream(info).read_all()
    base, model = table["base"].to_numpy().copy(), table["model"].to_numpy().copy()
    known = table["known"].to_numpy().copy()
    for docs, sums, more in sorted(zip(*(rows[rows["info"].isna()][c] for c in ("docs", "sums", "known")), strict=True)):
        at = np.frombuffer(docs, np.int32)
        base[at] += np.frombuffer(sums, np.float64)
        model[at] += np.frombuffer(sums, np.float64)
        known[at] += np.frombuffer(more, np.int64)
    return pd.DataFrame({
        "doc_id": table["doc_id"].to_pandas(types_mapper=pd.ArrowDtype), "held_out": table["held"].to_numpy(),
        "n_tokens": table["n"].to_numpy(), "n_known": known, "base_score": base, "score": model})


def language_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Learns from rows whose crc32(id as text) mod 7 is not 2 (a null id counts as an empty text). Null
    and empty texts are one end mark. Repeated rows each count and come back. Without any training
    text every count is 0 and the model is uniform but for its start. Other columns are ignored.
    """
    held = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % FOLDS == HELD
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held"), F.col(text_col).cast("string").alias("text"))
    vocabulary = count(docs)
    values = train(docs, vocabulary)
    z = normalisers(docs, values)
    shared = docs.sparkSession.sparkContext.broadcast((vars(vocabulary), values, z))
    packed = docs.mapInArrow(partial(_ask, shared=shared, blocks=2 * width(docs)),
                             "block int, unit long, info binary, docs binary, low binary, high binary")
    answers = packed.groupBy("block").applyInPandas(_answer, "unit long, info binary, docs binary, sums binary, known binary")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    scored = answers.groupBy("unit").applyInPandas(_join_unit, schema)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(vocabulary.n).cast("long").alias("train_tokens"),
                         "base_score", "score")
