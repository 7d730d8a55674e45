"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Rows of the matrix are distinct shingle sets, columns are 5-word shingles. Two sets link when they
share at least 75 % of their union. The product is never formed whole:

* Equal sets are one row, by a fingerprint of the whole set, so copies are never paired.
* Columns are ordered rare first by a fixed-size sketch of column counts, and of each row of n only
  the leading n - ceil(0.75 n) + l entries stay. Rows of n and m that link share at least
  s = ceil(3 (n + m) / 7) entries, so at least l of them are among the leading n - s + l of the one
  and m - s + l of the other, l = 1 + min(n, m) // 50. Products of entries further back are discarded,
  as are those of rows whose sizes alone exclude 0.75, and pairs whose counts add up to less than l.
  What many documents share (a licence line, a quoted passage) stands last in every row and meets
  nobody, and so do most copies that are edited too much to link.
* Rows that agree on a pair of minimum hashes are compared with two rows of their bucket first. What
  links is united, and the product then runs between groups only, so a large group of near copies
  costs two comparisons per member instead of all its pairs.
* Each row's largest bucket of DENSE_LEAST to DENSE_MOST rows is multiplied whole, in tiles of TILE by
  TILE rows, and emits a spanning set of its links only; its pairs are settled thereby. Rows of
  larger buckets are left to the column blocks like all others.
* Columns are cut into blocks. A task multiplies one block and emits partial overlap counts per pair;
  their sums name each row's best partner, which is compared first. All that is then left between
  groups is compared exactly on the whole sets, without a limit on partners.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm import tokens
from labelloom.llm.graph import components
from labelloom.llm.store import ROW, free_name, land, light, numbered, width

# Links: 100 * shared >= PERCENT * union.
PERCENT = 75
SKETCH = 1 << 21
SKETCH_PARTS = 64
# Minimum hashes are taken in BANDS pairs; two sets at 0.75 agree on some pair with 99.97 %.
BANDS = 10

DENSE_LEAST, DENSE_MOST, TILE = 32, 8192, 512

PROFILE = "doc_id long, n_shingles long, node long, bands array<long>, part int, counts binary"


def _band_steps() -> np.ndarray:
    return tokens.mix(np.arange(1, 2 * BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def node_ids(sets: list[np.ndarray]) -> np.ndarray:
    """One 64-bit fingerprint per set, over all its hashes and its size."""
    sizes = np.array([len(s) for s in sets], dtype=np.uint64)
    sums = np.array([s.sum(dtype=np.uint64) if len(s) else 0 for s in sets], dtype=np.uint64)
    bits = np.array([np.bitwise_xor.reduce(s) if len(s) else 0 for s in sets], dtype=np.uint64)
    return tokens.mix(tokens.mix(sums + sizes) + bits * np.uint64(3)).view(np.int64)


def _bands(sets: list[np.ndarray]) -> list:
    """BANDS keys per set, each made of two minimum hashes; none for the empty set."""
    full = [i for i, s in enumerate(sets) if len(s)]
    rows: list = [None] * len(sets)
    if not full:
        return rows
    flat = np.concatenate([sets[i] for i in full])
    starts = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
    least = [np.minimum.reduceat(flat * step, starts) for step in _band_steps()]
    keys = np.stack([
        tokens.mix(least[2 * b] * np.uint64(5) + tokens.mix(least[2 * b + 1]) + np.uint64(b)) for b in range(BANDS)], axis=1)
    for row, i in enumerate(full):
        rows[i] = keys[row].view(np.int64)
    return rows


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its set's size, fingerprint and band keys; per task the sketch of column counts."""
    powers, sketch = tokens.Powers(), np.zeros(SKETCH, dtype=np.int64)
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()),
                        ("bands", pa.list_(pa.int64())), ("part", pa.int32()), ("counts", pa.binary())])
    for batch in batches:
        ids = batch.column(0)
        for first, raw, starts in tokens.chunks(batch.column(1)):
            sets = tokens.shingle_sets(raw, starts, powers)
            flat = np.concatenate(sets)
            sketch += np.bincount((flat & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
            n = len(sets)
            yield pa.record_batch([
                ids.slice(first, n), pa.array([len(s) for s in sets], pa.int64()), pa.array(node_ids(sets)),
                pa.array(_bands(sets), pa.list_(pa.int64())), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=schema)
    parts = np.minimum(sketch, 65535).astype(np.uint16).reshape(SKETCH_PARTS, -1)
    none = pa.nulls(SKETCH_PARTS, pa.int64())
    yield pa.record_batch([
        none, none, none, pa.nulls(SKETCH_PARTS, pa.list_(pa.int64())), pa.array(range(SKETCH_PARTS), pa.int32()),
        pa.array([p.tobytes() for p in parts], pa.binary())], schema=schema)


def _add_counts(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(SKETCH // SKETCH_PARTS, dtype=np.int64)
    for counts in rows["counts"]:
        total += np.frombuffer(counts, dtype=np.uint16)
    # Two bytes keep the order wherever it matters: exact below 2^12, steps of 1/4096 of the value above.
    return pd.DataFrame({"part": rows["part"].iloc[:1], "counts": [_coarse(total).tobytes()]})


def _coarse(total: np.ndarray) -> np.ndarray:
    shift = np.maximum(0, np.frexp(np.maximum(total, 1).astype(np.float64))[1] - 12)
    return ((shift << 12) + (total >> shift)).astype(np.uint16)


def _rank_table(profile: DataFrame) -> np.ndarray:
    """The summed sketch: SKETCH numbers of two bytes (4 MB), whatever the size of the corpus."""
    parts = profile.filter("part is not null").select("part", "counts")
    summed = parts.groupBy("part").applyInPandas(_add_counts, "part int, counts binary")
    rows = sorted(summed.collect(), key=lambda r: r["part"])
    return np.concatenate([np.frombuffer(r["counts"], dtype=np.uint16) for r in rows]) if rows else np.zeros(SKETCH, np.uint16)


def least_shared(n):
    """ceil(0.75 n): what a set of n must at least share to link with any set as large."""
    return (PERCENT * n + 99) // 100


def spare(n):
    """l: how many leading entries linked sets have in common, the smaller of which has n."""
    return 1 + n // 50


def shared_by(n, m):
    """What sets of n and m share at least if they link."""
    return (PERCENT * (n + m) + 99 + PERCENT) // (100 + PERCENT)


def _leading(batches: Iterator[pa.RecordBatch], rank: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Leading entries of every document's row, rare columns first."""
    powers = tokens.Powers()
    names = ["doc_id", "node", "n", "entries"]
    for batch in batches:
        ids = batch.column(0)
        for first, raw, starts in tokens.chunks(batch.column(1)):
            sets = tokens.shingle_sets(raw, starts, powers)
            entries = []
            for s in sets:
                keep = min(len(s), len(s) - least_shared(len(s)) + spare(len(s)))
                order = np.argsort(rank[(s & np.uint64(SKETCH - 1)).astype(np.int64)], kind="stable")
                entries.append(s[order[:keep]].tobytes())
            yield pa.record_batch([
                ids.slice(first, len(sets)), pa.array(node_ids(sets)),
                pa.array([len(s) for s in sets], pa.int64()), pa.array(entries, pa.binary())], names=names)


def _packets(batches: Iterator[pa.RecordBatch], blocks: int) -> Iterator[pa.RecordBatch]:
    """Entries of many rows dealt into column blocks: per block the rows present and their columns."""
    names = ["block", "nodes", "comps", "bins", "sizes", "counts", "columns", "places"]
    for batch in batches:
        if not batch.num_rows:
            continue
        node, comp, bin_, n = (batch.column(i).to_numpy() for i in range(4))
        entries = [np.frombuffer(e.as_py(), dtype=np.uint64) for e in batch.column(4)]
        lengths = np.array([len(e) for e in entries])
        row = np.repeat(np.arange(len(entries)), lengths)
        place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        flat = np.concatenate(entries)
        block = (flat >> np.uint64(40)) % np.uint64(blocks)
        order = np.argsort(block, kind="stable")
        row, flat, block, place = row[order], flat[order], block[order], place[order].astype(np.int32)
        out: list[list] = [[] for _ in names]
        present, cuts = np.unique(block, return_index=True)
        for b, lo, hi in zip(present.tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(block)], strict=True):
            here, counts = np.unique(row[lo:hi], return_counts=True)
            for column, value in zip(out[1:], (
                node[here], comp[here], bin_[here], n[here].astype(np.int32), counts.astype(np.int32),
                (flat[lo:hi] & np.uint64(0xFFFFFFFF)).astype(np.uint32), place[lo:hi]), strict=True):
                column.append(value.tobytes())
            out[0].append(b)
        yield pa.record_batch([pa.array(out[0], pa.int32()), *(pa.array(c, pa.binary()) for c in out[1:])], names=names)


def _multiply(rows: pd.DataFrame) -> pd.DataFrame:
    """Overlap counts within one column block, of pairs from different groups that may link."""
    def flat(name, kind):
        return np.concatenate([np.frombuffer(x, dtype=kind) for x in rows[name]])

    nodes, comps, sizes = flat("nodes", np.int64), flat("comps", np.int64), flat("sizes", np.int32).astype(np.int64)
    row = np.repeat(np.arange(len(nodes)), flat("counts", np.int32))
    column, place, bins = flat("columns", np.uint32), flat("places", np.int32), flat("bins", np.int64)
    order = np.lexsort((sizes[row], column))
    row, column, place = row[order], column[order], place[order]
    starts = np.flatnonzero(np.r_[True, column[1:] != column[:-1]])
    lengths = np.diff(np.r_[starts, len(column)])
    group = comps[row]
    mixed = np.minimum.reduceat(group, starts) != np.maximum.reduceat(group, starts)
    keep = np.repeat(mixed, lengths)
    row, place, group = row[keep], place[keep], group[keep]
    bin_, size, ends = bins[row], sizes[row], np.repeat(np.cumsum(lengths[mixed]), lengths[mixed])
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    found: list[np.ndarray] = []
    held, step = 0, 1

    def fold(keys, counts):
        own, where = np.unique(np.concatenate([keys, *found]), return_inverse=True)
        weights = np.concatenate([counts, np.ones(len(where) - len(counts), np.int64)])
        return own, np.bincount(where, weights=weights, minlength=len(own)).astype(np.int64)

    # Sizes rise within a column. The smaller of a pair must have the entry among its first seventh or so.
    at = np.flatnonzero(place < size - shared_by(size, size) + spare(size))
    while len(at):
        at = at[at + step < ends[at]]
        at = at[100 * size[at] >= PERCENT * size[at + step]]
        n, m = size[at], size[at + step]
        s = shared_by(n, m) - spare(n)
        pair = at[(place[at] < n - s) & (place[at + step] < m - s) & (group[at] != group[at + step])]
        pair = pair[(bin_[pair] == 0) | (bin_[pair] != bin_[pair + step])]
        if len(pair):
            a, b = row[pair], row[pair + step]
            found.append(np.minimum(a, b).astype(np.int64) * len(nodes) + np.maximum(a, b))
            held += len(pair)
            if held > 4_000_000:
                keys, counts = fold(keys, counts)
                found, held = [], len(keys)
        step += 1
    keys, counts = fold(keys, counts)
    a, b = np.divmod(keys, max(1, len(nodes)))
    flip = nodes[a] > nodes[b]
    a, b = np.where(flip, b, a), np.where(flip, a, b)
    return pd.DataFrame({"a": nodes[a], "b": nodes[b], "least": spare(np.minimum(sizes[a], sizes[b])), "shared": counts})


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = tokens.Powers()
    for batch in batches:
        for _, raw, starts in tokens.chunks(batch.column(0)):
            sets = tokens.shingle_sets(raw, starts, powers)
            yield pa.record_batch([pa.array(node_ids(sets)), pa.array([s.tobytes() for s in sets], pa.binary())],
                                  names=["node", "entries"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose whole sets link."""
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        good = np.zeros(len(a), dtype=bool)
        for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            x, y = (np.frombuffer(e.as_buffer(), dtype=np.uint64) for e in (x, y))
            if PERCENT * max(len(x), len(y)) > 100 * min(len(x), len(y)):
                continue
            both = np.sort(np.concatenate([x, y]), kind="stable")
            shared = int((both[1:] == both[:-1]).sum())
            good[i] = 100 * shared >= PERCENT * (len(x) + len(y) - shared)
        yield pa.record_batch([pa.array(a[good]), pa.array(b[good])], names=["a", "b"])


def _tile(rows: pd.DataFrame) -> pd.DataFrame:
    """Links that span what links within a tile, by the product of its rows over all their columns."""
    nodes = rows["node"].to_numpy()
    left = np.flatnonzero(rows["part"].to_numpy() == rows["low"].to_numpy())
    right = np.flatnonzero(rows["part"].to_numpy() == rows["high"].to_numpy())
    sets = [np.frombuffer(e, dtype=np.uint64) for e in rows["entries"]]
    sizes = np.array([len(x) for x in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    df = np.bincount(column)
    rank = np.cumsum(df > 1) - 1
    keep = df[column] > 1
    row, column = row[keep], rank[column[keep]]
    shared = np.zeros((len(left), len(right)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width_, last = 4096, int(column[-1]) + 1 if len(column) else 0
    for lo in range(0, last, width_):
        a, b = np.searchsorted(column, [lo, lo + width_])
        dense = np.zeros((len(sets), min(width_, last - lo)), dtype=np.float32)
        dense[row[a:b], column[a:b] - lo] = 1
        shared += dense[left] @ dense[right].T
    union = sizes[left][:, None] + sizes[right][None, :] - shared
    a, b = np.nonzero(100 * shared >= PERCENT * union)
    a, b = left[a], right[b]
    root = np.arange(len(nodes))
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            break
    more = np.flatnonzero(root != np.arange(len(nodes)))
    return pd.DataFrame({"a": nodes[more], "b": nodes[root[more]]})


def _sets(nodes: DataFrame, used: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, entries) of the used nodes, made anew from the texts."""
    used = light(land(nodes.join(used, "node").select("node", F.col("doc_id").alias("owner")), "used"))
    sets = (docs.join(used.select("owner"), F.col("doc_id").eqNullSafe(F.col("owner")), "left_semi").select("text")
            .mapInArrow(_whole_sets, "node long, entries binary"))
    return land(sets.join(used, "node", "left_semi").dropDuplicates(["node"]), "sets")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that link, by their whole sets."""
    first = sets.select(F.col("node").alias("a"), F.col("entries").alias("x"))
    second = sets.select(F.col("node").alias("b"), F.col("entries").alias("y"))
    both = pairs.select("a", "b").join(first, "a").join(second, "b").select("a", "b", "x", "y")
    return land(both.mapInArrow(_compare, "a long, b long"), "linked")


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, node) for every row of a table of documents.

    `component_id` is the smallest id reachable by links, the own id included; `node` is equal for
    rows with equal shingle sets. Null and empty texts, and texts of white space only, have the empty
    set, link with nothing and keep their own id, as does a row with a null id that links with nothing.
    Repeated rows each come back once more. Where ids repeat with different texts, each row counts.
    A class whose rows all have null ids has a null component. Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    profile = land(docs.mapInArrow(_profile, PROFILE), "profile")
    rows = profile.filter("part is null").select("doc_id", "n_shingles", "node")
    # One row per distinct set, named by its smallest id, which tells where its text stands; equal sets have equal bands.
    nodes = land(profile.filter("part is null and n_shingles > 0").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "nodes")

    banded = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = land(banded.groupBy("band", "key").agg(
        F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("count")).filter("low < high"), "buckets")
    star = (banded.join(buckets, ["band", "key"]).select("node", F.explode(F.array("low", "high")).alias("head"))
            .filter("node != head")
            .select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct())
    star = land(star, "star")
    sized = buckets.filter(F.col("count").between(DENSE_LEAST, DENSE_MOST)).select("band", "key", "count")
    dense = land(
        banded.join(sized, ["band", "key"]).groupBy("node")
        .agg(F.max(F.struct("count", "band", "key")).alias("b"))
        .select("node", F.xxhash64("b.band", "b.key").alias("bin"), F.ceil(F.col("b.count") / TILE).cast("int").alias("parts"))
        .withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int")), "dense")
    sets = _sets(nodes, _ends(star).union(dense.select("node")).distinct(), docs)
    tiles = (dense.join(sets, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("node", "entries", "bin", "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")))
    spans = land(tiles.groupBy("bin", "low", "high").applyInPandas(_tile, "a long, b long"), "spans")
    links = _linked(star, sets).union(spans)
    groups = components(links)

    known = (nodes.join(groups, "node", "left").join(dense.select("node", "bin"), "node", "left")
             .select(F.col("doc_id").alias("owner"), "node", F.coalesce("comp", "node").alias("comp"),
                     F.coalesce("bin", F.lit(0)).alias("bin")))
    leading = docs.mapInArrow(partial(_leading, rank=_rank_table(profile)), "doc_id long, node long, n long, entries binary")
    matrix = (leading.filter("n > 0").join(known, "node").filter("doc_id <=> owner")
              .select("node", "comp", "bin", "n", "entries"))
    packed = matrix.mapInArrow(
        partial(_packets, blocks=2 * width(docs)),
        "block int, nodes binary, comps binary, bins binary, sizes binary, counts binary, columns binary, places binary")
    product = packed.groupBy("block").applyInPandas(
        _multiply, "a long, b long, least long, shared long")
    pairs = land(
        product.groupBy("a", "b").agg(F.first("least").alias("least"), F.sum("shared").alias("shared"))
        .filter("shared >= least").select("a", "b", "shared"), "pairs")
    # Each row's best partner first: once it links, the others of its group need not be compared.
    best = (pairs.union(pairs.select("b", "a", "shared")).groupBy("a")
            .agg(F.max_by("b", F.struct("shared", "b")).alias("b"))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    best = land(best, "best")
    links = links.union(_linked(best, _sets(nodes, _ends(best), docs)))
    groups = components(links)
    left = (pairs.join(best, ["a", "b"], "left_anti")
            .join(groups.select(F.col("node").alias("a"), F.col("comp").alias("ga")), "a", "left")
            .join(groups.select(F.col("node").alias("b"), F.col("comp").alias("gb")), "b", "left")
            .filter("ga is null or gb is null or ga != gb").select("a", "b"))
    left = land(left, "left")
    if left.limit(1).count():
        links = links.union(_linked(left, _sets(nodes, _ends(left), docs)))
        groups = components(links)

    named = nodes.join(groups, "node", "left").select("node", "doc_id", F.coalesce("comp", "node").alias("comp"))
    least = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    owner = named.join(least, "comp").select("node", "component_id")
    full = rows.filter("n_shingles > 0").join(owner, "node").select("doc_id", "n_shingles", "component_id", "node")
    empty = rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "node")
    return full.unionByName(empty)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents with one row of each class kept, the one with the smallest id; all columns stay.

    Each row goes by its own text: rows that repeat an id with different texts are different documents.
    Rows without words link with nothing and stay. A row without an id stays only where its class has no row with one,
    and then one such row does.
    """
    row = free_name(docs, ROW)
    rows = numbered(docs, row)
    classes = jaccard_classes(rows, row, text_col).select(F.col("doc_id").alias(row), "component_id")
    ids = rows.select(row, F.col(f"`{id_col}`").cast("long").alias("_id"))
    classes = land(classes.join(ids, row), "classes")
    first = (classes.groupBy("component_id").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", row)).alias("first"))
             .select(F.col(f"first.{row}").alias(row)))
    lost = light(land(classes.join(first, row, "left_anti").select(row), "lost"))
    return rows.join(lost, row, "left_anti").select(*(f"`{c}`" for c in docs.columns))


def class_sizes(classes: DataFrame) -> DataFrame:
    """(component_id, rows, texts): how many rows and distinct sets each class holds."""
    return classes.groupBy("component_id").agg(F.count("*").alias("rows"), F.countDistinct("node").alias("texts"))
