"""Clusters and codes against plain k-means over all pairs, with the awkward rows."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from labelloom.llm import clusters, codes, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance string, vec string, d string"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], schema)


def complete(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def whole(v, scale):
    return [max(-vectors.MOST, min(vectors.MOST, math.floor(float(np.float32(x)) * scale))) for x in v]


def distance(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def kmeans(points, centres, rounds):
    """Plain k-means in Python's own numbers; the last assignment and the centres."""
    def nearest(p):
        return min(range(len(centres)), key=lambda g: (distance(p, centres[g]), g))
    for _ in range(rounds):
        groups = {}
        for p in points:
            groups.setdefault(nearest(p), []).append(p)
        centres = [[sum(c) // len(groups[g]) for c in zip(*groups[g], strict=True)] if g in groups else centres[g]
                   for g in range(len(centres))]
    return [nearest(p) for p in points], centres


def brute_clusters(rows, k=40, rounds=5, dim=64, scale=256):
    kept = [(i, whole(v, scale)) for i, v, _ in rows if complete(v) and len(v) == dim]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    got, centres = kmeans([v for _, v in kept], [v for _, v in order[:k]], rounds)
    gaps = [distance(v, centres[g]) for (_, v), g in zip(kept, got, strict=True)]
    per = Counter()
    for g, d in zip(got, gaps, strict=True):
        per[g] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, g, d, per[g], sum(gaps), sha[g]) for (i, _), g, d in zip(kept, got, gaps, strict=True))


def brute_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, whole(v, scale), label) for i, v, label in rows if complete(v)]
    size = len(kept[0][1]) // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    cut = lambda v, p: v[p * size:(p + 1) * size]
    per_part = [kmeans([cut(v, p) for _, v, _ in kept], [cut(v, p) for _, v, _ in first], rounds) for p in range(parts)]
    errors = [sum(distance(cut(v, p), per_part[p][1][per_part[p][0][n]]) for p in range(parts)) for n, (_, v, _) in enumerate(kept)]
    labels = Counter()
    for (_, _, label), e in zip(kept, errors, strict=True):
        labels[label] += e
    sha = hashlib.sha256(",".join(str(x) for _, book in per_part for entry in book for x in entry).encode()).hexdigest()
    return Counter((i, "".join(f"{per_part[p][0][n]:02x}" for p in range(parts)), errors[n], labels[label], sha)
                   for n, (i, _, label) in enumerate(kept))


def near_groups(n, dim, groups, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.4, (groups, dim))
    return [[float(np.float32(x)) for x in centres[i % groups] + rng.normal(0, 0.1, dim)] for i in range(n)]


@pytest.fixture(scope="module")
def rows_64():
    """Groups, points on a coarse grid (many ties), repeats of rows, and rows that must go."""
    rows = [(i, v, i % 3) for i, v in enumerate(near_groups(150, 64, 6, 1))]
    rng = np.random.default_rng(2)
    rows += [(200 + i, [float(x) / 2 for x in rng.integers(-1, 2, 64)], None) for i in range(40)]
    rows += [(300 + i, [0.25 * (j == i % 4) for j in range(64)], 7) for i in range(60)]
    rows += [rows[0], rows[0], (5, [1.0] * 64, None), (None, [0.5] * 64, 1), (None, [0.125] * 64, 1), (-9, [-1e6] * 64, 2), (10**17, [3.0e38] * 64, 2)]
    odd = [(1, None, 0), (2, [None] + [0.0] * 63, 0), (3, [math.nan] + [0.0] * 63, 1), (4, [math.inf] + [0.0] * 63, 1),
           (6, [-math.inf] * 64, None)]
    return rows + odd


def test_clusters(spark, rows_64):
    rows = [*rows_64, (7, [], 0), (8, [0.0] * 63, 0), (9, [0.0] * 65, 0)]
    got = Counter(tuple(r) for r in clusters.clusters(table(spark, rows).repartition(7)).collect())
    assert got == brute_clusters(rows)


@pytest.mark.parametrize("k, rounds, n", [(1, 2, 30), (2, 3, 30), (50, 2, 20), (3, 0, 25)])
def test_clusters_small(spark, k, rounds, n):
    rows = [(i % 17, v, None) for i, v in enumerate(near_groups(n, 4, 3, k))]
    got = Counter(tuple(r) for r in clusters.clusters(table(spark, rows), k, rounds, 4).collect())
    assert got == brute_clusters(rows, k, rounds, 4)


def test_clusters_of_nothing(spark):
    empty = clusters.clusters(table(spark, [(1, None, 0)]))
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_shallot_search_skips():
    """All but the first core are searched at first, few once the groups are found, and none gets another centroid."""
    x = np.array([whole(v, 256) for v in near_groups(3000, 16, 30, 3)], dtype=np.int64)
    centres, before = x[:30].copy(), None
    first, second = np.zeros(len(x), np.int64), np.ones(len(x), np.int64)
    upper, lower, searched = np.full(len(x), np.inf), np.zeros(len(x)), []
    for _ in range(8):
        known = clusters.Neighbours(centres, before)
        first, second, upper, lower, n = clusters.assign(x, first, second, upper, lower, known)
        searched.append(n)
        gaps = np.stack([vectors.squared(x, c[None, :]) for c in centres], axis=1)
        assert (first == gaps.argmin(axis=1)).all()
        assert (upper * (1 + 1e-9) >= np.sqrt(gaps[np.arange(len(x)), first])).all()
        gaps[np.arange(len(x)), first] = np.iinfo(np.int64).max
        assert (lower <= np.sqrt(gaps.min(axis=1)) * (1 + 1e-9)).all()
        centres, before = np.stack([x[first == g].sum(axis=0) // max(1, (first == g).sum()) if (first == g).any() else centres[g]
                                    for g in range(30)]), centres
    assert searched[0] > 0.9 * len(x) and searched[-1] < len(x) / 10


def test_codes(spark, rows_64):
    # Distances of clipped components overflow nothing; the sum over a label may be held to the largest long.
    rows = [r for r in rows_64 if r[0] != 10**17]
    got = Counter(tuple(r) for r in codes.codes(table(spark, rows).repartition(5)).collect())
    assert got == brute_codes(rows)


def test_codes_of_few_and_other_lengths(spark):
    rows = [(i, v, "a") for i, v in enumerate(near_groups(5, 16, 2, 4))]
    schema = SCHEMA.replace("label int", "label string")
    got = Counter(tuple(r) for r in codes.codes(table(spark, [*rows, (99, [0.5] * 8, "b"), (98, [0.5] * 7, None), (97, [], "a")], schema)).collect())
    assert got == brute_codes(rows)
    assert codes.codes(table(spark, [(1, [0.5] * 7, None), (2, [], None), (3, None, 1)], schema.replace("string", "int", 1))).count() == 0
    no_label = table(spark, rows, schema).drop("label")
    assert Counter(tuple(r) for r in codes.codes(no_label).collect()) == brute_codes([(i, v, None) for i, v, _ in rows])


def test_balls_restrict(spark):
    """Rings and stable cores spare most comparisons, and every part has its nearest entry all the same."""
    x = np.array([whole(v, 4096) for v in near_groups(4000, 8, 16, 5)], dtype=np.int64)
    entries, before, radii, tried = x[:16].copy(), None, None, []
    code, d = np.zeros(len(x), np.int64), vectors.squared(x, x[:1])
    for _ in range(7):
        tried.append(codes.assign(x, code, d, codes.Balls(entries, before, radii)))
        gaps = np.stack([vectors.squared(x, e[None, :]) for e in entries], axis=1)
        assert (code == gaps.argmin(axis=1)).all() and (d == gaps.min(axis=1)).all()
        radii = np.array([d[code == g].max(initial=0) for g in range(16)])
        entries, before = np.stack([x[code == g].sum(axis=0) // max(1, (code == g).sum()) if (code == g).any() else entries[g]
                                    for g in range(16)]), entries
    assert tried[-1] < len(x) * 15 / 4


def test_largest_long(spark):
    rows = [(i, [3e38 if i % 2 else -3e38] * 64, 0) for i in range(6)]
    got = clusters.clusters(table(spark, rows), 1, 0).collect()
    assert max(r["distance"] for r in got) == 64 * (2 * vectors.MOST) ** 2 and got[0]["inertia"] == vectors.LARGEST
