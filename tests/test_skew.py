"""Groups that hold most of the rows: results stay exact and no task receives the whole group."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.functions.similarity import TargetBlock, pair_score
from labelloom.operators import matching, ranking, sampling
from labelloom.operators.frontier import pareto_front


@pytest.fixture(scope="module")
def skewed(spark):
    """12,000 rows; group 0 holds two thirds."""
    group = F.when(F.col("id") % 3 != 0, 0).otherwise(F.col("id") % 7 + 1)
    return spark.range(12_000).select("id", group.alias("g"), ((F.col("id") * 7919) % 1009).alias("v"))


def _order(i, seed):
    return hashlib.md5(f"{i}-{seed}".encode()).hexdigest(), i


def _groups(df):
    found = defaultdict(list)
    for r in df.collect():
        found[r.g].append(r.id)
    return found


def test_shuffled_ranks(skewed):
    ranked = sampling.shuffled(skewed, ["g"], "id", 5)
    got = {r.id: (r.rank, r.group_size) for r in ranked.collect()}
    want = {}
    for ids in _groups(skewed).values():
        for rank, i in enumerate(sorted(ids, key=lambda i: _order(i, 5)), 1):
            want[i] = (rank, len(ids))
    assert got == want


def test_hot_group_is_split_over_buckets(skewed):
    hashed = skewed.withColumn("b", ranking.hash_bucket(F.md5(F.col("id").cast("string").cast("binary"))))
    widest = hashed.groupBy("g", "b").count().agg(F.max("count")).first()[0]
    assert widest < 8000 / 100


def test_folds_partition_each_stratum(skewed):
    folded = sampling.kfold(skewed, 3, "id", 1, ["g"])
    sizes = defaultdict(list)
    for r in folded.groupBy("g", "fold").count().collect():
        sizes[r.g].append(r["count"])
    assert folded.count() == 12_000
    assert all(len(s) == 3 and max(s) - min(s) <= 1 for s in sizes.values())


def test_multilabel_folds_are_balanced(spark):
    parts = [f"p{i}" for i in range(5)]
    columns = [(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(100)) < 3 + 12 * i).cast("int").alias(p) for i, p in enumerate(parts)]
    df = spark.range(6000).select("id", *columns)
    folded = sampling.kfold_multilabel(df, parts, 2, "id", 1)
    shares = {r.fold: r for r in folded.groupBy("fold").agg(*[F.avg(p).alias(p) for p in parts], F.count("*").alias("n")).collect()}
    assert abs(shares[0].n - shares[1].n) <= 40  # at most one row per stratum
    assert max(abs(shares[0][p] - shares[1][p]) for p in parts) < 0.01


def test_capped_sample_and_split(skewed):
    kept = Counter(r.g for r in sampling.sample_n_per(skewed, ["g"], "id", 2500, 1).collect())
    assert all(kept[g] == min(2500, len(ids)) for g, ids in _groups(skewed).items())
    split = sampling.split_stratified(skewed, "g", "id", 0.2, 1).filter("split = 'test'").groupBy("g").count().collect()
    assert all(r["count"] == round(0.2 * len(_groups(skewed)[r.g])) for r in split)


@pytest.mark.parametrize("n", [5, 3000])
def test_top_n_of_a_hot_group(skewed, n):
    got = ranking.top_n_per(skewed, ["g"], [F.desc("v"), F.col("id")], n)
    rows = {(r.g, r["rank"]): r.id for r in got.collect()}
    table = defaultdict(list)
    for r in skewed.collect():
        table[r.g].append((-r.v, r.id))
    assert rows == {(g, k): i for g, members in table.items() for k, (_, i) in enumerate(sorted(members)[:n], 1)}


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_quantiles_with_a_hot_value(spark, accuracy):
    values = np.concatenate([np.full(4000, 3.5), np.random.default_rng(1).normal(size=8001)])
    df = spark.createDataFrame([(float(x),) for x in values] + [(None,)], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.6, 0.9, 1.0]
    got = {r.prob: r.quantile for r in ranking.exact_quantile(df, "x", probs, accuracy).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(values, p), abs=1e-12)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 11])
def test_quantiles_of_few_rows(spark, n):
    values = [float((i * 37) % 11) for i in range(n)]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    probs = [0.1, 0.25, 0.6, 0.8, 0.9]
    got = {r.prob: r.quantile for r in ranking.exact_quantile(df, "x", probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(values, p), abs=1e-12)


def test_range_buckets_follow_the_order_and_are_even(spark):
    df = spark.range(20_000).select((F.pmod(F.xxhash64("id"), F.lit(1_000_003)) - 500_000).cast("double").alias("x"))
    bucketed = ranking.range_bucketed(df, "x")
    sizes = bucketed.groupBy("_range").agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    found = sizes.orderBy("_range").collect()
    assert [r._range for r in found] == list(range(256)) and max(r.n for r in found) < 160
    assert all(a.hi < b.lo for a, b in zip(found, found[1:]))


def test_running_mean(spark):
    df = spark.range(5000).select((F.col("id") * 3).alias("k"), (F.col("id") % 11).alias("x"))
    got = {r.k: (r["rank"], r.running_mean) for r in ranking.running_mean(df, "k", "x").collect()}
    total = 0.0
    for i in range(5000):
        total += i % 11
        assert got[3 * i] == (i + 1, pytest.approx(total / (i + 1)))


def _slow_score(a, b):
    """Textbook version of the similarity, with a quadratic table."""
    ta, tb = set(a.split()), set(b.split())
    both, left, right = sorted(ta & tb), sorted(ta - tb), sorted(tb - ta)
    if both and (not left or not right):
        return 100.0

    def ratio(x, y):
        table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, p in enumerate(x):
            for j, q in enumerate(y):
                table[i + 1][j + 1] = table[i][j] + 1 if p == q else max(table[i][j + 1], table[i + 1][j])
        total = len(x) + len(y)
        return 100.0 * 2 * table[-1][-1] / total if total else 0.0

    head = " ".join(both)
    x, y = " ".join(both + left), " ".join(both + right)
    return max(ratio(x, y), ratio(head, x) if both else 0.0, ratio(head, y) if both else 0.0)


WORDS = ["bumper", "bumpers", "front", "rear", "lh", "rh", "lamp", "headlamp", "door", "panel", "fender", "grille"]


def _texts(n):
    rng = np.random.default_rng(3)
    return sorted({" ".join(rng.choice(WORDS, size=rng.integers(1, 5))) for _ in range(n)} | {"x" * 70 + " lamp"})


def test_similarity_against_textbook():
    texts = _texts(40)
    for a in texts:
        for b in texts:
            assert pair_score(frozenset(a.split()), frozenset(b.split())) == pytest.approx(_slow_score(a, b))


def _slow_best(text, targets, cutoff):
    scores = [pair_score(frozenset(text.split()), frozenset(t.split())) for t in targets]
    best = max(range(len(targets)), key=lambda i: (scores[i], -i))
    return (best, scores[best]) if scores[best] >= cutoff else None


@pytest.mark.parametrize("cutoff", [0.0, 35.0, 60.0, 100.0])
def test_pruned_matches_are_those_of_all_pairs(cutoff):
    rng = np.random.default_rng(4)
    letters = list("abcdeé`fg ")
    texts = ["", "a", "x" * 200, "long " * 40 + "tail", "tail long"] + ["".join(rng.choice(letters, size=rng.integers(1, 90))) for _ in range(150)]
    targets = ["", "tail", "x" * 150] + ["".join(rng.choice(letters, size=rng.integers(1, 90))) for _ in range(60)]
    block = TargetBlock(targets)
    for text in texts + _texts(30):
        got, want = block.best(text, cutoff), _slow_best(text, targets, cutoff)
        assert (got and (got[0], pytest.approx(got[1]))) == want


def test_few_pairs_are_compared():
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), size=rng.integers(3, 10))) for _ in range(400)]
    targets = sorted({" ".join(rng.choice(words, size=rng.integers(2, 6))) for _ in range(500)})
    texts = []
    for i in range(300):  # words added, lost and misspelt, and strangers
        own = rng.choice(targets).split()
        own += [str(rng.choice(words))] * (i % 3 == 0)
        texts.append(" ".join(w[:2] + "z" + w[3:] if i % 2 else w for w in own) if i % 5 else " ".join(rng.choice(words, size=3)))
    block = TargetBlock(targets)
    for text in texts:
        assert block.best(text, 60) == _slow_best(text, targets, 60)
    assert 0 < block.scored < len(texts) * len(targets) / 10


def test_fuzzy_matches_in_blocks(spark, monkeypatch):
    texts = _texts(60)
    counts = {t: (40 if i % 4 == 0 else 1 + i % 3) for i, t in enumerate(texts)}
    df = spark.createDataFrame([(t, n) for t, n in counts.items()], "text string, count long")
    bound = 0.5 * len(texts)
    majors = [t for t in texts if counts[t] > bound]
    want = {t: t for t in majors}
    for t in texts:
        if t not in want:
            score, _, best = max((( _slow_score(t, m), counts[m], m) for m in majors), key=lambda x: (x[0], x[1]))
            best = min(m for m in majors if abs(_slow_score(t, m) - score) < 1e-9)
            want[t] = best if score >= 60 else "none"
    for size in (1000, 4):  # one block, then many
        monkeypatch.setattr(matching, "TEXTS_PER_BLOCK", size)
        monkeypatch.setattr(matching, "TARGETS_PER_BLOCK", size)
        got = {r.text: r.match for r in matching.fuzzy_matches(df, 50, 60).collect()}
        assert got == want


def test_fuzzy_group_keeps_null_and_hot_rows(spark):
    df = spark.createDataFrame([("front bumper",)] * 50 + [("bumper front lh",), ("zzz",), (None,)], "d string")
    got = Counter((r.d, r.m) for r in matching.fuzzy_group(df, "d", 100, 60, "m").collect())
    assert got == {("front bumper", "front bumper"): 50, ("bumper front lh", "front bumper"): 1, ("zzz", "none"): 1, (None, None): 1}


@pytest.mark.parametrize("chunk", [20_000, 7])
def test_pareto_front_in_chunks(spark, monkeypatch, chunk):
    import labelloom.operators.frontier as frontier

    monkeypatch.setattr(frontier, "CANDIDATES_PER_CHUNK", chunk)
    rng = np.random.default_rng(2)
    points = [(i, int(a), int(b), int(c)) for i, (a, b, c) in enumerate(rng.integers(0, 12, size=(300, 3)))]
    df = spark.createDataFrame(points, "id long, a long, b long, c long")
    want = {
        p[0] for p in points
        if not any(all(x >= y for x, y in zip(q[1:], p[1:])) and q[1:] != p[1:] for q in points)
    }
    assert {r.id for r in pareto_front(df, "id", ["a", "b", "c"]).collect()} == want


def test_pareto_front_ranks_nulls_last(spark, monkeypatch):
    import labelloom.operators.frontier as frontier

    inf, nan = float("inf"), float("nan")
    values = [None, nan, -inf, -2.5, -0.0, 0.0, 1e-300, 7.0, inf]
    points = [(i, a, b) for i, (a, b) in enumerate((a, b) for a in values for b in values)]
    points += [(100, 7.0, 7.0), (101, None, None)]
    rank = {None: 0, -inf: 1, -2.5: 2, 0.0: 3, 1e-300: 4, 7.0: 5, inf: 6}

    def place(p):
        return [rank[None if x is None or x != x else x] for x in p[1:]]

    for upto in (81, 100, len(points)):
        given = [p for p in points if p[1] != inf and p[2] != inf or p[0] % 7 == 0][:upto]
        want = {p[0] for p in given if not any(
            all(x >= y for x, y in zip(place(q), place(p))) and place(q) != place(p) for q in given)}
        df = spark.createDataFrame(given, "id long, a double, b double")
        for chunk in (20_000, 5):
            monkeypatch.setattr(frontier, "CANDIDATES_PER_CHUNK", chunk)
            assert {r.id for r in pareto_front(df, "id", ["a", "b"]).collect()} == want


def test_cells_of_a_long_front_seldom_meet():
    from labelloom.operators.frontier import meeting_cells, order_keys

    rng = np.random.default_rng(1)
    x = rng.random(1_000_000)
    for points, most in ((np.stack([x, -x], axis=1), 0.06), (np.stack([x, rng.random(len(x))], axis=1), 0.003)):
        side = 22
        place = np.stack([np.searchsorted(np.quantile(c, np.arange(1, side) / side), c) for c in points.T])
        cell = place[0] * side + place[1]
        names, sizes = np.unique(cell, return_counts=True)
        keys = order_keys(points)
        order = np.argsort(cell, kind="stable")
        starts = np.searchsorted(cell[order], names)
        pairs = meeting_cells(np.minimum.reduceat(keys[order], starts), np.maximum.reduceat(keys[order], starts))
        size = dict(enumerate(sizes.tolist()))
        assert sum(size[a] * size[b] for a, b in pairs) < most * len(x) ** 2


def test_ranges_are_cut_by_row_count(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BUCKET_ROWS", 50)
    df = spark.range(100_000).select((F.col("id") * 37 % 100_003).alias("x"), F.lit(1.0).alias("v"))
    sizes = ranking.range_bucketed(df, "x").groupBy("_range").agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    found = sizes.orderBy("_range").collect()
    assert max(r.n for r in found) <= 100 and sum(r.n for r in found) == 100_000
    assert all(a.hi < b.lo for a, b in zip(found, found[1:]))
    means = ranking.running_mean(df.select("x", F.col("x").alias("y")), "x", "y", every=997).collect()
    xs = np.sort((np.arange(100_000) * 37) % 100_003)
    assert {r["rank"]: r.running_mean for r in means} == {
        k: pytest.approx(xs[:k].mean()) for k in range(997, 100_001, 997)}


def test_quantiles_narrow_their_brackets(spark, monkeypatch):
    rng = np.random.default_rng(3)
    probs = [0.0, 0.001, 0.3, 0.5, 0.77, 1.0]
    for values in (rng.random(60_000), np.round(rng.normal(size=60_000), 2), np.r_[np.zeros(50_000), rng.random(10_000)], np.arange(3.0)):
        df = spark.createDataFrame([(float(x),) for x in values], "x double").repartition(4)
        data = df.select(F.col("x").alias("_v")).cache()
        monkeypatch.setattr(ranking, "BUCKET_ROWS", 60)
        n, brackets = ranking._brackets(data, probs, 400)
        assert n == len(values)
        for lo, hi in brackets:
            assert len(np.unique(values[(values > lo) & (values < hi)])) <= 60
        got = {r.prob: r.quantile for r in ranking.exact_quantile(df, "x", probs, 400).collect()}
        assert got == {p: pytest.approx(np.quantile(values, p), abs=1e-12) for p in probs}
