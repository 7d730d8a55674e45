"""Quality classifier, mixture and language model: bounds, held-out accuracy, exact counts, awkward rows."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from labelloom.llm import language, mixture, quality, tokens

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label int, rate double, words string"


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (None, "two three"), (5, "word " * 80_000), (6, "é" * 500)]
    return spark.createDataFrame([(i, t, "en", "s", 1, 0, 0.0, "x") for i, t in rows], SCHEMA)


def test_quality_held_out(given):
    docs, labels = given
    scores = {r["doc_id"]: r for r in quality.quality_scores(docs, labels).collect()}
    assert len(scores) == docs.count()
    for i, r in scores.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(r["quality"], scores[r["doc_id"]]) for r in labels.collect() if scores[r["doc_id"]]["held_out"]]
    right = np.mean([q == s["predicted"] for q, s in held])
    assert right >= 0.95 and len(held) > 50


def plain_features(text):
    """Counts of word buckets and of character buckets of one text, feature by feature."""
    raw = text.encode()
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in raw)
    mask = (1 << 64) - 1

    def mix(h):
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
            h = (h ^ (h >> shift)) * factor & mask
        return h ^ (h >> 33)

    hashes, words = [], re.findall(rb"[^\t\n\x0b\f\r ]+", low)
    for k, word in enumerate(words):
        own = mix((sum((b + 1) * pow(tokens._BASE, j, 1 << 64) for j, b in enumerate(word)) + len(word)) & mask)
        hashes.append(int(quality._REPEAT) if k and word == words[k - 1] else own)
    pairs = [mix((a * 3 + b) & mask) for a, b in zip(hashes, hashes[1:], strict=False)]
    shift = 64 - quality.BITS
    chars = Counter()
    code = [32 if b in b"\t\n\x0b\f\r " else b for b in raw]
    for i in range(len(code) - 2):
        a, b, c = code[i:i + 3]
        three = a | b << 8 | c << 16
        if b != 32:
            chars[(three * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - quality.BITS)] += 1
        if i + 3 < len(code) and b != 32 and c != 32:
            four = three | code[i + 3] << 24
            chars[((four ^ (four >> 15)) * 0x85EBCA6B & 0xFFFFFFFF) >> (32 - quality.BITS)] += 1
    return Counter(h >> shift for h in hashes + pairs), chars


@pytest.mark.parametrize("chunk", [7, 16, 64, 1 << 18])
def test_quality_features_in_pieces(monkeypatch, chunk):
    """Long texts are cut into pieces without a feature more or less, words longer than a piece included."""
    import pyarrow as pa

    monkeypatch.setattr(quality, "CHUNK", chunk)
    texts = ["one two two two three " * 9, "x" * 300, " a  b " + "y" * 90 + " y y", "", None, "é" * 33 + " Zz zZ", " ", "ab", "q " * 40 + "end"]
    powers, got = tokens.Powers(), {}
    for first, raw, starts in tokens.chunks(pa.array(texts), quality.CHUNK):
        for kind, buckets, owner in quality._buckets(raw, starts, powers):
            for b, o in zip(buckets.tolist(), owner.tolist(), strict=True):
                got.setdefault((first + o, kind), Counter())[b] += 1
    for k, text in enumerate(texts):
        for kind, want in enumerate(plain_features(text or "")):
            assert got.get((k, kind), Counter()) == want


def test_quality_scores_are_the_models(spark, given):
    """Scores are the softmax of the folded model over plain features."""
    docs, labels = given
    folded, bias = quality.fit(docs, labels)
    some = spark.createDataFrame([(i, t) for i, t in enumerate(["one two two", "", None, "Words of a text. " * 20])], "doc_id long, text string")
    for r in quality.quality_scores(some, labels.limit(0)).collect():
        assert r["score"] == 0.5
    scored = some.select("doc_id", "text").mapInArrow(quality.partial(quality._score, folded=folded, bias=bias), "doc_id long, score double")
    texts = {r["doc_id"]: r["text"] or "" for r in some.collect()}
    for r in scored.collect():
        z = bias
        for kind, counts in enumerate(plain_features(texts[r["doc_id"]])):
            z += 0.5 * sum(folded[kind * (1 << quality.BITS) + b] * n for b, n in counts.items()) / max(1, sum(counts.values()))
        assert abs(r["score"] - 1 / (1 + math.exp(-z))) < 1e-6


def test_quality_learns_from_one_row_an_id(spark):
    good, bad = "a fine clear text with many words in it", "zz zz zz zz zz zz"
    docs = spark.createDataFrame([(i, good if i % 2 else bad) for i in range(60)] + [(1, bad + " longer than the other text of this id " * 3)] * 50,
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    once = quality.fit(docs.filter("doc_id <> 1 or length(text) < 60"), labels)
    again = quality.fit(docs.repartition(5), labels)
    assert once[1] == again[1] and (once[0] == again[0]).all()
    assert quality.fit(docs, labels, most=10)[1] == 0.0


def test_quality_odd_rows(spark, given):
    docs, labels = given
    odd = odd_rows(spark)
    assert Counter(r["doc_id"] for r in quality.quality_scores(odd, labels).collect()) == Counter(r["doc_id"] for r in odd.collect())
    none = quality.quality_scores(odd, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.quality_scores(odd.limit(0), labels).count() == 0
    kept = quality.drop_bad(odd, labels)
    assert kept.columns == odd.columns
    clash = labels.selectExpr("doc_id", "quality", "toxic", "'x' as text")
    assert quality.quality_scores(docs, clash).count() == docs.count()


def test_mixture_meets_targets(given):
    docs, labels = given
    rows = mixture.mixture(docs, labels).toPandas()
    assert len(rows) == docs.count() and (rows["rate"] >= 0).all() and (rows["rate"] <= mixture.MAX_RATE).all()
    p = rows[["p_clean", "p_toxic", "p_junk"]].to_numpy()
    assert np.allclose(p.sum(1), 1)
    totals = (rows["rate"].to_numpy() * rows["tokens"].to_numpy()) @ p
    shares = totals / rows["tokens"].sum()
    for share, name in zip(shares, mixture.DOMAINS, strict=True):
        assert abs(share - mixture.TARGETS[name]) < 0.02
    assert abs(rows["copies"].mean() - rows["rate"].mean()) < 0.05


def test_rates_agree_with_numpy(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([1, 1, 1], 50)
    tokens_ = rng.integers(1, 100, 50)
    rated = spark.createDataFrame([(int(t), [float(x) for x in q]) for t, q in zip(tokens_, p, strict=True)], "tokens long, p array<double>")
    steps = mixture.fit_rates(rated, {"clean": 0.5, "toxic": 0.3, "junk": 0.2})
    rate = np.ones(50)
    for step in steps:
        rate = np.clip(rate - p @ np.array(step), 0, mixture.MAX_RATE)
    got = [r[0] for r in rated.select(mixture.rate_after(steps)).collect()]
    assert np.allclose(got, rate)
    assert np.allclose((rate * tokens_) @ p / tokens_.sum(), [0.5, 0.3, 0.2], atol=1e-3)


def test_rates_of_a_rare_domain(spark):
    rng = np.random.default_rng(5)
    p = np.array([[0.99, 0.002, 0.008]] * 900 + [[0.01, 0.002, 0.988]] * 95 + [[0.05, 0.949, 0.001]] * 5)
    tokens_ = rng.integers(50, 150, len(p))
    rated = spark.createDataFrame([(int(t), q.tolist()) for t, q in zip(tokens_, p, strict=True)], "tokens long, p array<double>")
    steps, missed = mixture.fit(rated, {"clean": 0.89, "toxic": 0.1, "junk": 0.01})
    rate = np.array([r[0] for r in rated.select(mixture.rate_after(steps)).collect()])
    assert (rate >= 0).all() and rate.max() > 10
    assert np.allclose((rate * tokens_) @ p / tokens_.sum(), [0.89, 0.1, 0.01], atol=2e-4)
    assert max(map(abs, missed.values())) <= mixture.TOLERANCE


def test_rates_of_targets_out_of_reach(spark):
    p = np.array([[0.6, 0.3, 0.1]] * 50 + [[0.5, 0.2, 0.3]] * 50)
    rated = spark.createDataFrame([(10, q.tolist()) for q in p], "tokens long, p array<double>")
    with pytest.warns(UserWarning, match="targets"):
        steps, missed = mixture.fit(rated, {"clean": 0.2, "toxic": 0.0, "junk": 0.8})
    rate = np.array([r[0] for r in rated.select(mixture.rate_after(steps)).collect()])
    totals, weight = (rate * 10) @ p, p.sum(0) * 10
    error = totals - np.array([200, 0, 800])
    assert np.allclose(error / 1000, list(missed.values()), atol=1e-6)
    slope = p @ (error / weight)
    assert (np.abs(np.where(rate > 0, slope, np.minimum(slope, 0))) < 1e-3).all()


def test_mixture_odd_rows(spark, given):
    _, labels = given
    odd = odd_rows(spark)
    assert mixture.mixture(odd, labels).count() == odd.count()
    mixed = mixture.mix(odd, labels)
    assert mixed.columns == odd.columns
    assert mixture.mixture(odd.limit(0), labels).count() == 0
    assert mixture.mixture(odd, labels.limit(0)).count() == odd.count()


def brute_language(rows):
    def split(text):
        return [w for w in re.split("[ \t\n\x0b\f\r]+", (text or "").translate(LOWER)) if w] + [None]

    held = {k: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for k, (i, _) in enumerate(rows)}
    counts = Counter(w for k, (_, t) in enumerate(rows) if not held[k] for w in split(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for k, (i, t) in enumerate(rows):
        own = split(t)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        out.append((i, held[k], len(own), sum(counts[w] > 0 for w in own), n, round(base, 6)))
    return Counter(out)


def test_language_counts_and_gain(given):
    docs, _ = given
    got = language.language_scores(docs).toPandas()
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    mine = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got.itertuples())
    assert mine == brute_language(rows)
    held = got[got["held_out"]]
    assert held["score"].sum() > held["base_score"].sum()


def test_language_odd_rows(spark):
    odd = odd_rows(spark)
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = language.language_scores(odd).toPandas()
    mine = Counter((None if np.isnan(float("nan") if r.doc_id is None else r.doc_id) else int(r.doc_id), r.held_out, r.n_tokens,
                    r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got.itertuples())
    assert mine == brute_language(rows)
    assert np.isfinite(got["score"]).all()
    assert language.language_scores(odd.limit(0)).count() == 0


def test_language_is_normalised():
    noise = np.array([0.3, 0.2, 0.4, 0.1])
    model = language.Model(noise)
    seq = np.random.default_rng(0).integers(0, 4, 5000)
    one, two = np.r_[1, seq[:-1]], np.r_[1, 1, seq[:-2]]
    model.learn(seq, one, two)
    import pyarrow as pa

    z = np.stack([np.frombuffer(b, np.float32) for batch in language._normalisers(
        iter([pa.record_batch([pa.array(range(4), pa.int64())], names=["id"])]), model.values) for b in batch.column(1).to_pylist()], axis=1)
    first, second, out, bias = model.values
    for a in range(4):
        for b in range(4):
            chance = np.exp(out @ (first[a] + second[b]) + bias[:, 0] - z[a, b])
            assert abs(chance.sum() - 1) < 1e-4


def test_noise_contrast_learns_a_pattern():
    model = language.Model(np.full(4, 0.25))
    seq = np.tile([0, 1, 2, 3], 20_000)
    model.learn(seq, np.r_[1, seq[:-1]], np.r_[1, 1, seq[:-2]])
    first, second, out, bias = model.values
    for a in range(4):
        assert int(np.argmax(out @ (first[a] + second[(a + 3) % 4]) + bias[:, 0])) == (a + 1) % 4


def test_word_hashes_are_the_words():
    import pyarrow as pa

    texts = ["The the THE\x0bthe", None, "", "a  b\na", "naïve Ünder ünder"]
    powers = tokens.Powers()
    for _, raw, starts in tokens.chunks(pa.array(texts)):
        hashes, before = tokens.word_hashes(raw, starts, powers)
        assert before.tolist() == [0, 4, 4, 4, 7, 10]
        assert len(set(hashes[:4].tolist())) == 1 and hashes[4] == hashes[6] and hashes[8] != hashes[9]


def test_fit_is_the_same_iteration_in_numpy(spark):
    """Every accepted step lowers the least-squares error of plain numpy rates, and the fit's own sums are theirs."""
    rng = np.random.default_rng(9)
    p = rng.dirichlet([2, 0.3, 0.6], 400)
    tokens_ = rng.integers(1, 400, 400)
    rated = spark.createDataFrame([(int(t), q.tolist()) for t, q in zip(tokens_, p, strict=True)], "tokens long, p array<double>")
    steps, missed = mixture.fit(rated, {"clean": 0.7, "toxic": 0.25, "junk": 0.05})
    goal, natural = tokens_.sum() * np.array([0.7, 0.25, 0.05]), tokens_ @ p
    rate, errors = np.ones(400), []
    for step in [np.zeros(3), *map(np.array, steps)]:
        rate = np.maximum(0, rate - p @ step)
        errors.append((((rate * tokens_) @ p - goal) ** 2 / natural).sum())
    assert all(b < a for a, b in zip(errors, errors[1:], strict=False))
    assert np.allclose(((rate * tokens_) @ p - goal) / tokens_.sum(), list(missed.values()), atol=1e-9)
    assert max(map(abs, missed.values())) <= mixture.TOLERANCE


def test_posteriors_are_calibrated(given):
    """On labelled documents the classifier did not learn from, the mean posterior of a domain is near its share."""
    docs, labels = given
    learnt, held = labels.filter("crc32(string(doc_id)) % 3 > 0"), labels.filter("crc32(string(doc_id)) % 3 = 0")
    model = mixture.learn(docs, learnt)
    rows = mixture.posteriors(docs.select("doc_id", "text"), model, ["doc_id"]).join(held, "doc_id").toPandas()
    p = np.array(rows["p"].tolist())
    true = np.where(rows["toxic"] == 1, 1, np.where(rows["quality"] == 0, 2, 0))
    assert len(rows) > 80 and np.allclose(p.sum(1), 1)
    assert np.abs(p.mean(0) - np.bincount(true, minlength=3) / len(true)).max() < 0.1
    assert (p.argmax(1) == true).mean() > 0.85


@pytest.mark.xfail(reason="open fault: on sf0.01 the mean rates of the halves are 0.95 and 3.26")
def test_halves_of_a_corpus_get_like_rates(given):
    """With one classifier, rates fitted on either half of the documents are alike."""
    docs, labels = given
    rated = mixture.land(mixture.posteriors(docs.select("doc_id", "text"), mixture.learn(docs, labels), ["doc_id"]), "posteriors")
    zero, mean = [], []
    for half in (0, 1):
        part = rated.filter(f"crc32(string(doc_id)) % 2 = {half}")
        rate = np.array([r[0] for r in part.select(mixture.rate_after(mixture.fit(part, mixture.TARGETS)[0])).collect()])
        zero.append((rate == 0).mean())
        mean.append(rate.mean())
    assert abs(zero[0] - zero[1]) < 0.05 and abs(mean[0] - mean[1]) < 0.1


def test_very_many_copies(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "plain words of a clean text", i) for i in range(3)] + [(9, "foul", 0)],
                                 "doc_id long, text string, copies long").withColumn("a.b", mixture.F.lit(1))
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 0), (9, 1, 1)], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(mixture, "PIECE", 7)
    monkeypatch.setattr(mixture, "fit_rates", lambda rated, targets: [[-2_000.0, 0.0, 0.0]])
    counts = {(r["doc_id"], r["copies"]): r["copies_"] for r in
              mixture.mixture(docs, labels).withColumnRenamed("copies", "copies_").join(docs.select("doc_id", "copies"), "doc_id").collect()}
    mixed = mixture.mix(docs, labels)
    assert mixed.columns == docs.columns
    got = Counter((r["doc_id"], r["copies"]) for r in mixed.collect())
    assert got == Counter({k: n for k, n in counts.items() if n}) and max(got.values()) > 1_000
