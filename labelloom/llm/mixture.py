"""Mixing documents to target weights by soft domain membership, by DataFrame functions only.

A naive Bayes classifier, learned from the labelled table, gives every document posteriors over three
domains: `clean` (quality 1, not toxic), `toxic`, `junk` (quality 0). Nonnegative rates r are then
fitted so that the expected tokens of each domain, the sum over documents of r * tokens * posterior,
meet the targets: least squares, each domain's residual weighted by the inverse of its natural total,
by distributed projected gradient from r = 1.

With gradients taken per token, a document's is posteriors * residuals / natural totals, so a step is one number per
domain: every row moves its own rate by it and puts it back to 0 where it would be negative. A pass tries
several steps along the gradient at once and takes the one with the least error: of length 1, which never
raises it, of the length that the gradient's change over the last step says (Barzilai and Borwein), and
scaled by the domains' overlap in documents with rates above 0. A pass is a few sums over a narrow table;
nothing else passes the driver.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.llm.store import SPACES, land, text_of, unland

DOMAINS = ("clean", "toxic", "junk")
TARGETS = {"clean": 0.95, "toxic": 0.05, "junk": 0.0}
# Word buckets of the classifier, and the labelled documents it learns from (smallest hash of the id).
BUCKETS = 1 << 15
TRAIN_ROWS = 10_000
# Added to every count of a bucket; small, so that a domain of few tokens is not drowned by unseen buckets.
SOFTEN = 0.1
# A word bucket counts for a domain if its log-odds are so many standard errors away from 0.
CERTAIN = 4.0
# Shares of distinct words are cut into so many equal bins, a second feature.
BINS = 12
# Rates have no upper bound.
MAX_RATE = math.inf
# Targets count as met when no domain misses its total by more than this share of all tokens.
TOLERANCE = 1e-4
# The fit also ends where no document's gradient, a posterior times a domain's miss in shares of the domain, is larger.
GRADIENT = 5e-4
# Steps of the fit that a pass works out anew; beyond it rates are written first.
FOLD = 20
# Lengths of the scaled step that a pass tries.
SCALED = (1.0, 0.3, 0.1, 0.03)
# The fit stalls if the error after PATIENCE more steps is above this share of what it was.
STALLED, PATIENCE = 0.9, 6
# Copies in one piece of a row: a rate far above it is dealt out in pieces of this size.
PIECE = 1_000


def words(text: str) -> Column:
    """Words as they stand, white space cut off."""
    return F.filter(F.split(text_of(text), SPACES), lambda w: w != "")


def bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def variety() -> Column:
    """Bin of the share of distinct words."""
    share = F.size(F.array_distinct("words")) / F.greatest(F.size("words"), F.lit(1))
    return F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")


def _log_odds(counts: DataFrame, size: int, certain: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """Two tables of one row: for each key below `size` the log-odds of every domain but the first against it, and what each domain has.

    `counts` has `domain, key, n`, softened by SOFTEN. Keys whose odds are not `certain` times their standard error away from 0
    share one, that of all of them together. After the odds of a key stand as many marks: 1 for odds of its own.
    """
    n, others = range(len(DOMAINS)), range(1, len(DOMAINS))
    own = [F.sum(F.when(F.col("domain") == d, F.col("n")).otherwise(0)).alias(f"c{d}") for d in n]
    every = counts.sparkSession.range(size).select(F.lit(0).alias("domain"), F.col("id").alias("key"), F.lit(0).cast("long").alias("n"))
    per_key = land(every.unionByName(counts.select("domain", F.col("key").cast("long").alias("key"), "n")).groupBy("key").agg(*own), "keys")
    seen = land(per_key.agg(F.array(*(F.sum(f"c{d}") for d in n)).alias("seen")), "seen")
    given = per_key.select("*", seen.scalar().alias("seen"))
    share = [F.log((F.col(f"c{d}") + SOFTEN) / (F.element_at("seen", d + 1) + SOFTEN * size)) for d in n]
    error = [F.sqrt(1 / (F.col(f"c{d}") + SOFTEN) + 1 / (F.col("c0") + SOFTEN)) for d in n]
    keyed = given.select("*", *((share[d] - share[0]).alias(f"o{d}") for d in others))
    keyed = land(keyed.select("*", *((F.abs(f"o{d}") >= certain * error[d]).alias(f"s{d}") for d in others)).drop("seen"), "odds")

    def rest(d, k):
        return F.log((F.sum(F.when(F.col(f"s{d}"), 0).otherwise(F.col(f"c{k}"))) + 1.0) / (F.sum(f"c{k}") + 1.0))

    # The keys without odds of their own as one: on average a word says a little against every domain that it is not of.
    pool = land(keyed.agg(F.array(*(rest(d, d) - rest(d, 0) for d in others)).alias("pool")), "pool")
    chosen = keyed.select("*", pool.scalar().alias("pool")).select("key", F.array(
        *(F.when(F.col(f"s{d}"), F.col(f"o{d}")).otherwise(F.element_at("pool", d)) for d in others),
        *(F.when(F.col(f"s{d}"), 1.0).otherwise(0.0) for d in others)).alias("odds"))
    row = chosen.agg(F.array_sort(F.collect_list(F.struct("key", "odds"))).alias("rows"))
    return row.select(F.transform("rows", lambda r: r["odds"]).alias("odds")), seen


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> dict[str, DataFrame]:
    """Log-odds of the domains against `clean`: per word bucket, per bin, and of the domains; each a landed table of one row.

    Fixed in size: BUCKETS + BINS + 1 entries of two numbers. A document labelled more than once counts
    as toxic if any label says so, else as junk if any does; other labels than 0 and 1 are ignored.
    """
    given = (labels.filter("quality in (0, 1) or toxic in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("_id"))
             .agg(F.coalesce(F.max("toxic"), F.lit(0)).alias("t"), F.coalesce(F.min("quality"), F.lit(1)).alias("q")))
    domain = F.when(F.col("t") == 1, 1).when(F.col("q") == 0, 2).otherwise(0).alias("domain")
    known = docs.select(F.col("doc_id").cast("long").alias("_id")).filter("_id is not null").distinct()
    chosen = given.join(known, "_id", "left_semi").orderBy(F.xxhash64("_id"), "_id").limit(rows).select("_id", domain)
    # Joined before the words are split, so only the chosen texts are.
    own = docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(F.broadcast(chosen), "_id")
    own = own.select("domain", words("text").alias("words")).select("domain", "words", variety().alias("bin"))
    tokens = own.select("domain", F.explode_outer("words").alias("w")).filter("w is not null").groupBy("domain", bucket(F.col("w")).alias("key"))
    bins, documents = _log_odds(own.groupBy("domain", F.col("bin").alias("key")).agg(F.count("*").alias("n")), BINS)
    odds, _ = _log_odds(tokens.agg(F.count("*").alias("n")), BUCKETS, CERTAIN)
    seen = [F.element_at("seen", d + 1) + F.lit(1.0) for d in range(len(DOMAINS))]
    prior = documents.select(F.array(*(F.log(seen[d] / seen[0]) for d in range(1, len(DOMAINS)))).alias("odds"))
    return {"words": land(odds, "words"), "bins": land(bins, "bins"), "prior": land(prior, "prior")}


def posteriors(docs: DataFrame, model: dict[str, DataFrame], keep: list[str]) -> DataFrame:
    """`keep` columns, `tokens`, and `p`: the posteriors of DOMAINS. No shuffle, one row per document.

    Words that tell a domain from `clean` with certainty have odds of their own, so that a few of them are heard in a long text.
    Odds are damped, since words are not independent: a domain's sum is divided by the root of the number of its own words.
    The model comes as values of subqueries, each used once, so no row carries it and no plan spells it out.
    """
    kept = [F.col(f"`{c}`") for c in keep]
    others = len(DOMAINS) - 1
    found = docs.select(*kept, words("text").alias("words"))
    keyed = found.select(*kept, F.size("words").cast("long").alias("tokens"), variety().alias("bin"),
                         F.transform("words", bucket).alias("keys"), model["words"].scalar().alias("words_odds"))
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    total = F.aggregate("keys", F.array(*[F.lit(0.0)] * 2 * others), lambda acc, k: add(acc, F.element_at("words_odds", k + 1)))
    damped = F.zip_with(F.slice("sums", 1, others), F.slice("sums", others + 1, others), lambda x, n: x / F.sqrt(F.greatest(n, F.lit(1.0))))
    summed = keyed.select(*kept, "tokens", "bin", total.alias("sums")).select(
        *kept, "tokens", "bin", damped.alias("by_words"), model["bins"].scalar().alias("bins_odds"), model["prior"].scalar().alias("prior_odds"))
    scored = summed.select(*kept, "tokens", F.concat(F.array(F.lit(0.0)), add(
        add(F.col("by_words"), F.slice(F.element_at("bins_odds", F.col("bin") + 1), 1, others)), F.col("prior_odds"))).alias("s"))
    top = F.array_max("s")
    return (scored.select(*kept, "tokens", F.transform("s", lambda x: F.exp(x - top)).alias("e"))
            .select(*kept, "tokens", F.transform("e", lambda x: x / F.aggregate("e", F.lit(0.0), lambda a, b: a + b)).alias("p")))


def slope_of(step: Column) -> Column:
    """A document's share in a step: its posteriors times the step's number for each domain."""
    return F.aggregate(F.zip_with("p", step, lambda p, e: p * e), F.lit(0.0), lambda a, b: a + b)


def rate_after(steps: list[list[float]], start: Column | None = None) -> Column:
    """Rate of a document after steps against the slopes of the domains, from 1, kept nonnegative after each."""
    rate = F.lit(1.0) if start is None else start
    if not steps:
        return rate
    every = F.array(*(F.array(*(F.lit(float(x)) for x in step)) for step in steps))
    return F.aggregate(every, rate, lambda r, step: F.greatest(F.lit(0.0), r - slope_of(step)))


def _moved(rate: Column, step: list[float]) -> Column:
    """The rate after one step, of a row with posteriors p0, p1, ..."""
    slope = F.lit(0.0)
    for d, e in enumerate(step):
        slope = slope + F.col(f"p{d}") * F.lit(float(e))
    return F.greatest(F.lit(0.0), rate - slope)


def sums_at(rows: DataFrame, since: list[list[float]], tried: list[list[float]], slope: list[float]):
    """The largest gradient at the rates after the steps in `since`, and what each tried step makes of them.

    That is the expected tokens of each domain, tokens times squared moves, and how the domains overlap: tokens times products of
    posteriors of rows with rates above 0. A gradient counts where the rate can follow it: both ways above 0, upwards only at 0.
    """
    n = range(len(DOMAINS))
    rate = F.col("rate")
    for step in since:
        rate = _moved(rate, step)
    both = rows.select(*(f"p{d}" for d in n), "t", rate.alias("r"))
    both = both.select("*", *(_moved(F.col("r"), step).alias(f"n{k}") for k, step in enumerate(tried)))
    gradient = sum(((F.col(f"p{d}") * F.lit(float(slope[d]))) for d in n), F.lit(0.0))
    free = F.when(F.col("r") > 0, F.abs(gradient)).otherwise(F.greatest(F.lit(0.0), -gradient))
    sums = [F.max(F.when(F.col("t") > 0, free))]
    for k in range(len(tried)):
        to, open_ = F.col(f"n{k}"), F.when(F.col(f"n{k}") > 0, F.col("t")).otherwise(0.0)
        sums += [F.sum(to * F.col("t") * F.col(f"p{d}")) for d in n] + [F.sum(F.col("t") * (to - F.col("r")) ** 2)]
        sums += [F.sum(open_ * F.col(f"p{d}") * F.col(f"p{e}")) for d in n for e in n if e >= d]
    values = [x or 0.0 for x in both.agg(*sums).first()]
    per, found = (len(values) - 1) // len(tried), []
    for k in range(len(tried)):
        own = np.array(values[1 + k * per:1 + (k + 1) * per])
        overlap = np.zeros((len(DOMAINS), len(DOMAINS)))
        overlap[np.triu_indices(len(DOMAINS))] = own[len(DOMAINS) + 1:]
        found.append((own[:len(DOMAINS)], float(own[len(DOMAINS)]), overlap + np.triu(overlap, 1).T))
    return values[0], found


def fit(rated: DataFrame, targets: dict[str, float]) -> tuple[list[list[float]], dict[str, float]]:
    """Steps that bring the expected totals to the targets' shares of all tokens, and what each domain misses.

    The second is what a domain has above (or below, if negative) its target, as a share of all tokens. The fit ends where
    none exceeds TOLERANCE, where the projected gradient is at most GRADIENT everywhere, or where the error stalls: then
    no nonnegative rates come nearer, or only by dropping ever more documents that are nearly all of other domains.
    """
    rows = rated.select(F.col("tokens").cast("double").alias("t"), F.lit(1.0).alias("rate"),
                        *(F.element_at("p", d + 1).alias(f"p{d}") for d in range(len(DOMAINS))))
    none = [0.0] * len(DOMAINS)
    _, [(natural, _, overlap)] = sums_at(rows, [], [none], none)
    whole = float(natural.sum())
    if not whole:
        return [], dict.fromkeys(DOMAINS, 0.0)
    goal = whole * np.array([targets[d] for d in DOMAINS]) / sum(targets[d] for d in DOMAINS)
    weight = np.maximum(natural, whole * 1e-6)

    def error(total):
        return float(((total - goal) ** 2 / weight).sum()) / 2

    steps: list[list[float]] = []
    total, length, folded, written, errors = natural, 1.0, 0, False, [error(natural)]
    while np.abs(total - goal).max() > TOLERANCE * whole:
        slope = (total - goal) / weight
        scaled = np.linalg.lstsq(overlap + np.diag(weight) * 1e-9, total - goal, rcond=None)[0]
        tried = [(slope * factor).tolist() for factor in (1.0, length)] + [(scaled * factor).tolist() for factor in SCALED]
        steepest, found = sums_at(rows, steps[folded:], tried, slope.tolist())
        best = min(range(len(tried)), key=lambda k: error(found[k][0]))
        errors.append(error(found[best][0]))
        if steepest <= GRADIENT or errors[-1] >= errors[-2] * (1 - 1e-9):
            break
        steps.append(tried[best])
        curve = float(((found[best][0] - total) ** 2 / weight).sum())
        length = min(1e6, max(1.0, found[best][1] / curve)) if curve else 1.0
        total, _, overlap = found[best]
        if errors[-1] > STALLED * errors[max(0, len(errors) - 1 - PATIENCE)]:
            break
        if len(steps) - folded == FOLD:
            rate = F.col("rate")
            for step in steps[folded:]:
                rate = _moved(rate, step)
            moved = land(rows.withColumn("rate", rate), "rates")
            if written:
                unland(rows)
            rows, folded, written = moved, len(steps), True
    if written:
        unland(rows)
    missed = dict(zip(DOMAINS, ((total - goal) / whole).tolist(), strict=True))
    if max(map(abs, missed.values())) > TOLERANCE:
        warnings.warn(f"the rates stop short of the targets; missed, as shares of all tokens: {missed}", stacklevel=2)
    return steps, missed


def fit_rates(rated: DataFrame, targets: dict[str, float]) -> list[list[float]]:
    """Steps of `fit`, which warns of what they miss."""
    return fit(rated, targets)[0]


def copies_of(rate: Column, draw: Column) -> Column:
    """A rate as a whole number, up with the chance of its fraction."""
    return F.floor(rate + draw)


def mixture(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """(doc_id, tokens, p_clean, p_toxic, p_junk, rate, copies) for every row of `docs` (doc_id, text).

    `copies` rounds the rate to a whole number, up with the chance of its fraction, decided by a hash
    of the id and the text, so it does not change between runs. Null and empty texts have no tokens
    and still a rate from their prior. A domain of a few tokens can have rates in the thousands and beyond; copies
    are longs. Repeated rows each come back; other columns are ignored.
    """
    model = learn(docs, labels)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    narrow = narrow.withColumn("draw", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / (1 << 20))
    rated = land(posteriors(narrow, model, ["doc_id", "draw"]), "posteriors")
    steps = fit_rates(rated, targets or TARGETS)
    out = rated.withColumn("rate", rate_after(steps))
    return out.select("doc_id", "tokens", *(F.element_at("p", d + 1).alias(f"p_{name}") for d, name in enumerate(DOMAINS)),
                      "rate", copies_of(F.col("rate"), F.col("draw")).alias("copies"))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """Documents repeated `copies` times each; all columns stay. Rows are not moved, but for those with many copies.

    More than PIECE copies of a row are dealt over all tasks in pieces of PIECE, so no task writes them alone.
    """
    model = learn(docs, labels)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    steps = fit_rates(land(posteriors(narrow, model, []), "posteriors"), targets or TARGETS)
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                         F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 20)) / (1 << 20)
    packed = packed.select("row", "text", draw.alias("draw"))
    counted = posteriors(packed, model, ["row", "draw"]).select("row", copies_of(rate_after(steps), F.col("draw")).alias("copies"))
    # One generator for both: the numbers of the few copies, or the sizes of pieces as negative numbers.
    pieces = F.sequence(F.lit(1).cast("long"), F.ceil(F.col("copies") / PIECE))
    parts = F.when(F.col("copies") <= PIECE, F.array_repeat(F.lit(1).cast("long"), F.col("copies").cast("int"))).otherwise(
        F.transform(pieces, lambda i: -F.least(F.lit(PIECE).cast("long"), F.col("copies") - (i - 1) * PIECE)))
    # Outer: an inner generator adds a filter that would work the posteriors out once more.
    dealt = land(counted.select("row", F.explode_outer(parts).alias("part")).filter("part is not null"), "mixed")
    many = dealt.filter("part < 0").repartition(F.xxhash64(F.monotonically_increasing_id()))
    many = many.select("row", F.explode(F.array_repeat(F.lit(1), (-F.col("part")).cast("int"))).alias("one"))
    return dealt.filter("part > 0").select("row.*").unionByName(many.select("row.*"))
