"""Null handling, ties, zero denominators and the other places where results easily go wrong."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from labelloom import functions as fn
from labelloom.operators import aggregates, evaluate, expect, joins, labels, quality, sampling, scope, taxonomy


def test_negative_filters_keep_nulls(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, x string")
    assert rows(df.filter(fn.not_in(F.col("x"), ["a"])), "id") == [(2,), (3,)]
    assert rows(df.filter(fn.differs(F.col("x"), "a")), "id") == [(2,), (3,)]
    assert rows(df.filter(fn.not_rlike_any(F.col("x"), ["a", "z"])), "id") == [(2,), (3,)]
    assert rows(df.filter(fn.rlike_any(F.col("x"), ["a", "z"])), "id") == [(1,)]


def test_blacklist_terms_can_be_literal(spark, rows):
    df = spark.createDataFrame([("pan assy., oil",), ("pan assyx, oil",)], "d string")
    assert rows(scope.remove_blacklisted(df, "d", ["pan assy., oil"])) == []
    assert rows(scope.remove_blacklisted(df, "d", ["pan assy., oil"], literal=True)) == [("pan assyx, oil",)]


PART_ROWS = [
    (1, 150.0, "smashed", "bumper front lh"),
    (2, 100.0, "smashed", "front bumper"),
    (3, None, "smashed", "grille"),
    (4, 200.0, "not damaged", "grille"),
    (5, 200.0, None, "grille"),
    (6, 200.0, "smashed", "-"),
    (7, 200.0, "smashed", None),
]


def test_part_scope_and_funnel(spark, rows):
    parts = spark.createDataFrame(PART_ROWS, "case_id int, fval double, damage_cond string, description string")
    cfg = scope.ScopeConfig()
    assert rows(scope.scope_parts(parts, cfg), "case_id") == [(1,), (5,), (7,)]
    funnel = dict(rows(scope.part_funnel(parts, cfg)))
    assert funnel == {"low_cost": 1, "no_cost": 1, "condition": 1, "dash": 1, "used": 3, "removed": 4}
    assert dict(rows(scope.part_funnel(parts, cfg, legacy_lt=True)))["low_cost"] == 0


def test_scope_cases(spark, rows):
    cfg = scope.ScopeConfig(required_views=("f", "r"))
    columns = "case_id int, vehicle_class int, claim_type string, circumstances string, gross_offer double"
    cases = spark.createDataFrame([
        (1, 2, "OD KFK", None, 5.0), (1, 2, "OD KFK", None, 5.0), (2, 3, "OD", None, 5.0), (3, 2, "WS", None, 5.0),
        (4, 2, "TP", "Flood", 5.0), (5, 2, "TP", "x", 0.0), (6, 2, "TP", "x", None), (7, 2, "TP", "x", 1.0),
        (8, 2, "TP", "x", 1.0),
    ], columns)
    parts = spark.createDataFrame([(i, 500.0, "bad", "d") for i in range(1, 8)],
                                  "case_id int, fval double, damage_cond string, description string")
    files = spark.createDataFrame([(i, v) for i in (1, 2, 3, 4, 5, 6, 8) for v in "fr"] + [(7, "f"), (7, "f")],
                                  "case_id int, view string")
    assert rows(scope.scope_cases(cases, parts, files, cfg), "case_id") == [(1,)]
    funnel = dict(rows(scope.scope_funnel(cases, parts, files, cfg)))
    assert funnel["claim_type"] == 1 and funnel["vehicle_class"] == 1 and funnel["circumstances"] == 1
    assert funnel["gross_offer"] == 2 and funnel["incomplete_views"] == 1 and funnel["no_part_lines"] == 1


def test_position_words_are_removed_in_sequence(spark, rows):
    df = spark.createDataFrame([("Bumper RH right",), ("lrhh x",), ("upperleft",)], "t string")
    # Removing rh after lh leaves "lh" in the second text: one alternation would not.
    assert [r[0] for r in df.select(fn.strip_position(F.col("t"))).collect()] == ["bumper", "lh x", ""]


def test_file_names(spark):
    df = spark.createDataFrame([(10.0, 7.0)], "c double, d double")
    name = df.select(fn.file_key(F.col("c"), F.col("d")).alias("n"))
    assert name.first()[0] == "10_7.JPG"
    assert name.select(fn.case_from_path(F.concat(F.lit("/a_b/x/"), "n"))).first()[0] == 10


def test_label_state_clip_ratio(spark):
    df = spark.createDataFrame([(1, 9.0), (0, -9.0), (None, None)], "g int, x double")
    got = df.select(fn.label_state(F.col("g"), "p"), fn.clip(F.col("x"), -1.0, 1.0), fn.safe_ratio(F.col("x"), F.col("g"))).collect()
    assert [tuple(r) for r in got] == [("p_dmg", 1.0, 9.0), ("p_no_dmg", -1.0, None), ("p_N/A", None, None)]


def test_remap(spark, rows):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "z")], "d string, l string")
    rules = spark.createDataFrame([("a", "wheel")], "d string, l string")
    assert rows(scope.apply_remap(df, rules, "d", ["l"])) == sorted([("a", "wheel"), ("b", "y"), (None, "z")], key=repr)


def test_vote_rules(spark, rows):
    preds = spark.createDataFrame([
        (1, "a", 0.9, 0.5, 1), (1, "a", 0.1, 0.5, 1),      # tie, mean 0.5 -> 1
        (1, "b", 0.88, 0.5, 0), (1, "b", 0.1, 0.5, 0),     # tie, mean 0.49 -> 0
        (2, "a", 0.5, 0.5, 1),                             # equal to the threshold is not above it
        (3, "a", 0.9, 0.5, 1),                             # no label row: dropped
    ], "case_id int, part string, conf double, threshold double, gt int")
    given = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 0), (1, "c", 1), (2, "a", 1), (2, "c", 0), (4, "a", 1)], "case_id int, part string, gt int"
    )
    want = [(1, "a", 1, 1), (1, "b", 0, 0), (1, "c", 1, 0), (2, "a", 1, 0), (2, "c", 0, 0)]
    assert rows(evaluate.ensemble_vote(preds, given, ["a", "b", "c"])) == want
    ones = dict(((c, p), x) for c, p, _, x in rows(evaluate.ensemble_vote(preds, given, ["a", "b", "c"], tie="one")))
    assert ones[(1, "a")] == 1 and ones[(1, "b")] == 1
    zeros = dict(((c, p), x) for c, p, _, x in rows(evaluate.ensemble_vote(preds, given, ["a", "b", "c"], tie="zero")))
    assert zeros[(1, "a")] == 0
    shuffled = preds.orderBy(F.desc("conf"))
    assert rows(evaluate.ensemble_vote(shuffled, given, ["a", "b", "c"])) == want


def test_vote_over_an_unlimited_vocabulary(spark):
    """1,500 parts without a list of them, against a plain count; a part without a label or a name counts nowhere."""
    names = [f"p{i:04d}" for i in range(1500)]
    votes = [(c, p, 0.9 if (c * 7 + i + v) % 3 else 0.1, 0.5, (c + i) % 2) for c in range(3) for i, p in enumerate(names)
             if (i + c) % 4 == 0 for v in range(1 + i % 3)]
    votes += [(0, "unlabelled", 0.9, 0.5, 1), (0, None, 0.9, 0.5, 1), (9, "p0000", 0.9, 0.5, 1)]
    preds = spark.createDataFrame(votes, "case_id int, part string, conf double, threshold double, gt int")
    given = spark.createDataFrame([(c, p, 7) for c in range(4) for p in names] + [(0, None, 1)], "case_id int, part string, gt int")
    seen = {}
    for c, p, conf, threshold, gt in votes:
        seen.setdefault((c, p), []).append((conf > threshold, conf, gt))
    want = {}
    for c in range(3):
        for p in names:
            own = seen.get((c, p))
            if own is None:
                want[c, p] = (7, 0)
                continue
            yes, mean = sum(x[0] for x in own), sum(x[1] for x in own) / len(own)
            want[c, p] = (own[0][2], int(yes * 2 > len(own) or (yes * 2 == len(own) and round(mean, 9) >= 0.5)))
    got = evaluate.ensemble_vote(preds, given).collect()
    assert len(got) == len(want) and {(r.case_id, r.part): (r.gt, r.pred) for r in got} == want


def test_vote_with_more_parts_than_one_word_holds(spark):
    names = [f"p{i:03d}" for i in range(150)]
    preds = spark.createDataFrame(
        [(c, p, 0.9 if (c + i) % 3 else 0.1, 0.5, int((c * i) % 2)) for c in range(4) for i, p in enumerate(names) if i % 2],
        "case_id int, part string, conf double, threshold double, gt int")
    given = spark.createDataFrame([(c, p, 7) for c in range(4) for p in names], "case_id int, part string, gt int")
    got = {(r.case_id, r.part): (r.gt, r.pred) for r in evaluate.ensemble_vote(preds, given, names).collect()}
    for c in range(4):
        for i, p in enumerate(names):
            assert got[(c, p)] == (((c * i) % 2, int((c + i) % 3 > 0)) if i % 2 else (7, 0))


def test_metrics_with_empty_sides(spark):
    df = spark.createDataFrame(
        [(1, "pos", 1, 1), (2, "pos", 1, 0), (1, "neg", 0, 0), (2, "neg", 0, 1)], "case_id int, part string, gt int, pred int"
    )
    got = {r.part: r for r in evaluate.part_metrics(df).collect()}
    assert got["pos"].tpr == 0.5 and got["pos"].tnr is None and got["pos"].acc is None
    assert got["neg"].tpr is None and got["neg"].tnr == 0.5 and got["neg"].f1 is None
    macro = aggregates.macro(evaluate.part_metrics(df), ["tpr", "tnr"]).first()
    assert macro.avg_tpr == 0.5 and macro.min_tnr == 0.5
    assert expect.expect_rates_sum(evaluate.part_metrics(df)).first().failed_rows == 0


def test_rate_and_count_precision_differ(spark):
    data = [(i, "p", 1, 1) for i in range(8)] + [(8, "p", 1, 0)] * 2 + [(9, "p", 0, 1), (10, "p", 0, 0)]
    df = spark.createDataFrame(data, "case_id int, part string, gt int, pred int")
    rate, count = evaluate.part_metrics(df).first(), evaluate.part_metrics(df, mode="count").first()
    assert rate.precision == pytest.approx(0.8 / 1.3) and count.precision == pytest.approx(8 / 9)
    assert rate.acc == pytest.approx(0.65) and count.acc == pytest.approx(9 / 12)


def test_average_precision_without_predictions(spark):
    df = spark.createDataFrame([(1, "p", 1, 0), (2, "p", 0, 0)], "case_id int, part string, gt int, pred int")
    assert evaluate.average_precision_binary(df).first().average_precision == pytest.approx(0.5)


def test_hamming_variants(spark):
    df = spark.createDataFrame([
        (1, "a", 0, 0), (1, "b", 0, 0),  # both sets empty
        (2, "a", 0, 1), (2, "b", 0, 0),  # only the given set empty
        (3, "a", 1, 1), (3, "b", 1, 0),
    ], "case_id int, part string, gt int, pred int")
    by = {v: {r.case_id: r.score for r in evaluate.hamming_cases(df, v).collect()} for v in "abc"}
    assert by["a"] == {1: 1.0, 2: None, 3: 0.5}
    assert by["b"] == {1: 1.0, 2: 0.0, 3: 0.5}
    assert by["c"] == {1: 1.0, 2: 0.5, 3: 0.5}
    assert evaluate.hamming(df, "a").first().score == 0.75
    assert evaluate.exact_match(df).first()[0] == pytest.approx(1 / 3)


def test_best_threshold_is_lowest_of_equals(spark):
    df = spark.createDataFrame([("p", 0.9, 1), ("p", 0.35, 0)], "part string, conf double, gt int")
    best = evaluate.best_threshold(evaluate.pr_curve(df)).first()
    assert best.threshold == 0.4 and best.f1 == 1.0
    assert evaluate.pr_curve(df).count() == 11


def test_pivot_mean_turns_duplicates_into_fractions(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 0), (1, "b", 1)], "case_id int, part string, gt int")
    row = labels.pivot_mean(df, "case_id", "part", "gt", ["a", "b", "c"]).first()
    assert (row.a, row.b, row.c) == (0.5, 1.0, None)


def test_multilabel_and_views(spark, rows):
    lines = spark.createDataFrame([(1, "a", "m1", 1), (1, "b", "m2", 0), (2, None, "m3", 0)],
                                  "case_id int, part string, model string, at int")
    wide = labels.multilabel(lines, "case_id", "part", ["a", "b", "c"], ["model"], "at")
    assert rows(wide) == [(1, "m2", 1, 1, 0, 1, 1, 0), (2, "m3", 0, 0, 0, 0, 0, 0)]
    long = labels.long_labels(wide, "case_id", ["a", "b", "c"], prefix="vision_")
    mapping = spark.createDataFrame([("front", "a"), ("front", "c"), ("rear", "b")], "view string, part string")
    files = spark.createDataFrame([(1, "front", 2, "late"), (1, "front", 1, "early"), (2, "rear", 1, "r"), (3, "rear", 1, "x")],
                                  "case_id int, view string, at int, filename string")
    got = labels.view_labels(long, mapping, files, [F.col("at")])
    assert rows(got, "case_id", "view", "filename", "part", "gt") == [
        (1, "front", "early", "a", 1), (1, "front", "early", "c", 0), (2, "rear", "r", "b", 0)]


def test_part_labels(spark, rows):
    lines = spark.createDataFrame(
        [(1, "front bumper", "broken")] * 9 + [(1, "bumper front lh", None), (1, "wheel hub rear lh", "x"), (1, "grille bracket", "x"),
         (1, "front bumper", "bracket bent"), (2, "front bumper", "x"), (1, "zzz", "x"), (1, "pan assyx, oil", "x")],
        "case_id int, description string, damage_cond string")
    levels = spark.createDataFrame(
        [("front bumper", " bumper ", "bumper_front "), ("none", "other", "other")], "lvl_1_desc string, lvl_2_desc string, lvl_3_desc string")
    cases = spark.createDataFrame([(1,)], "case_id int")
    got = taxonomy.part_labels(lines, cases, levels, percent_threshold=100).groupBy("description", "lvl_2_desc", "lvl_3_desc").count()
    assert rows(got) == [("bumper front lh", "bumper", "bumper_front", 1), ("front bumper", "bumper", "bumper_front", 9),
                         ("wheel hub rear lh", "wheel", "wheel", 1), ("zzz", "other", "other", 1)]
    flags = spark.createDataFrame([("a ", 1, 0), ("b", 1, 1), ("b", 1, 0)], "lvl_3_desc string, front int, rear int")
    assert rows(taxonomy.part_vocabulary_map(flags, ["front", "rear"])) == [("front", "a"), ("front", "b"), ("rear", "b")]


def test_assemble_wide_needs_every_part(spark, rows):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 0), (2, "a", 1)], "case_id int, part string, pred int")
    assert rows(joins.assemble_wide(df, ["case_id"], "part", "pred", ["a", "b"])) == [(1, 1, 0)]


def test_prefer_takes_null_of_better_row(spark, rows):
    base = spark.createDataFrame([(1, 0.2), (2, 0.3)], "k int, c double")
    better = spark.createDataFrame([(1, None)], "k int, c double")
    assert rows(joins.prefer(base, better, ["k"], ["c"])) == sorted([(1, None, 1), (2, 0.3, 0)], key=repr)


def test_vocabulary_is_size_checked(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("p"))
    assert len(joins.vocabulary(df, "p", 20)) == 20
    with pytest.raises(ValueError):
        joins.vocabulary(df, "p", 19)


def test_outer_chain_fills_zero(spark, rows):
    a = spark.createDataFrame([("x", 1)], "part string, n int")
    b = spark.createDataFrame([("y", 2)], "part string, m int")
    assert rows(joins.outer_chain({"n": a, "m": b}, "part")) == [("x", 1, 0), ("y", 0, 2)]


def test_oversample_adds_up(spark, rows):
    data = [(i, int(i == 0), int(i in (0, 1)), int(i < 5)) for i in range(20)]
    df = spark.createDataFrame(data, "id int, a int, b int, c int")
    got = sampling.oversample(df, ["a", "b", "c"]).groupBy("id").count()
    counts = dict(rows(got))
    assert counts[0] == 5 and counts[1] == 3 and counts[2] == 1  # 1 + 2 per scarce positive; c is not scarce
    assert sum(counts.values()) == 20 + 2 * 1 + 2 * 2


def test_rare_combination_goes_by_rarest_label(spark):
    data = [(i, 1, 0) for i in range(6)] + [(6, 1, 1), (7, 0, 1), (8, 0, 1), (9, 0, 0)]
    df = spark.createDataFrame(data, "id int, a int, b int")
    got = {r.id: r.stratum for r in sampling.combination_strata(df, ["a", "b"], 2).collect()}
    assert got[0] == "10" and got[7] == "01" and got[6] == "rare:b" and got[9] == "rare:"


def test_pos_weights(spark, rows):
    df = spark.createDataFrame([(1, 0, 1), (0, 0, 1), (0, 0, 1)], "a int, b int, c int")
    assert dict(rows(sampling.pos_weights(df, ["a", "b", "c"]))) == {"a": 2.0, "b": None, "c": 1.0}


def test_confident_class_by_hand(spark):
    data = [(1, "p", 0.9, 1), (2, "p", 0.7, 1), (3, "p", 0.8, 0), (4, "p", 0.1, 0), (5, "q", 0.6, 1)]
    df = spark.createDataFrame(data, "case_id int, part string, conf double, gt int")
    cuts = {r.part: r for r in quality.confident_thresholds(df).collect()}
    assert cuts["p"].t1 == pytest.approx(0.8) and cuts["p"].t0 == pytest.approx(0.55)
    assert cuts["q"].t1 == 0.6 and cuts["q"].t0 is None
    got = {r.case_id: (r.confident, r.is_issue) for r in quality.find_label_issues(df, ["p", "q"]).collect()}
    assert got == {1: (1, 0), 2: (None, 0), 3: (1, 1), 4: (0, 0), 5: (1, 0)}


def test_class_health_by_hand(spark):
    data = [(1, 0, [0.9, 0.1]), (2, 0, [0.8, 0.2]), (3, 0, [0.1, 0.9]), (4, 1, [0.2, 0.8]), (5, 1, [0.3, 0.7])]
    df = spark.createDataFrame(data, "sample_id int, gt int, probs array<double>")
    # Thresholds: class 0: (0.9+0.8+0.1)/3 = 0.6, class 1: 0.75. Confident: 0, 0, 1, 1, none.
    got = {r["class"]: r for r in quality.class_health(df, "probs", "gt", 2).collect()}
    assert got[0].label_noise == pytest.approx(1 / 3) and got[0].label_issues == 1 and got[0].inverse_noise == 0
    assert got[1].label_noise == 0 and got[1].inverse_noise == pytest.approx(1 / 3)  # 1 of 2 + 1 rows


def test_ood_score_by_hand(spark):
    df = spark.createDataFrame([(1, 0, [0.5, 0.5]), (2, 1, [0.0, 1.0])], "sample_id int, gt int, probs array<double>")
    got = {r.sample_id: r.ood_score for r in quality.ood_score(df, "probs", "gt", 2).collect()}
    # Thresholds 0.5 and 1.0: row 1 becomes (1.0, 0.5)/1.5, row 2 (0.5, 1.0)/1.5.
    entropy = 0.6365141682948128
    assert got[1] == pytest.approx(1 - entropy / 0.6931471805599453) and got[2] == pytest.approx(got[1])


def test_aum_and_bald_by_hand(spark):
    df = spark.createDataFrame([(1, 0, [2.0, 1.0, -1.0]), (1, 0, [0.0, 3.0, 5.0])], "sample_id int, label int, logits array<double>")
    assert quality.aum(df).first().aum == pytest.approx((1 - 5) / 2)
    draws = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.5, 0.5])], "s int, probs array<double>")
    got = {r.s: r.bald for r in quality.bald(draws, "s", "probs", 2).collect()}
    assert got[1] == pytest.approx(0.6931471805599453) and got[2] == pytest.approx(0.0)


def test_correct_labels_and_guard(spark, rows):
    given = spark.createDataFrame([(c, p, 1) for c in range(4) for p in "ab"] + [(c, "b", 1) for c in range(4, 40)],
                                  "case_id int, part string, gt int")
    listed = spark.createDataFrame([(0,), (1,), (2,), (3,)], "case_id int")
    fixed = quality.correct_labels(given, listed, ["a"])
    assert fixed.filter("part = 'a'").agg(F.sum("gt")).first()[0] == 0
    assert fixed.filter("part = 'b'").agg(F.sum("gt")).first()[0] == 40
    guarded = quality.correct_guarded(given, listed, ["a", "b"])  # 'a' would keep no positive: skipped
    assert guarded.filter("part = 'a'").agg(F.sum("gt")).first()[0] == 4
    assert guarded.filter("part = 'b'").agg(F.sum("gt")).first()[0] == 36


def test_calibration_of_sure_and_right_predictions(spark):
    df = spark.createDataFrame([(1.0, 1), (0.0, 0)], "conf double, gt int")
    assert evaluate.calibration(df).first().ece == 0.0
    assert [r.bin for r in evaluate.calibration_bins(df).collect()] == [14]


def test_expectations_fail_when_they_should(spark):
    df = spark.createDataFrame([(1, "f"), (1, "f"), (2, "f")], "case_id int, view string")
    assert expect.expect_unique(df, ["case_id", "view"]).first().failed_rows == 1
    assert expect.expect_disjoint(df, df.filter("case_id = 2"), "case_id").first().failed_rows == 1
    nulls = spark.createDataFrame([(None,), (1.0,)], "x double")
    assert expect.expect_that(nulls, "x", F.col("x") > 0).first().failed_rows == 1
    arrays = spark.createDataFrame([([1.0], [1.0, 2.0])], "a array<double>, b array<double>")
    assert expect.expect_equal_lengths(arrays, ["a", "b"]).first().failed_rows == 1
