"""Rows and values that must come through whatever is null, late, rare or oddly written."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelloom.functions import label_key
from labelloom.operators import frontier, quality, sampling, scope
from labelloom.session import small_side
from labelloom.sources import tables


def test_folds_partition_the_input(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (None, "a"), (None, None), (5, "b")], "id long, stratum string")
    folded = sampling.kfold(rows, 2, "id", 3, ["stratum"]).collect()
    assert sorted((r["id"] or 0, r["stratum"] or "") for r in folded) == sorted(
        (r["id"] or 0, r["stratum"] or "") for r in rows.collect())
    assert {r["fold"] for r in folded} <= {0, 1}
    split = sampling.split_stratified(rows, "stratum", "id", 0.5, 1)
    assert split.count() == 5 and split.filter("split is null").count() == 0


def test_null_class_has_a_weight(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "id long, label string")
    weights = {r["label"]: r["weight"] for r in sampling.with_class_weights(rows, "label").collect()}
    assert weights == {"a": 3 / 4, None: 3 / 2}


def test_null_objective_is_the_worst(spark):
    rows = spark.createDataFrame([(1, 1.0, None), (2, 0.5, None), (3, None, 2.0), (4, 0.5, 1.0)], "id long, x double, y double")
    assert {r["id"] for r in frontier.pareto_front(rows, "id", ["x", "y"]).collect()} == {1, 3, 4}


def test_guarded_correction_keeps_other_parts(spark):
    labels = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (1, "b", 1), (2, None, 1)], "case_id long, part string, gt int")
    cases = spark.createDataFrame([(1,)], "case_id long")
    got = sorted((r["case_id"], r["part"] or "", r["gt"]) for r in quality.correct_guarded(labels, cases, ["a"], 0.1).collect())
    assert got == [(1, "a", 0), (1, "b", 1), (2, "", 1), (2, "a", 1)]


def test_csv_text_is_not_altered(spark, tmp_path):
    (tmp_path / "front_x.csv").write_text("file,code,conf\na,00123,1.10\nb,1.10,oops\n,1,1\n")
    (tmp_path / "rear_x.csv").write_text("conf,extra,file\n0.5,z,c\n")
    read = tables.read_tagged_csv(spark, str(tmp_path / "*.csv"), "file string, code string, conf double", r"/([a-z]+)_x\.csv", ["view"])
    got = sorted(tuple(r) for r in read.collect())
    assert got == [("a", "00123", 1.1, "front"), ("b", "1.10", None, "front"), ("c", None, 0.5, "rear")]


def test_missing_label_keeps_its_place(spark):
    rows = spark.createDataFrame([(1, None, 0)], "a int, b int, c int")
    assert rows.select(label_key(["a", "b", "c"]).alias("k")).first()["k"] == "1?0"


def test_scope_compares_in_lower_case(spark):
    parts = spark.createDataFrame([(1, "Door", 500.0, "Not Damaged"), (2, "Door", 500.0, "Dent")],
                                  "case_id long, description string, fval double, damage_cond string")
    cfg = scope.ScopeConfig(required_views=["v"])
    assert "not damaged" in cfg.undamaged
    assert [r["case_id"] for r in scope.scope_parts(parts, cfg).collect()] == [2]


def test_wide_summaries_are_not_broadcast(spark):
    wide = spark.range(40).select("id", F.expr("repeat('x', 1000000)").alias("text"))
    hinted = small_side(wide)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in hinted
    assert "ResolvedHint" in small_side(spark.range(40).toDF("id"))._jdf.queryExecution().analyzed().toString()
