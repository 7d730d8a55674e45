"""What one task holds of wide tables stays the same as tables grow."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_points
from labelloom.operators import joins, labels
from labelloom.session import spread

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_small_tables(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_spread_grows_with_the_table(spark):
    table = spark.range(1000)
    assert spread(table, 1000, "id", share=10).rdd.getNumPartitions() == 100
    assert spread(table, 3).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("name", ["pred_multilabel", "assemble_wide", "case_study"])
def test_wide_tables_are_dealt_by_row_count(spark, no_small_tables, name):
    text = plan(entry_points.queries()[name](spark, SF_DIR))
    assert "pivot" not in text
    by_case = [line for line in text.splitlines() if re.search(r"Exchange hashpartitioning\(case_id", line)]
    assert by_case and all("REPARTITION_BY_NUM" in line for line in by_case)


def test_wide_cells(spark, rows):
    df = spark.createDataFrame(
        [(1, "a.b", 2), (1, "a.b", 1), (1, "c", 5), (2, "a.b", 1), (2, "c", None), (None, "a.b", 3), (None, "c", 4), (3, None, 1)],
        "case_id int, part string, pred int")
    got = joins.assemble_wide(df, ["case_id"], "part", "pred", ["a.b", "c"], prefix="v_")
    assert got.columns == ["case_id", "v_a.b", "v_c"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, 1, 5), (None, 3, 4)], key=repr)


def test_case_study_with_repeated_and_missing_rows(spark, rows):
    pred = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, None, 1), (3, 0, 0), (None, 1, 1)], "case_id int, `a.b` int, c int")
    gt = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (4, 1, 1), (None, 1, 1)], "case_id int, `a.b` int, c int")
    vision = spark.createDataFrame(
        [(1, "a.b", 1), (1, "a.b", 0), (2, "c", None), (2, "zz", 1), (2, None, 1), (9, "c", 1)], "case_id int, part string, v_pred int")
    got = labels.case_study(pred, gt, vision, ["a.b", "c"])
    one = [(1, "a.b", 1, 1, 0, 1, 0), (1, "a.b", 0, 1, 0, 1, 0), (1, "c", -1, 0, 0, 0, 0)]
    want = one * 2 + [(2, "a.b", -1, None, 1, 0, None), (2, "c", -1, 1, 0, 1, 0)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
