"""The physical plans: what is pushed down, pruned early, and never planned."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from labelloom.operators import evaluate, quality, ranking, sampling
from labelloom.plans.views import Views

SF_DIR = "/root/testdata/sf0.001"
EAGER = {"part_models", "out_of_fold_predictions", "ingest_stream", "first_photo_stream", "running_metrics_stream"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large_tables(spark):
    """Plan as if no table were small enough to broadcast by itself."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield Views(spark, SF_DIR)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_query_plans_a_cross_join(spark, large_tables):
    for name, build in entry_points.queries().items():
        if name not in EAGER:
            text = plan(build(spark, SF_DIR))
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_scan_reads_needed_columns_and_pushes_filters(spark):
    text = plan(entry_points.queries()["pruned_scan"](spark, SF_DIR))
    columns = re.search(r"FileScan parquet \[([^]]*)\]", text).group(1)
    assert {c.split("#")[0] for c in columns.split(",")} == {"o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"}
    assert re.search(r"DataFilters: \[.*o_orderpriority#\d+ IN \(1-URGENT,5-LOW\)", text)
    assert "PushedFilters: [In(o_orderpriority" in text or "PushedFilters: [IsNotNull" in text


def test_first_row_is_pruned_before_the_shuffle(large_tables):
    text = plan(ranking.first_per(large_tables.files, ["case_id", "view"], [F.col("final_date"), F.col("doc_id")]))
    assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit.*Partial", text)


def test_votes_read_predictions_once_and_shuffle_labels_once(large_tables):
    v = large_tables
    text = plan(evaluate.ensemble_vote(v.predictions, v.label_grid, v.parts))
    assert text.count("lineitem.parquet") == 1 and text.count("orders.parquet") == 1
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", text)
    assert sum("case_id" in k for k in keys) == 3  # predictions, folded votes, labels


def test_issue_search_never_shuffles_predictions_on_the_part(spark, large_tables):
    preds = large_tables.case_predictions
    saved = spark.createDataFrame(preds.limit(50).collect(), preds.schema)
    text = plan(quality.find_label_issues(saved, large_tables.parts))
    assert text.count("BroadcastHashJoin") == 1 and text.count("Exchange hashpartitioning") == 1  # thresholds only


def test_samples_shuffle_the_rows_once(large_tables):
    orders = large_tables.table("orders").select("o_orderkey", "o_orderstatus")
    text = plan(sampling.sample_n_per(orders, ["o_orderstatus"], "o_orderkey", 5000, 1))
    row_shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning" in line and ("_place" in line or "o_orderstatus" in line)]
    # Row shuffle, partial counts, and the offsets they turn into; no second shuffle of the rows.
    assert len(row_shuffles) == 3
    assert not re.search(r"Window \[row_number\(\).*\[o_orderstatus#\d+\],", text)
