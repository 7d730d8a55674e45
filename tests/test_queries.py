"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from check_oracle import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query_matches_sql(spark, con, name):
    message, _, good = compare(spark, con, name, SF_DIR)
    assert message.split()[0] in ("ok", "rows-only"), message


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
