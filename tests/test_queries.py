"""Every registered query against DuckDB on whole tables."""

from __future__ import annotations

import os

import pytest
from helpers import SF_DIR
from oracle import assert_matches, connect

import __spark_entry__ as driver

QUERIES, SQL = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["data_dt", "metric_name", "old_value", "new_value", "status", "diff_num"]
    assert {r.status for r in result.select("status").distinct().collect()} >= {"PASS", "FAIL"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    assert assert_matches(QUERIES[name](spark, SF_DIR), duck, SQL[name]) > 0


def test_table_stats_files(spark):
    """The one query SQL cannot check: files and bytes must equal the file listing."""
    row = QUERIES["table_stats_files"](spark, SF_DIR).first()
    assert row.num_files == 1
    assert row.total_size == os.path.getsize(f"{SF_DIR}/orders.parquet")
    assert row.num_rows == spark.read.parquet(f"{SF_DIR}/orders.parquet").count()
    assert row.raw_data_size > 0
