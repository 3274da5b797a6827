from __future__ import annotations

import pytest
from helpers import plan_of, rows
from pyspark.sql import functions as F

from tallymatch.operators import compare_row_counts, compare_stats_wide, preview
from tallymatch.operators.compare import TABLE_KEY

COLUMNS = (
    "database_name string, table_name string, partition_name string, num_rows string, "
    "total_size string, num_files string, raw_data_size string, data_dt string"
)


def stats(spark, *items):
    """(table, partition, num_rows[, total, files, raw]) in database ``shop``."""
    data = [("shop", t, p, *(list(m) + [None] * 4)[:4], "20260101") for t, p, *m in items]
    return spark.createDataFrame(data, COLUMNS)


def test_row_counts(spark):
    old = stats(spark, ("a", "", "10"), ("b", "dt=1", ""), ("c", None, "abc"), ("d", "", "1.5"), ("e", "", "4"))
    new = stats(spark, ("a", None, "12"), ("b", "dt=1", "3"), ("c", "", "7"), ("d", "", "1"), ("f", "", "6"))
    result = compare_row_counts(old, new)
    assert result.columns == [
        "database_name", "table_name", "partition_name", "metric_name",
        "old_value", "new_value", "diff_value", "data_dt",
    ]
    assert rows(result.drop("database_name", "metric_name", "data_dt")) == [
        ("a", None, 10, 12, 2),
        ("b", "dt=1", None, 3, 3),
        ("c", None, None, 7, 7),
        ("d", None, None, 1, 1),
        ("e", None, 4, None, -4),
        ("f", None, None, 6, 6),
    ]
    assert rows(result.select("metric_name", "data_dt").distinct()) == [("num_rows", "20260101")]


def test_partitions_are_compared_one_by_one(spark):
    old = stats(spark, ("a", "dt=1", "1"), ("a", "dt=2", "2"))
    new = stats(spark, ("a", "dt=1", "1"), ("a", "dt=2", "5"))
    assert rows(compare_row_counts(old, new), "partition_name", "diff_value") == [("dt=1", 0), ("dt=2", 3)]


def test_last_row_of_a_table_wins_in_table_mode(spark):
    old = stats(spark, ("a", "dt=1", "1"), ("a", "dt=2", "2"))
    new = stats(spark, ("a", "dt=1", "9"), ("a", "dt=0", "5"))
    number = F.monotonically_increasing_id()
    result = compare_row_counts(
        old.coalesce(1).withColumn("n", number),
        new.coalesce(1).withColumn("n", number),
        key=TABLE_KEY,
        order=("n",),
    )
    assert rows(result, "partition_name", "old_value", "new_value") == [("dt=2", 2, 5)]


def test_old_row_decides_partition_name_even_if_blank(spark):
    result = compare_row_counts(
        stats(spark, ("a", "", "1"), ("b", None, "1")),
        stats(spark, ("a", "dt=1", "1"), ("b", "dt=1", "1"), ("c", "dt=1", "1")),
        key=TABLE_KEY,
    )
    assert rows(result, "table_name", "partition_name") == [("a", None), ("b", None), ("c", "dt=1")]


def test_overflow_is_null(spark):
    top = str(2**63 - 1)
    result = compare_row_counts(stats(spark, ("a", "", "-" + top)), stats(spark, ("a", "", top)))
    assert rows(result, "new_value", "diff_value") == [(2**63 - 1, None)]


def test_wide_golden_rows(spark):
    old = stats(
        spark,
        ("views", "dt=1", "2500", "256000", "25", "128000"),
        ("provinces", "dt=1", "1000", "102400", "10", "51200"),
        ("actions", "dt=1", "2000", "204800", "20", "102400"),
        ("same", "", "1", "1", "1", None),
    )
    new = stats(
        spark,
        ("added", "dt=1", "500", "51200", "5", "25600"),
        ("provinces", "dt=1", "1200", "122880", "12", "61440"),
        ("actions", "dt=1", "2200", "225280", "22", "112640"),
        ("same", None, "1", "1", "1", ""),
    )
    none = (None,) * 4
    want = [
        ("actions", "dt=1", "difference", 2000, 204800, 20, 102400, 2200, 225280, 22, 112640, 200, 20480, 2, 10240),
        ("added", "dt=1", "only_in_new", *none, 500, 51200, 5, 25600, *none),
        ("provinces", "dt=1", "difference", 1000, 102400, 10, 51200, 1200, 122880, 12, 61440, 200, 20480, 2, 10240),
        ("views", "dt=1", "only_in_old", 2500, 256000, 25, 128000, *none, *none),
    ]
    assert rows(compare_stats_wide(old, new).drop("database_name")) == want
    every = compare_stats_wide(old, new, include_equal=True, with_diff=False)
    assert rows(every.where("status = 'equal'"), "table_name") == [("same",)]
    assert len(every.columns) == 12


def test_row_with_all_blank_measures_is_present(spark):
    result = compare_stats_wide(stats(spark, ("a", "", None)), stats(spark, ("b", "", None)))
    assert rows(result, "table_name", "status") == [("a", "only_in_old"), ("b", "only_in_new")]


def test_blank_against_number_is_a_difference_without_diff(spark):
    result = compare_stats_wide(stats(spark, ("a", "", None)), stats(spark, ("a", "", "5")))
    assert rows(result, "status", "diff_num_rows") == [("difference", None)]


def test_preview_is_ordered(spark):
    side = stats(spark, *[(f"t{i:02}", "", "1") for i in range(30)])
    shown = preview(compare_row_counts(side, side))
    assert [r.table_name for r in shown.collect()] == [f"t{i:02}" for i in range(10)]
    assert "TakeOrderedAndProject" in plan_of(shown)


def test_unique_keys_plan_without_sort(spark):
    """Missing sides, NULL values, NULL and blank partitions come out as by the sorted form."""
    columns = "database_name string, table_name string, partition_name string, num_rows long, total_size long"
    old = spark.createDataFrame([("d", "a", None, 1, None), ("d", "b", "p=1", 2, 5), ("d", "c", "", None, None)], columns)
    new = spark.createDataFrame([("d", "a", "", 1, None), ("d", "b", "p=1", 3, None), ("d", "e", "x", None, 1)], columns)
    how = dict(measures=("num_rows", "total_size"), include_equal=True)
    hashed = compare_stats_wide(old, new, unique_keys=True, **how)
    assert rows(hashed) == rows(compare_stats_wide(old, new, **how)) and hashed.count() == 4
    assert "Sort" not in plan_of(hashed)
    with pytest.raises(ValueError, match="order"):
        compare_stats_wide(old, new, order=("num_rows",), unique_keys=True, **how)
