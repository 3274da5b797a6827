from __future__ import annotations

from datetime import datetime

from helpers import rows
from pyspark.sql import functions as F

from tallymatch.functions import as_missing, dashed_date, dashed_date_text, to_long
from tallymatch.model import METRIC_SCHEMA
from tallymatch.operators import (
    as_metric_rows,
    latest_by_key,
    latest_run,
    metric_names,
    normalise_metrics,
    union_all,
    unpivot_metrics,
)


def test_unpivot_keeps_nulls_and_prints_counts_as_counts(spark):
    wide = spark.sql(
        "select 't' table_name, '2026-01-01' data_dt, 'dt' partition_col, "
        "timestamp'2026-01-01 00:00:00' computed_at, 5L row_count, 1.50 a_sum, "
        "cast(null as decimal(9,2)) b_sum"
    )
    long = unpivot_metrics(wide, "old")
    assert [(f.name, f.dataType) for f in long.schema] == [(f.name, f.dataType) for f in METRIC_SCHEMA]
    at = datetime(2026, 1, 1)
    assert [tuple(r) for r in long.collect()] == [
        ("old", "t", "dt", "row_count", "5", at, "2026-01-01"),
        ("old", "t", "dt", "a_sum", "1.50", at, "2026-01-01"),
        ("old", "t", "dt", "b_sum", None, at, "2026-01-01"),
    ]


def test_absent_base_columns_are_null(spark):
    long = unpivot_metrics(spark.sql("select 't' as TABLE_NAME, 7 as n"), "new")
    assert rows(long) == [("new", "t", None, "n", "7", None, None)]


def test_no_metric_columns_give_no_rows(spark):
    wide = spark.sql("select 't' table_name, 'd' data_dt")
    assert metric_names(wide) == [] and unpivot_metrics(wide, "old").count() == 0


def test_metric_rows_cast_by_name(spark):
    df = spark.sql("select 3 as value, 'x' as cluster, '2026-01-01 00:00:01' as computed_at")
    assert rows(as_metric_rows(df)) == [
        ("x", None, None, None, "3", datetime(2026, 1, 1, 0, 0, 1), None)
    ]


def test_union_of_many(spark):
    frames = [spark.range(i, i + 1) for i in range(7)]
    assert sorted(r.id for r in union_all(frames).collect()) == list(range(7))


def test_missing_spellings(spark):
    df = spark.createDataFrame([("",), (None,), ("NULL",), ("Null",), ("0",), (" ",)], "v string")
    assert [r[0] for r in df.select(as_missing(F.col("v"))).collect()] == [None] * 4 + ["0", " "]


def test_normalise_metrics(spark):
    long = unpivot_metrics(spark.sql("select '' partition_col, 'null' m"), "old")
    assert rows(normalise_metrics(long), "partition_col", "value") == [(None, None)]


def test_numbers(spark):
    given = ["12", " 12 ", "+5", "-7", "1.5", "abc", "", None, "9223372036854775808"]
    df = spark.createDataFrame([(v,) for v in given], "v string")
    want = [12, 12, 5, -7, None, None, None, None, None]
    assert [r[0] for r in df.select(to_long(F.col("v"))).collect()] == want


def test_dates(spark):
    given = ["20250324", "2025-03-24", "202503", "", None]
    df = spark.createDataFrame([(v,) for v in given], "v string")
    want = ["2025-03-24", "2025-03-24", "202503", "", None]
    assert [r[0] for r in df.select(dashed_date(F.col("v"))).collect()] == want
    assert [dashed_date_text(v) for v in given[:4]] == want[:4]


def test_last_row_by_order_with_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, None), ("b", 1, "p"), ("b", 1, "q"), (None, None, "n"), (None, 0, "m")],
        "k string, o int, v string",
    )
    assert rows(latest_by_key(df, ["k"], ["o"])) == [(None, 0, "m"), ("a", 2, None), ("b", 1, "q")]


def test_latest_run_on_a_hot_key(spark):
    """A third of all rows repeat one metric; one row of it is left."""
    n = 30_000
    long = spark.range(n).selectExpr(
        "'old' cluster",
        "case when id % 3 = 0 then 'hot' else concat('t', id) end table_name",
        "'dt' partition_col",
        "'row_count' metric_name",
        "cast(id as string) value",
        "timestamp_seconds(id) computed_at",
        "'2026-01-01' data_dt",
    )
    latest = latest_run(long)
    assert latest.count() == n - n // 3 + 1
    assert rows(latest.where("table_name = 'hot'"), "value") == [(str((n - 1) // 3 * 3),)]
