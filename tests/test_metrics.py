from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import SF_DIR, plan_of, rows
from pyspark.sql import functions as F

from tallymatch import TableSpec, specs_from_json
from tallymatch.model import Field
from tallymatch.operators import metric_frame, metrics_by_partition, spec_from_frame, unpivot_metrics

AT = datetime(2026, 1, 2, 3, 4, 5)
SALES = TableSpec.of("shop.sales", ["dt"], {"amount": "decimal(16,2)", "note": "string", "fee": "DECIMAL(10,3)"})


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [
            ("2026-01-01", "10.00", "a", "1.5"),
            ("2026-01-01", "0.25", "b", None),
            ("2026-01-01", "oops", "c", "2"),
            ("2026-01-02", "-3", "d", "0.125"),
        ],
        "dt string, amount string, note string, fee string",
    )


def test_spec_json():
    text = """{"tables": [
        {"name": "db.a", "partition_cols": ["dt", "hh"],
         "fields": [{"name": "x", "type": "Decimal(9,1)"}, {"name": "y", "type": "string"}, {"name": "z"}]},
        {"name": "db.b"}]}"""
    a, b = specs_from_json(text)
    assert a.partition_col == "dt" and [f.metric for f in a.summed] == ["x_sum", "z_sum"]
    assert a.fields[2] == Field("z", "decimal(38,2)")
    assert b.partition_col == "" and b.summed == ()


def test_one_date(sales):
    wide = metric_frame(sales, SALES, "2026-01-01", computed_at=AT)
    assert wide.columns == [
        "table_name", "data_dt", "partition_col", "computed_at", "row_count", "amount_sum", "fee_sum",
    ]
    assert rows(wide) == [
        ("shop.sales", "2026-01-01", "dt", AT, 3, Decimal("10.25"), Decimal("3.500"))
    ]


def test_empty_date_gives_zero_and_null(sales):
    long = unpivot_metrics(metric_frame(sales, SALES, "1999-01-01"), "old")
    assert rows(long, "metric_name", "value") == [
        ("amount_sum", None), ("fee_sum", None), ("row_count", "0"),
    ]


def test_unpartitioned_reads_everything(sales):
    spec = TableSpec("shop.sales", (), SALES.fields)
    assert rows(metric_frame(sales, spec, "1999-01-01"), "partition_col", "row_count") == [("", 4)]


def test_names_in_another_case(sales):
    spec = TableSpec.of("shop.sales", ["DT"], {"AMOUNT": "decimal(16,2)"})
    assert rows(metric_frame(sales, spec, "2026-01-02"), "row_count", "AMOUNT_sum") == [(1, Decimal("-3.00"))]
    assert metrics_by_partition(sales, spec).count() == 2


def test_overflow_is_null_not_an_error(spark):
    df = spark.createDataFrame([("9" * 38,), ("9" * 38,)], "x string")
    wide = metric_frame(df, TableSpec.of("t", (), {"x": "decimal(38,0)"}), "d")
    assert rows(wide, "row_count", "x_sum") == [(2, None)]


def test_cast_override(sales):
    wide = metric_frame(sales, SALES, "2026-01-01", cast_override="decimal(38,2)")
    assert wide.schema["fee_sum"].dataType.simpleString() == "decimal(38,2)"


def test_spec_from_frame(spark):
    df = spark.sql("select 1.50 as price, 'x' as name, 2 as n, cast(1 as decimal(8,0)) as dt")
    spec = spec_from_frame(df, "t", ["dt"])
    assert [(f.name, f.type) for f in spec.fields] == [("price", "decimal(3,2)")]


def test_odd_column_names(spark):
    df = spark.createDataFrame([("2.00", "3")], ["a.b", "c`d"])
    wide = metric_frame(df, TableSpec.of("t", (), ["a.b", "c`d"]), "d")
    assert rows(unpivot_metrics(wide, "new"), "metric_name", "value") == [
        ("a.b_sum", "2.00"), ("c`d_sum", "3.00"), ("row_count", "1"),
    ]


def test_current_time_by_default(sales):
    (row,) = metric_frame(sales, SALES, "2026-01-01").collect()
    assert (datetime.now() - row.computed_at).total_seconds() < 86_400


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "timestamp_ntz"])
def test_by_partition_equals_single_dates(sales, kind):
    typed = sales.withColumn("dt", F.col("dt").cast(kind))
    together = metrics_by_partition(typed, SALES, computed_at=AT)
    one = metric_frame(typed, SALES, "2026-01-01", computed_at=AT)
    both = one.unionByName(metric_frame(typed, SALES, "2026-01-02", computed_at=AT))
    assert rows(together.select(*both.columns)) == rows(both)
    assert rows(metrics_by_partition(typed, SALES, dates=["2026-01-02"]), "data_dt") == [("2026-01-02",)]


def test_rows_without_date_are_kept(spark):
    df = spark.createDataFrame([(None, "1"), ("2026-01-01", "2")], "dt string, amount string")
    spec = TableSpec.of("t", ["dt"], ["amount"])
    assert rows(metrics_by_partition(df, spec), "data_dt", "row_count") == [(None, 1), ("2026-01-01", 1)]


def test_date_that_does_not_fit_raises(spark):
    """Selecting nothing on both sides would be 0 = 0, a pass."""
    df = spark.createDataFrame([(date(2026, 1, 1),)], "dt date")
    spec = TableSpec.of("t", ["dt"])
    for kind in ("date", "timestamp", "timestamp_ntz"):
        with pytest.raises(ValueError, match="is no date"):
            metric_frame(df.withColumn("dt", F.col("dt").cast(kind)), spec, "20269999")
    with pytest.raises(ValueError):
        metric_frame(df.select(F.lit(20260101).alias("dt")), spec, "2026-01-01")
    for spelling in ("2026-01-01", "20260101"):
        assert rows(metric_frame(df, spec, spelling), "row_count") == [(1,)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_time_of_day_does_not_matter(spark, kind):
    times = ["2026-01-01 00:00:00", "2026-01-01 13:30:00", "2026-01-01 23:59:59.999999", "2026-01-02 00:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "dt string").select(F.col("dt").cast(kind).alias("dt"))
    spec = TableSpec.of("t", ["dt"])
    whole = {"2026-01-01": 3, "2026-01-02": 1}
    assert dict(rows(metrics_by_partition(df, spec), "data_dt", "row_count")) == whole
    assert dict(rows(metrics_by_partition(df, spec, dates=list(whole)), "data_dt", "row_count")) == whole
    for day, n in whole.items():
        assert rows(metric_frame(df, spec, day), "row_count") == [(n,)]


def test_predicate_and_columns_reach_the_scan(spark):
    df = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    spec = TableSpec.of("t", ["l_shipdate"], {"l_tax": "decimal(16,2)"})
    plan = plan_of(metric_frame(df, spec, "1998-03-15"))
    assert "GreaterThanOrEqual(l_shipdate,1998-03-15T00:00), LessThan(l_shipdate,1998" in plan
    assert "ReadSchema: struct<l_tax:double,l_shipdate:timestamp_ntz>" in plan
    assert plan.count("Exchange") == 1 and "Python" not in plan


def test_partition_is_pruned(spark, sales, folder):
    sales.write.partitionBy("dt").parquet(f"{folder}/sales")
    df = spark.read.schema(sales.schema).parquet(f"{folder}/sales")
    plan = plan_of(metric_frame(df, SALES, "2026-01-01"))
    assert "PartitionFilters: [isnotnull(dt" in plan and "note" not in plan.split("ReadSchema")[1]
