from __future__ import annotations

import os
from datetime import datetime

import pytest
from helpers import plan_of, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallymatch import TableSpec
from tallymatch import model as M
from tallymatch.operators import compare_metrics
from tallymatch.plans import (
    collect_metrics,
    collect_metrics_by_partition,
    collect_metrics_sql,
    compare_stored,
    ingest_old,
    measure_to_tsv,
    reconcile_metrics,
    reconcile_partitions,
    run_all,
    run_new,
    store_metrics,
)
from tallymatch.sinks import export_metrics_tsv
from tallymatch.sources import read_metrics_tsv, read_slices

AT = datetime(2026, 1, 1)
DT = "2026-01-01"
SPECS = [
    TableSpec.of("shop.a", ["dt"], {"x": "decimal(16,2)"}),
    TableSpec.of("shop.b", (), {"y": "decimal(16,2)"}),
]


@pytest.fixture
def tables(spark):
    return {
        "shop.a": spark.createDataFrame([(DT, "1.50"), (DT, "2"), ("2026-01-02", "7")], "dt string, x string"),
        "shop.b": spark.createDataFrame([("5",)], "y string"),
    }


def summary(spark, target):
    return read_slices(spark, target, M.METRIC_SCHEMA)


def test_full_run(spark, tables, folder):
    old = collect_metrics(spark, SPECS, DT, "old", tables=tables, computed_at=AT)
    assert old.skipped == {}
    assert export_metrics_tsv(old.metrics, f"{folder}/old") == 4
    changed = {**tables, "shop.b": tables["shop.b"].withColumn("y", F.lit("6"))}
    for _ in range(2):
        result = run_all(
            spark, f"{folder}/old", SPECS, DT, f"{folder}/summary", overwrite=True, tables=changed, computed_at=AT
        )
        assert rows(result, "table_name", "partition_col", "metric_name", "old_value", "new_value", "status") == [
            ("shop.a", "dt", "row_count", "2", "2", "PASS"),
            ("shop.a", "dt", "x_sum", "3.50", "3.50", "PASS"),
            ("shop.b", None, "row_count", "1", "1", "PASS"),
            ("shop.b", None, "y_sum", "5.00", "6.00", "FAIL"),
        ]
    assert summary(spark, f"{folder}/summary").count() == 8


def test_text_export_of_either_side(spark, tables, folder):
    assert measure_to_tsv(spark, SPECS, DT, "old", f"{folder}/old", tables=tables, computed_at=AT) == {}
    assert ingest_old(spark, f"{folder}/old", f"{folder}/s") == 4
    run_new(spark, SPECS, DT, f"{folder}/s", tables=tables, computed_at=AT, tsv_path=f"{folder}/new")
    old, new = (read_metrics_tsv(spark, f"{folder}/{side}") for side in ("old", "new"))
    picked = ("table_name", "metric_name", "value", "computed_at", "data_dt")
    assert rows(old, *picked) == rows(new, *picked)
    assert rows(new.select("cluster").distinct()) == [("new",)]
    assert measure_to_tsv(spark, ["select 1 as n"], DT, "old", f"{folder}/sql") == {}
    assert rows(read_metrics_tsv(spark, f"{folder}/sql"), "metric_name", "value") == [("n", "1")]


def test_header_line_is_not_loaded(spark, folder):
    with open(f"{folder}/o.tsv", "w") as f:
        f.write("cluster\ttable_name\tpartition_col\tmetric_name\tvalue\tcomputed_at\tdata_dt\n")
        f.write("old\tt\tdt\trow_count\t0\t2026-03-23 09:47:38.039\t2024-03-20\n")
    assert ingest_old(spark, f"{folder}/o.tsv", f"{folder}/s", header=True) == 1
    assert rows(compare_stored(spark, f"{folder}/s", "2024-03-20"), "old_value", "status") == [("0", "MISSING_NEW")]


def test_sql_statements(spark, tables, folder):
    tables["shop.a"].createOrReplaceTempView("tm_a")
    statements = [
        "select 'shop.a' table_name, '{{data_dt}}' data_dt, 'dt' partition_col, current_timestamp() computed_at, "
        "count(1) row_count from tm_a where dt = '{{data_dt}}'",
        "select count(1) row_count from tm_nowhere",
    ]
    with pytest.raises(PySparkException):
        collect_metrics_sql(spark, statements, DT, "new")
    run = collect_metrics_sql(spark, statements, DT, "new", on_error="skip")
    assert list(run.skipped) == ["statement 2"] and rows(run.metrics, "value") == [("2",)]
    assert list(run_new(spark, statements, DT, f"{folder}/s", on_error="skip")) == ["statement 2"]
    assert rows(summary(spark, f"{folder}/s"), "cluster", "value", "data_dt") == [("new", "2", DT)]


def test_unreadable_tables_are_reported(spark, tables):
    specs = [*SPECS, TableSpec.of("shop.nowhere")]
    with pytest.raises(PySparkException):
        collect_metrics(spark, specs, DT, "old", tables=tables)
    run = collect_metrics(spark, specs, DT, "old", tables=tables, on_error="skip")
    assert list(run.skipped) == ["shop.nowhere"] and run.metrics.count() == 4
    none = collect_metrics(spark, specs[2:], DT, "old", on_error="skip")
    assert none.metrics.count() == 0 and none.metrics.schema == M.METRIC_SCHEMA
    with pytest.raises(ValueError):
        collect_metrics(spark, specs, DT, "old", on_error="ignore")


def test_stored_in_several_jobs(spark, tables, folder):
    specs = [TableSpec.of(f"shop.t{i}", (), {"y": "decimal(16,2)"}) for i in range(5)]
    frames = {s.name: tables["shop.b"] for s in specs}
    for _ in range(2):
        skipped = store_metrics(
            spark, specs, DT, "new", f"{folder}/s", tables=frames, overwrite=True, tables_per_job=2
        )
        assert skipped == {} and summary(spark, f"{folder}/s").count() == 10


def test_table_that_fails_while_running_costs_only_itself(spark, tables, folder):
    broken = tables["shop.b"].withColumn("y", F.raise_error(F.lit("disk gone")).cast("string"))
    specs = [*SPECS, TableSpec.of("shop.broken", (), {"y": "decimal(16,2)"})]
    frames = {**tables, "shop.broken": broken}
    with pytest.raises(PySparkException):
        store_metrics(spark, specs, DT, "new", f"{folder}/s", tables=frames, overwrite=True)
    skipped = store_metrics(
        spark, specs, DT, "new", f"{folder}/s", tables=frames, overwrite=True, on_error="skip"
    )
    assert list(skipped) == ["shop.broken"] and "disk gone" in skipped["shop.broken"]
    assert rows(summary(spark, f"{folder}/s").select("table_name").distinct()) == [("shop.a",), ("shop.b",)]


def test_damaged_file_costs_only_its_table(spark, tables, folder):
    tables["shop.a"].coalesce(1).write.parquet(f"{folder}/a")
    bad = spark.read.parquet(f"{folder}/a")
    for name in os.listdir(f"{folder}/a"):
        if name.endswith(".parquet"):
            with open(f"{folder}/a/{name}", "r+b") as f:
                f.seek(4)
                f.write(b"\xff" * 200)
    frames = {**tables, "shop.a": bad}
    skipped = store_metrics(spark, SPECS, DT, "new", f"{folder}/s", tables=frames, on_error="skip")
    assert list(skipped) == ["shop.a"]
    assert rows(summary(spark, f"{folder}/s").select("table_name").distinct()) == [("shop.b",)]


def test_slices_prune_the_stored_table(spark, tables, folder):
    store_metrics(spark, SPECS, DT, "old", f"{folder}/s", tables=tables)
    plan = plan_of(compare_stored(spark, f"{folder}/s", DT))
    pruned = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "cluster" in pruned and "data_dt" in pruned
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_single_plan_reconciliation(spark, tables):
    result = reconcile_metrics(spark, SPECS, DT, tables, tables)
    assert result.count() == 4 and result.where("status <> 'PASS'").count() == 0


def test_all_dates_equal_single_dates(spark, tables):
    changed = {"shop.a": tables["shop.a"].where("x <> '7'")}
    result = reconcile_partitions(spark, SPECS[:1], tables, changed)
    assert rows(result, "data_dt", "metric_name", "status") == [
        (DT, "row_count", "PASS"), (DT, "x_sum", "PASS"),
        ("2026-01-02", "row_count", "MISSING_NEW"), ("2026-01-02", "x_sum", "MISSING_NEW"),
    ]
    old, new = (
        collect_metrics_by_partition(spark, SPECS[:1], side, tables=t).metrics
        for side, t in (("old", tables), ("new", changed))
    )
    assert rows(result) == rows(compare_metrics(old, new))
    retyped = {"shop.a": changed["shop.a"].withColumn("dt", F.to_date("dt"))}
    assert rows(reconcile_partitions(spark, SPECS[:1], tables, retyped)) == rows(result)
    some = reconcile_partitions(spark, SPECS[:1], tables, changed, dates=[DT])
    assert some.count() == 2


def test_each_side_is_scanned_once(spark, tables, folder):
    tables["shop.a"].write.parquet(f"{folder}/a")
    df = spark.read.parquet(f"{folder}/a")
    plan = plan_of(reconcile_partitions(spark, SPECS[:1], {"shop.a": df}, {"shop.a": df}))
    assert plan.count("FileScan") == 2 and plan.count("Exchange") == 2 and "Join" not in plan


def test_narrow_specs_give_the_same_metrics(spark):
    columns = [f"c{i}" for i in range(7)]
    df = spark.range(20).selectExpr("cast(id % 2 as string) dt", *[f"cast(id * {i} as decimal(9,2)) c{i}" for i in range(7)])
    for part in ((), ("dt",)):
        spec = TableSpec("shop.wide", part, TableSpec.of("x", (), columns).fields)
        narrow = spec.narrow(3)
        assert [len(s.metrics) for s in narrow] == [4, 3, 1] and spec.narrow(7) == [spec]
        frames = {"shop.wide": df}
        one = collect_metrics(spark, [spec], "1", "old", tables=frames, computed_at=AT).metrics
        many = collect_metrics(spark, narrow, "1", "old", tables=frames, computed_at=AT).metrics
        assert rows(one) == rows(many)
    one = collect_metrics_by_partition(spark, [spec], "old", tables=frames, computed_at=AT).metrics
    many = collect_metrics_by_partition(spark, narrow, "old", tables=frames, computed_at=AT).metrics
    assert rows(one) == rows(many) and one.count() == 16


def _one_bad(spark):
    good = spark.createDataFrame([("1",)], "amount string")
    return {"a": good, "b": good.select(F.raise_error(F.lit("boom")).cast("string").alias("amount"))}


@pytest.mark.parametrize("per_job", [1, 200])
def test_slice_is_replaced_whole_or_not_at_all(spark, folder, per_job):
    specs = [TableSpec.of(n, (), {"amount": "decimal(10,2)"}) for n in ("a", "b")]
    tables = _one_bad(spark)
    fine = {"a": tables["a"], "b": tables["a"]}
    store = lambda t, **how: store_metrics(
        spark, specs, "d", "old", f"{folder}/s", tables=t, overwrite=True, tables_per_job=per_job, **how
    )
    assert store(fine) == {}
    before = rows(spark.read.parquet(f"{folder}/s"), "table_name", "metric_name", "computed_at")
    assert len(before) == 4 and len({r[2] for r in before}) == 1
    with pytest.raises(Exception, match="boom"):
        store(tables)
    assert rows(spark.read.parquet(f"{folder}/s"), "table_name", "metric_name", "computed_at") == before
    assert set(store(tables, on_error="skip")) == {"b"}
    assert {r[0] for r in rows(spark.read.parquet(f"{folder}/s"), "table_name")} == {"a"}


def test_nothing_measured_raises(spark, folder):
    spec = TableSpec.of("b", (), {"amount": "decimal(10,2)"})
    with pytest.raises(RuntimeError, match="nothing was measured"):
        store_metrics(spark, [spec], "d", "old", f"{folder}/s", tables=_one_bad(spark), on_error="skip")


def test_sides_are_never_the_same_catalog(spark):
    with pytest.raises(ValueError, match="same tables"):
        reconcile_metrics(spark, [TableSpec.of("t")], "d")
    with pytest.raises(ValueError, match="neither side"):
        reconcile_partitions(spark, [TableSpec.of("t", ["dt"])], {}, {})
