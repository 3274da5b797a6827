from __future__ import annotations

import os
import uuid
from datetime import datetime

import pytest
from helpers import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallymatch import model as M
from tallymatch.plans import publish_comparison
from tallymatch.sinks import (
    counted,
    create_tables,
    export_comparison_csv,
    export_metrics_tsv,
    export_csv,
    export_stats_csv,
    replace_comparison,
    rows_seen,
    write_metrics,
)
from tallymatch.sources import read_metrics_tsv, read_slices, read_stats_csv

AT = datetime(2026, 1, 1, 1, 2, 3, 4000)


def metrics(spark, cluster, data_dt, *values):
    data = [(cluster, "t", "", f"m{i}", v, AT, data_dt) for i, v in enumerate(values)]
    return spark.createDataFrame(data, M.METRIC_SCHEMA)


def comparison(spark, data_dt, *counts):
    data = [("shop", f"t{i}", None, "num_rows", n, n, 0, data_dt) for i, n in enumerate(counts)]
    return spark.createDataFrame(data, M.ROW_COUNT_COMPARISON_SCHEMA)


@pytest.fixture(params=["path", "table"])
def targets(request, spark, folder):
    """The two results, as folders or as catalog tables."""
    if request.param == "path":
        return f"{folder}/metrics", f"{folder}/comparison"
    return create_tables(spark, "tm_" + uuid.uuid4().hex[:8])


def test_slices(spark, targets):
    target, _ = targets

    def stored():
        return rows(read_slices(spark, target, M.METRIC_SCHEMA), "cluster", "data_dt", "metric_name", "value")

    both = metrics(spark, "old", "d1", "1", "NULL").unionByName(metrics(spark, "new", "d1", ""))
    assert write_metrics(both, target) == 3
    assert write_metrics(metrics(spark, "old", "2026-01-02", "5"), target) == 1
    assert stored() == [
        ("new", "d1", "m0", None), ("old", "2026-01-02", "m0", "5"), ("old", "d1", "m0", "1"), ("old", "d1", "m1", None),
    ]
    for _ in range(2):
        assert write_metrics(metrics(spark, "old", "d1", "8"), target, overwrite=True) == 1
        assert stored() == [("new", "d1", "m0", None), ("old", "2026-01-02", "m0", "5"), ("old", "d1", "m0", "8")]
    write_metrics(metrics(spark, "old", "d1", "8"), target)
    assert len(stored()) == 4


def test_partition_column_is_stored_as_null(spark, targets):
    write_metrics(metrics(spark, "old", "d1", "1"), targets[0])
    assert rows(read_slices(spark, targets[0], M.METRIC_SCHEMA), "partition_col", "computed_at") == [(None, AT)]


def test_replace_by_date(spark, targets):
    _, target = targets

    def stored():
        return rows(read_slices(spark, target, M.COMPARISON_TABLE_SCHEMA), "data_dt", "table_name", "old_value")

    assert replace_comparison(comparison(spark, "20260101", 1, 2), target, "20260101") == 2
    assert replace_comparison(comparison(spark, "20260102", 3), target, "20260102") == 1
    for _ in range(2):
        replace_comparison(comparison(spark, "20260101", 7), target, "20260101")
        assert stored() == [("20260101", "t0", 7), ("20260102", "t0", 3)]
    with pytest.raises(PySparkException):
        replace_comparison(comparison(spark, "20260102", 9), target, "20260101")
    with pytest.raises(PySparkException):
        replace_comparison(comparison(spark, None, 9), target, "20260101")
    assert stored() == [("20260101", "t0", 7), ("20260102", "t0", 3)]
    nothing = comparison(spark, "20260101", 1).where("old_value > 5")
    assert replace_comparison(nothing, target, "20260101") == 0
    assert stored() == [("20260102", "t0", 3)]
    with pytest.raises(ValueError):
        replace_comparison(nothing, target, "../x")


def test_etl_time(spark, targets):
    replace_comparison(comparison(spark, "d", 1), targets[1], "d")
    (row,) = read_slices(spark, targets[1], M.COMPARISON_TABLE_SCHEMA).collect()
    assert abs((datetime.now() - row.etl_tm).total_seconds()) < 86_400


def test_publish_returns_and_exports_the_stored_rows(spark, targets, folder):
    csv = f"{folder}/out"
    stored = publish_comparison(
        comparison(spark, "d", 4), targets[1], "d", etl_tm=F.lit("2026-01-01 00:00:00"), csv_path=csv
    )
    assert rows(stored, "table_name", "old_value", "etl_tm") == [("t0", 4, datetime(2026, 1, 1))]
    lines = [r[0] for r in spark.read.text(csv).collect()]
    assert lines[0] == "database_name,table_name,partition_name,metric_name,old_value,new_value,diff_value,data_dt"
    assert lines[1] == "shop,t0,,num_rows,4,4,0,d"


def test_creating_tables_twice_is_harmless(spark):
    name = "tm_" + uuid.uuid4().hex[:8]
    made = create_tables(spark, name)
    write_metrics(metrics(spark, "old", "d1", "1"), made[0])
    assert create_tables(spark, name) == made == (f"{name}.metrics_summary", f"{name}.table_comparison")
    assert spark.table(made[0]).count() == 1


def test_a_table_that_would_lose_its_siblings_is_not_overwritten(spark):
    name = "tm_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE {name}")
    table = f"{name}.plain"
    spark.sql(
        f"CREATE TABLE {table} (value string, computed_at timestamp, metric_name string, partition_col string, "
        "table_name string, cluster string, data_dt string) USING parquet PARTITIONED BY (cluster, data_dt)"
    )
    write_metrics(metrics(spark, "old", "d1", "1"), table)
    with pytest.raises(ValueError):
        write_metrics(metrics(spark, "old", "d2", "2"), table, overwrite=True)
    picked = ("data_dt", "metric_name", "value", "table_name")
    assert rows(read_slices(spark, table, M.METRIC_SCHEMA), *picked) == [("d1", "m0", "1", "t")]
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_metrics(metrics(spark, "old", "d2", "2"), table, overwrite=True)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert read_slices(spark, table, M.METRIC_SCHEMA).count() == 2


def test_tsv_round_trip(spark, folder):
    given = metrics(spark, "old", "d1", "1", "", None, 'tab"quote', "a\tb")
    assert export_metrics_tsv(given, f"{folder}/tsv") == 5
    back = read_metrics_tsv(spark, f"{folder}/tsv")
    picked = ("metric_name", "value", "computed_at", "data_dt")
    assert rows(back, *picked) == rows(given, *picked)


def test_export_without_rows_leaves_no_earlier_ones(spark, folder):
    given = spark.createDataFrame(
        [("shop", "a", "MANAGED_TABLE", "dt=1", 731, 4783, 1, 511525, 0, "d")], M.STATS_SCHEMA
    )
    assert export_stats_csv(given, f"{folder}/s") == 1
    assert export_stats_csv(given.where("false"), f"{folder}/s") == 0
    assert read_stats_csv(spark, f"{folder}/s", missing_ok=True).count() == 0


def test_export_runs_its_plan_once(spark, folder):
    seen = spark.sparkContext.accumulator(0)
    rows_in = spark.sparkContext.parallelize(range(10), 2).map(lambda k: (seen.add(1), (str(k), k))[1])
    df = spark.createDataFrame(rows_in, "a string, b long")
    assert export_csv(df, f"{folder}/once", ["a", "b"]) == 10
    assert seen.value == 10


def test_stats_export_puts_values_under_their_header(spark, folder):
    data = [("shop", "a", "MANAGED_TABLE", "dt=1", 731, 4783, 1, 511525, 0, "d")]
    stats = spark.createDataFrame(data, M.STATS_SCHEMA)
    assert export_stats_csv(stats.select(*reversed(stats.columns)), f"{folder}/s") == 1
    back = read_stats_csv(spark, f"{folder}/s")
    assert rows(back, "num_rows", "num_files", "raw_data_size") == [("731", "1", "511525")]


def test_counting_needs_no_extra_pass(spark):
    df, seen = counted(spark.range(12).where("id > 3"))
    assert df.collect() and rows_seen(seen) == 8


def test_a_hot_slice_is_written_by_several_tasks(spark, folder):
    """One slice holds nearly all rows; rebalancing splits it instead of using one task."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = spark.range(200_000).selectExpr(
            "'old' cluster", "concat('t', id) table_name", "'dt' partition_col", "'m' metric_name",
            "cast(id as string) value", "current_timestamp() computed_at", "if(id < 10, 'd2', 'd1') data_dt",
        )
        assert write_metrics(df, f"{folder}/m") == 200_000
    finally:
        for key in settings:
            spark.conf.unset(key)
    files = [f for f in os.listdir(f"{folder}/m/cluster=old/data_dt=d1") if f.endswith(".parquet")]
    assert len(files) > 1
    assert read_slices(spark, f"{folder}/m", M.METRIC_SCHEMA).count() == 200_000
