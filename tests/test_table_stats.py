from __future__ import annotations

import glob
import os

from helpers import plan_of, rows

from tallymatch.model import STATS_SCHEMA
from tallymatch.operators import table_stats


def test_per_partition_equals_the_listing(spark, folder):
    df = spark.range(1000).selectExpr("id", "cast(id % 3 as string) as dt")
    df.repartition(4).write.partitionBy("dt").parquet(f"{folder}/t")
    stored = spark.read.schema("id long, dt string").parquet(f"{folder}/t")
    stats = table_stats(stored, "shop", "t", partition_cols=["dt"], data_dt="2026-01-01")
    assert stats.schema.fieldNames() == STATS_SCHEMA.fieldNames()
    want = []
    for dt, n in (("0", 334), ("1", 333), ("2", 333)):
        files = glob.glob(f"{folder}/t/dt={dt}/*.parquet")
        want.append((f"dt={dt}", n, sum(map(os.path.getsize, files)), len(files), None))
    got = rows(stats, "partition_name", "num_rows", "total_size", "num_files", "raw_data_size")
    assert got == sorted(want)


def test_whole_table_reads_no_column(spark, folder):
    spark.range(50).selectExpr("id", "'x' as v").repartition(3).write.parquet(f"{folder}/t")
    stats = table_stats(spark.read.parquet(f"{folder}/t"), "shop", "t")
    files = glob.glob(f"{folder}/t/*.parquet")
    size = sum(map(os.path.getsize, files))
    assert rows(stats, "partition_name", "num_rows", "total_size", "num_files") == [("", 50, size, 3)]
    assert "ReadSchema: struct<>" in plan_of(stats)


def test_no_files(spark, folder):
    spark.range(0).write.parquet(f"{folder}/t")
    stats = table_stats(spark.read.schema("id long").parquet(f"{folder}/t"), "shop", "t", estimate_raw_size=True)
    assert rows(stats, "num_rows", "total_size", "num_files", "raw_data_size") == [(0, 0, 0, 0)]


def test_raw_size_estimate(spark, folder):
    spark.sql("select 1 as a, 'xy' as b").write.parquet(f"{folder}/t")
    stats = table_stats(spark.read.parquet(f"{folder}/t"), "shop", "t", estimate_raw_size=True)
    assert rows(stats, "raw_data_size") == [(len('{"a":1,"b":"xy"}'),)]


def test_empty_files_are_listed(spark, folder):
    """A file without rows counts as a file, with its bytes, where the folder is given."""
    place = f"{folder}/t"
    years = [(2023, k) for k in range(10)] + [(2024, k) for k in range(5)]
    spark.createDataFrame(years, "y int, k long").repartition(2, "k").write.partitionBy("y").parquet(place)
    spark.createDataFrame([], "k long").coalesce(1).write.mode("append").parquet(f"{place}/y=2024")
    df = spark.read.parquet(place)
    found = {
        r.partition_name: r
        for r in table_stats(df, "d", "t", partition_cols=["y"], path=place).collect()
    }
    for year, n in ((2023, 10), (2024, 5)):
        files = [f for f in os.listdir(f"{place}/y={year}") if f.endswith(".parquet")]
        row = found[f"y={year}"]
        assert (row.num_rows, row.num_files) == (n, len(files))
        assert row.total_size == sum(os.path.getsize(f"{place}/y={year}/{f}") for f in files)
