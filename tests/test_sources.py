from __future__ import annotations

import os
from datetime import datetime

import pytest
from helpers import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallymatch.operators import compare_row_counts
from tallymatch.operators.compare import TABLE_KEY
from tallymatch.plans import compare_stats_files
from tallymatch.session import CHECKPOINT_DIR, shared_folder
from tallymatch.sources import (
    bind_date,
    metric_sql_frame,
    open_table,
    read_metastore_jdbc,
    read_metrics_tsv,
    read_stats_csv,
    read_strict_tsv,
)

HEADER = (
    "database_name,table_name,table_type,partition_name,num_files,total_size,raw_data_size,num_rows,"
    "last_access_time,data_dt"
)


def save(folder, name, *lines, end="\n"):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as handle:
        handle.write("".join(line + end for line in lines))
    return path


def test_stats_csv_by_header(spark, folder):
    path = save(
        folder,
        "s.csv",
        HEADER,
        "shop,dates,MANAGED_TABLE,,731,4783,1,511525,0,20260101",
        'shop,"odd,name",EXTERNAL_TABLE,dt,,,,,0,20260101',
        end="\r\n",
    )
    plain = read_stats_csv(spark, path)
    assert {t for _, t in plain.dtypes} == {"string"}
    picked = ("table_name", "partition_name", "num_rows", "num_files", "raw_data_size", "data_dt")
    assert rows(plain, *picked) == [
        ("dates", None, "511525", "731", "1", "20260101"),
        ("odd,name", "dt", None, None, None, "20260101"),
    ]
    legacy = read_stats_csv(spark, path, legacy_stats_layout=True)
    assert rows(legacy, *picked)[0] == ("dates", None, "731", "1", "511525", "20260101")


def test_stats_csv_without_header_and_date(spark, folder):
    path = save(folder, "s.csv", "shop,a,MANAGED_TABLE,dt=1,,,,,0")
    assert rows(read_stats_csv(spark, path, header=False)) == [
        ("shop", "a", "MANAGED_TABLE", "dt=1", None, None, None, None, "0", None)
    ]


def test_missing_stats_file(spark, folder):
    with pytest.raises(AnalysisException):
        read_stats_csv(spark, f"{folder}/none.csv")
    empty = read_stats_csv(spark, f"{folder}/none.csv", missing_ok=True, row_order=True)
    assert empty.count() == 0
    assert compare_row_counts(empty, empty, order=("row_order",)).count() == 0


def test_compare_files_in_the_old_layout(spark, folder):
    """Compared as labelled, the label lies; put right, the counts agree or differ as they do."""
    old = save(folder, "o.csv", HEADER, "shop,a,M,,10,1,1,900,0,d", "shop,b,M,,,,,,0,d")
    new = save(folder, "n.csv", HEADER, "shop,a,M,,12,1,1,900,0,d")
    assert rows(compare_stats_files(spark, old, new), "table_name", "diff_value") == [("a", 0), ("b", 0)]
    fixed = compare_stats_files(spark, old, new, legacy_stats_layout=True)
    assert rows(fixed, "table_name", "old_value", "new_value", "diff_value") == [
        ("a", 10, 12, 2), ("b", None, None, 0),
    ]
    wide = compare_stats_files(spark, old, new, legacy_stats_layout=True, wide=True)
    assert rows(wide, "table_name", "status", "diff_num_rows") == [
        ("a", "difference", 2), ("b", "only_in_old", None),
    ]


def test_last_line_of_a_split_file_wins(spark, folder):
    """The file is read in several splits, out of order; its last line must still win."""
    lines = [f"shop,t{i % 50},M,dt={i},{i},1,1,{i},0,d" for i in range(20_000)]
    path = save(folder, "o.csv", HEADER, *lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        result = compare_stats_files(spark, path, path, key=TABLE_KEY)
        assert read_stats_csv(spark, path).rdd.getNumPartitions() > 4
        got = rows(result, "table_name", "partition_name", "old_value", "new_value")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted((f"t{i % 50}", f"dt={i}", i, i) for i in range(19_950, 20_000))


def test_metrics_tsv(spark, folder):
    lines = (
        "old\tshop.a\tdt\trow_count\t0\t2026-03-23 09:47:38.039\t2024-03-20",
        "old\tshop.a\tdt\tx_sum\tNULL\t2026-03-23 09:47:38.5\t2024-03-20",
        'old\tshop.b\t\tx_sum\t""\tNULL\t2024-03-20',
    )
    at = datetime(2026, 3, 23, 9, 47, 38, 39000)
    want = [
        ("shop.a", "dt", "0", at, "2024-03-20"),
        ("shop.a", "dt", None, at.replace(microsecond=500000), "2024-03-20"),
        ("shop.b", None, "", None, "2024-03-20"),
    ]
    picked = ("table_name", "partition_col", "value", "computed_at", "data_dt")
    bare = read_metrics_tsv(spark, save(folder, "bare.tsv", *lines))
    assert sorted(rows(bare, *picked), key=str) == sorted(want, key=str)
    head = "cluster\ttable_name\tpartition_col\tmetric_name\tvalue\tcomputed_at\tdata_dt"
    headed = read_metrics_tsv(spark, save(folder, "head.tsv", head, *lines), header=True)
    assert sorted(rows(headed, *picked), key=str) == sorted(want, key=str)


def test_ragged_lines_go_whatever_is_selected(spark, folder):
    path = save(folder, "r.tsv", "a\tb\tc", "1\t2\t3", "1\t2", "1\t2\t3\t4", "", "\t\t")
    df = read_strict_tsv(spark, path, ["a", "b", "c"], header=True)
    assert df.count() == 2
    assert rows(df, "a") == [("",), ("1",)]
    assert df.agg(F.count("b")).first()[0] == 2
    assert rows(df.where("a = '1'")) == [("1", "2", "3")]


def test_bind_date():
    assert bind_date("where dt = '{{data_dt}}'", "2026-01-01") == "where dt = :data_dt"
    assert bind_date("like '%={{data_dt}}%'", "2026-01-01") == "like '%=2026-01-01%'"
    with pytest.raises(ValueError):
        bind_date("like '%={{data_dt}}%'", "x' or '1'='1")


def test_metric_sql(spark):
    spark.range(10).selectExpr("id", "if(id < 4, '2026-01-01', 'no') dt").createOrReplaceTempView("tm_rows")
    quote = "x' OR '1' = '1"
    legacy = "select 'tm' table_name, '{{data_dt}}' data_dt, count(1) n, null as m from tm_rows where dt = '{{data_dt}}'"
    assert rows(metric_sql_frame(spark, legacy, "2026-01-01", "old"), "table_name", "metric_name", "value", "data_dt") == [
        ("tm", "m", None, "2026-01-01"), ("tm", "n", "4", "2026-01-01"),
    ]
    assert rows(metric_sql_frame(spark, legacy, quote, "old").where("metric_name = 'n'"), "value", "data_dt") == [
        ("0", quote)
    ]


def test_metastore_over_jdbc_splits_every_read():
    """No database here: a stand-in session records what would be read."""

    class Reader:
        def __init__(self, seen, options=()):
            self.seen, self.set = seen, dict(options)

        def format(self, kind):
            return self.option("format", kind)

        def option(self, key, value):
            return Reader(self.seen, {**self.set, key: value})

        def options(self, **more):
            return Reader(self.seen, {**self.set, **more})

        def load(self):
            self.seen.append(self.set)
            return self

        def first(self):
            return (None, None) if "FROM PARTITIONS" in self.set["query"] else (1, 1000)

        def select(self, *columns):
            return self.set["dbtable"], columns

    class Session:
        seen = []
        read = Reader(seen)

    store = read_metastore_jdbc(Session, "jdbc:x", {"user": "u"}, tasks=16)
    assert store.PARTITION_KEYS == ("PARTITION_KEYS", ("TBL_ID",))
    tables = {o["dbtable"]: o for o in Session.seen if "dbtable" in o}
    assert len(tables) == 6 and all(o["url"] == "jdbc:x" and o["user"] == "u" for o in Session.seen)
    assert tables["PARTITION_PARAMS"]["partitionColumn"] == "PART_ID"
    assert tables["TBLS"]["numPartitions"] == "16" and "numPartitions" not in tables["PARTITIONS"]


def test_open_table(spark):
    df = spark.range(1)
    assert open_table(spark, "db.t", {"db.t": df}) is df
    with pytest.raises(AnalysisException):
        open_table(spark, "nowhere.t")


def test_shared_folder(spark):
    base = spark.conf.get(CHECKPOINT_DIR, None)
    one, two = shared_folder(spark), shared_folder(spark)
    assert one != two
    assert base is None or one.startswith(base)
