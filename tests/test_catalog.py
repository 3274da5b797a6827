from __future__ import annotations

import pytest
from helpers import plan_of, rows

from tallymatch.model import STATS_SCHEMA
from tallymatch.operators import Metastore, catalog_stats, params_wide, partition_stats, table_level_stats
from tallymatch.plans import reconcile_catalogs
from tallymatch.sources import file_metastore
from tallymatch.sources.metastore import RELATIONS, split_options


@pytest.fixture
def store(spark):
    def frame(schema, *data):
        return spark.createDataFrame(list(data), schema)

    params = "PARAM_KEY string, PARAM_VALUE string"
    return Metastore.of(
        {
            "DBS": frame("DB_ID long, NAME string", (1, "shop"), (2, "empty")),
            "TBLS": frame(
                "TBL_ID long, DB_ID long, TBL_NAME string, TBL_TYPE string, LAST_ACCESS_TIME long",
                (10, 1, "plain", "MANAGED_TABLE", 0),
                (11, 1, "bare", "EXTERNAL_TABLE", 5),
                (12, 1, "daily", "MANAGED_TABLE", 0),
                (13, 1, "regional", "MANAGED_TABLE", 0),
                (14, 99, "orphan", "MANAGED_TABLE", 0),
            ),
            "PARTITION_KEYS": frame("TBL_ID long", (12,), (13,), (13,)),
            "TABLE_PARAMS": frame(
                f"TBL_ID long, {params}",
                (10, "numRows", "731"),
                (10, "totalSize", "4783"),
                (10, "numFiles", "1"),
                (10, "rawDataSize", "many"),
                (10, "comment", "7"),
                (12, "numRows", "99"),
            ),
            "PARTITIONS": frame(
                "PART_ID long, TBL_ID long, PART_NAME string, LAST_ACCESS_TIME long",
                (100, 12, "dt=2025-03-24", 7),
                (101, 12, "dt=2025-03-25", 0),
                (102, 13, "region=x/dt=2025-03-24", 0),
                (103, 12, "dt=20250324", 0),
            ),
            "PARTITION_PARAMS": frame(
                f"PART_ID long, {params}",
                (100, "numRows", "35"),
                (100, "numFiles", "2"),
                (101, "numRows", "36"),
                (103, "numRows", "37"),
            ),
        }
    )


def test_params_to_columns(store):
    assert rows(params_wide(store.TABLE_PARAMS, "TBL_ID")) == [
        (10, 731, 4783, 1, None), (12, 99, None, None, None),
    ]


def test_unpartitioned_tables(store):
    stats = table_level_stats(store, "20250324")
    assert [(f.name, f.dataType) for f in stats.schema] == [(f.name, f.dataType) for f in STATS_SCHEMA]
    assert rows(stats) == [
        ("shop", "bare", "EXTERNAL_TABLE", "", None, None, None, None, 5, "20250324"),
        ("shop", "plain", "MANAGED_TABLE", "", 731, 4783, 1, None, 0, "20250324"),
    ]


@pytest.mark.parametrize("data_dt", ["20250324", "2025-03-24"])
def test_partitions_of_a_date(store, data_dt):
    assert rows(partition_stats(store, data_dt)) == [
        ("shop", "daily", "MANAGED_TABLE", "dt=2025-03-24", 35, None, 2, None, 7, data_dt),
        ("shop", "regional", "MANAGED_TABLE", "region=x/dt=2025-03-24", None, None, None, None, 0, data_dt),
    ]


def test_either_spelling(store):
    found = partition_stats(store, "20250324", either_spelling=True)
    assert rows(found, "partition_name", "num_rows") == [
        ("dt=2025-03-24", 35), ("dt=20250324", 37), ("region=x/dt=2025-03-24", None),
    ]


def test_union_and_compare(store):
    assert catalog_stats(store, "20250324").count() == 4
    result = reconcile_catalogs(store, store, "20250324")
    assert rows(result.select("diff_value").distinct()) == [(0,)] and result.count() == 4
    assert reconcile_catalogs(store, store, "20250324", wide=True).count() == 0


def test_plan_has_one_join_per_relation_and_pushes_filters(spark, store, folder):
    for name in RELATIONS:
        getattr(store, name).write.parquet(f"{folder}/{name}")
    plan = plan_of(catalog_stats(file_metastore(spark, folder), "20250324"))
    assert plan.count("Join") == 7
    assert "In(PARAM_KEY, [" in plan
    assert "StringContains(PART_NAME,=2025-03-24)" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_staged_partitions_are_read_once(spark, store, folder):
    for name in RELATIONS:
        getattr(store, name).write.parquet(f"{folder}/{name}")
    source = file_metastore(spark, folder)
    staged = partition_stats(source, "20250324", stage=True)
    plan = plan_of(staged)
    assert rows(staged) == rows(partition_stats(source, "20250324"))
    lazy = plan_of(partition_stats(source, "20250324"))
    assert "PART_NAME" in lazy and "PART_NAME" not in plan  # PARTITIONS itself is not read any more
    assert plan.count("ReadSchema: struct<PART_ID:bigint,PARAM_KEY") == 1


def test_wide_catalogs_need_no_sort(store):
    result = reconcile_catalogs(store, store, "20250324", wide=True, include_equal=True)
    sorted_form = reconcile_catalogs(store, store, "20250324", wide=True, include_equal=True, unique_keys=False)
    assert rows(result) == rows(sorted_form) and result.count() == 4


def test_jdbc_split():
    assert split_options("TBL_ID", None, None, 8) == {}
    assert split_options("TBL_ID", 5, 6, 8)["numPartitions"] == "2"
    assert split_options("TBL_ID", 1, 1000, 8) == {
        "partitionColumn": "TBL_ID", "lowerBound": "1", "upperBound": "1001", "numPartitions": "8",
    }
