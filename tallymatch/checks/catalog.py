"""Statistics from metastore relations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymatch.operators import (
    catalog_stats as stats_of_catalog,
    params_wide,
    partition_stats,
    table_level_stats,
)
from tallymatch.plans import reconcile_catalogs

from .inputs import METASTORE_SQL, metastore

MONTH = "1998-03"
DAY = "19980315"


def catalog_params_pivot(spark, sf):
    return params_wide(metastore(spark, sf).TABLE_PARAMS, "TBL_ID")


def catalog_unpartitioned(spark, sf):
    return table_level_stats(metastore(spark, sf), DAY)


def catalog_partitions(spark, sf):
    return partition_stats(metastore(spark, sf), MONTH)


def catalog_partitions_day(spark, sf):
    return partition_stats(metastore(spark, sf), DAY)


def catalog_stats(spark, sf):
    return stats_of_catalog(metastore(spark, sf), DAY)


def catalog_rowcount_compare(spark, sf):
    """A second catalog in which managed tables lost their parameters."""
    old = metastore(spark, sf)
    managed = old.TBLS.where(F.col("TBL_TYPE") == "MANAGED_TABLE").select("TBL_ID")
    new = type(old)(
        DBS=old.DBS,
        TBLS=old.TBLS,
        PARTITION_KEYS=old.PARTITION_KEYS,
        TABLE_PARAMS=old.TABLE_PARAMS.join(managed, "TBL_ID", "left_anti"),
        PARTITIONS=old.PARTITIONS.join(managed, "TBL_ID", "left_anti"),
        PARTITION_PARAMS=old.PARTITION_PARAMS,
    )
    return reconcile_catalogs(old, new, MONTH)


QUERIES = {
    f.__name__: f
    for f in (
        catalog_params_pivot,
        catalog_unpartitioned,
        catalog_partitions,
        catalog_partitions_day,
        catalog_stats,
        catalog_rowcount_compare,
    )
}

_KEYS = {
    "num_rows": "numRows",
    "total_size": "totalSize",
    "num_files": "numFiles",
    "raw_data_size": "rawDataSize",
}


def _facts(params: str, id_col: str) -> str:
    numbers = ", ".join(
        f"max(CAST(PARAM_VALUE AS BIGINT)) FILTER (PARAM_KEY = '{k}') AS {m}" for m, k in _KEYS.items()
    )
    return f"SELECT {id_col}, {numbers} FROM {params} GROUP BY {id_col}"


def _stats(owner: str, params: str, id_col: str, partition: str, access: str, date: str) -> str:
    return f"""
SELECT NAME AS database_name, TBL_NAME AS table_name, TBL_TYPE AS table_type,
       {partition} AS partition_name, {", ".join(_KEYS)}, {access} AS last_access_time,
       '{date}' AS data_dt
FROM {owner} INNER JOIN DBS USING (DB_ID)
LEFT OUTER JOIN ({_facts(params, id_col)}) USING ({id_col})"""


def _tables(date: str) -> str:
    return (
        _stats("TBLS", "TABLE_PARAMS", "TBL_ID", "''", "LAST_ACCESS_TIME", date)
        + "\nWHERE TBL_ID NOT IN (SELECT TBL_ID FROM PARTITION_KEYS)"
    )


def _partitions(date: str, pattern: str) -> str:
    owner = "(SELECT * EXCLUDE (LAST_ACCESS_TIME) FROM TBLS) INNER JOIN PARTITIONS USING (TBL_ID)"
    return (
        _stats(owner, "PARTITION_PARAMS", "PART_ID", "PART_NAME", "LAST_ACCESS_TIME", date)
        + f"\nWHERE contains(PART_NAME, '={pattern}')"
    )


SQL = {
    "catalog_params_pivot": f"""
WITH {METASTORE_SQL} {_facts("TABLE_PARAMS", "TBL_ID")}""",
    "catalog_unpartitioned": f"WITH {METASTORE_SQL} {_tables(DAY)}",
    "catalog_partitions": f"WITH {METASTORE_SQL} {_partitions(MONTH, MONTH)}",
    "catalog_partitions_day": f"WITH {METASTORE_SQL} {_partitions(DAY, '1998-03-15')}",
    "catalog_stats": f"""
WITH {METASTORE_SQL} {_tables(DAY)} UNION ALL {_partitions(DAY, '1998-03-15')}""",
    "catalog_rowcount_compare": f"""
WITH {METASTORE_SQL},
stats AS ({_tables(MONTH)} UNION ALL {_partitions(MONTH, MONTH)})
SELECT database_name, table_name, nullif(partition_name, '') AS partition_name,
       'num_rows' AS metric_name, num_rows AS old_value,
       CASE WHEN table_type = 'MANAGED_TABLE' THEN NULL ELSE num_rows END AS new_value,
       CASE WHEN table_type = 'MANAGED_TABLE' THEN 0 ELSE coalesce(num_rows, 0) END
         - coalesce(num_rows, 0) AS diff_value,
       data_dt
FROM stats""",
}
