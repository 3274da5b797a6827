"""Metastore relations over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.catalog import Metastore

# Relation -> (columns read, numeric column the read is split on).
RELATIONS = {
    "DBS": ("DB_ID, NAME", "DB_ID"),
    "TBLS": ("TBL_ID, DB_ID, TBL_NAME, TBL_TYPE, LAST_ACCESS_TIME", "TBL_ID"),
    "PARTITION_KEYS": ("TBL_ID", "TBL_ID"),
    "TABLE_PARAMS": ("TBL_ID, PARAM_KEY, PARAM_VALUE", "TBL_ID"),
    "PARTITIONS": ("PART_ID, TBL_ID, PART_NAME, LAST_ACCESS_TIME", "PART_ID"),
    "PARTITION_PARAMS": ("PART_ID, PARAM_KEY, PARAM_VALUE", "PART_ID"),
}


def split_options(id_col: str, low: int | None, high: int | None, tasks: int) -> dict[str, str]:
    """Reader options for a read split into ``tasks`` id ranges; none for an empty relation."""
    if low is None or high is None:
        return {}
    return {
        "partitionColumn": id_col,
        "lowerBound": str(low),
        "upperBound": str(high + 1),
        "numPartitions": str(max(1, min(tasks, high - low + 1))),
    }


def read_metastore_jdbc(
    spark: SparkSession, url: str, options: Mapping[str, str], *, tasks: int = 32
) -> Metastore:
    """Six lazy JDBC frames (S6), each read by many tasks over ranges of its id.

    Only the two bounds of an id, one row per relation, come to the driver.
    Column selection and the partition-name and parameter-key filters are
    pushed to the database by Spark.  ``options`` carries user, password, driver.
    """

    def relation(name: str) -> DataFrame:
        _, id_col = RELATIONS[name]
        reader = spark.read.format("jdbc").option("url", url).options(**options)
        bounds = reader.option(
            "query", f"SELECT MIN({id_col}) AS low, MAX({id_col}) AS high FROM {name}"
        ).load()
        low, high = bounds.first()
        split = split_options(id_col, low, high, tasks)
        table = spark.read.format("jdbc").option("url", url).options(**options, **split)
        wanted = [c.strip() for c in RELATIONS[name][0].split(",")]
        return table.option("dbtable", name).load().select(*wanted)

    return Metastore(**{name: relation(name) for name in RELATIONS})
