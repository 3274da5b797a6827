"""Table statistics from metastore relations read as plain tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dashed_date_text, to_long
from ..model import STAT_MEASURES, STAT_PARAM_KEYS, STATS_SCHEMA
from ..session import shared_folder


@dataclass(frozen=True)
class Metastore:
    """The six relations the statistics come from (D8), as any DataFrames."""

    DBS: DataFrame
    TBLS: DataFrame
    PARTITION_KEYS: DataFrame
    TABLE_PARAMS: DataFrame
    PARTITIONS: DataFrame
    PARTITION_PARAMS: DataFrame

    @classmethod
    def of(cls, relations: Mapping[str, DataFrame]) -> Metastore:
        return cls(**relations)


def params_wide(params: DataFrame, id_col: str) -> DataFrame:
    """Key/value parameters to one row per id with the four statistics.

    The key filter reaches the source.  Values become BIGINT inside the
    aggregate, so its buffer is fixed width and no sort is needed; parameters
    that are not whole numbers count as absent.
    """
    key, value = F.col("PARAM_KEY"), to_long(F.col("PARAM_VALUE"))
    return (
        params.where(key.isin(*STAT_PARAM_KEYS.values()))
        .groupBy(id_col)
        .agg(*[F.max(F.when(key == k, value)).alias(m) for m, k in STAT_PARAM_KEYS.items()])
    )


def _stats_rows(df: DataFrame, data_dt: str) -> DataFrame:
    named = df.select(
        F.col("NAME").alias("database_name"),
        F.col("TBL_NAME").alias("table_name"),
        F.col("TBL_TYPE").alias("table_type"),
        "partition_name",
        *STAT_MEASURES,
        F.col("last_access").alias("last_access_time"),
        F.lit(data_dt).alias("data_dt"),
    )
    return named.select(*[F.col(f.name).cast(f.dataType) for f in STATS_SCHEMA.fields])


def table_level_stats(store: Metastore, data_dt: str) -> DataFrame:
    """Tables without partition keys and their statistics.

    The anti join, the parameter aggregate and the left join all work on
    TBL_ID and share its partitioning.  The small databases relation comes
    last; its size decides at run time whether it is broadcast.
    """
    tables = store.TBLS.select(
        "TBL_ID", "DB_ID", "TBL_NAME", "TBL_TYPE", F.col("LAST_ACCESS_TIME").alias("last_access")
    )
    joined = (
        tables.join(store.PARTITION_KEYS.select("TBL_ID"), "TBL_ID", "left_anti")
        .join(params_wide(store.TABLE_PARAMS, "TBL_ID"), "TBL_ID", "left")
        .join(store.DBS.select("DB_ID", "NAME"), "DB_ID")
        .withColumn("partition_name", F.lit(""))
    )
    return _stats_rows(joined, data_dt)


def partition_stats(
    store: Metastore, data_dt: str, *, either_spelling: bool = False, stage: bool = False
) -> DataFrame:
    """Partitions that carry the date at any level, and their statistics.

    An eight-digit date is looked for as ``=yyyy-MM-dd``; ``either_spelling``
    also finds ``=yyyyMMdd``.  The parameter relation, the largest of the six,
    is cut down to the partitions found (a small side, as a rule) and aggregated
    before it is joined, so the shuffles carry one date and not all history.

    The partitions found are needed twice.  With ``stage`` they are written to the shared
    folder at once, so PARTITIONS is read a single time; without it the frame stays lazy.
    """
    name = F.col("PART_NAME")
    hit = name.contains("=" + dashed_date_text(data_dt))
    if either_spelling:
        hit = hit | name.contains("=" + data_dt)
    found = store.PARTITIONS.where(hit).select(
        "PART_ID",
        "TBL_ID",
        name.alias("partition_name"),
        F.col("LAST_ACCESS_TIME").alias("last_access"),
    )
    if stage:
        place = f"{shared_folder(found.sparkSession)}/partitions"
        found.write.parquet(place)
        found = found.sparkSession.read.schema(found.schema).parquet(place)
    wanted = store.PARTITION_PARAMS.join(found.select("PART_ID"), "PART_ID", "left_semi")
    joined = (
        found.join(params_wide(wanted, "PART_ID"), "PART_ID", "left")
        .join(store.TBLS.select("TBL_ID", "DB_ID", "TBL_NAME", "TBL_TYPE"), "TBL_ID")
        .join(store.DBS.select("DB_ID", "NAME"), "DB_ID")
    )
    return _stats_rows(joined, data_dt)


def catalog_stats(
    store: Metastore, data_dt: str, *, either_spelling: bool = False, stage: bool = False
) -> DataFrame:
    """Statistics of unpartitioned tables and of the date's partitions (U4)."""
    return table_level_stats(store, data_dt).unionByName(
        partition_stats(store, data_dt, either_spelling=either_spelling, stage=stage)
    )
