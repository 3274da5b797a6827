"""Wide metrics to long metrics, and long metrics of many tables to one frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_missing, blank_to_null, quoted
from ..model import BASE_COLUMNS, METRIC_SCHEMA


def metric_names(df: DataFrame) -> list[str]:
    """Every column that is not a base column is a metric, in frame order."""
    return [c for c in df.columns if c.lower() not in BASE_COLUMNS]


def empty_metrics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], METRIC_SCHEMA)


def _typed(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Select expressions that bring columns to their type in the long schema.

    Absent columns become NULL (U2); columns of the right type are left alone.
    """
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    expressions = []
    for name in names:
        want = METRIC_SCHEMA[name].dataType
        if types.get(name) == want:
            expressions.append(name)
        else:
            source = name if name in types else "null"
            expressions.append(f"try_cast({source} as {want.simpleString()}) as {name}")
    return expressions


def as_metric_rows(df: DataFrame) -> DataFrame:
    """Bring a frame to the long metric schema, by column name."""
    return df.selectExpr(*_typed(df, METRIC_SCHEMA.names))


def unpivot_metrics(wide: DataFrame, cluster: str) -> DataFrame:
    """One row per metric, NULL values kept, tagged with its cluster.

    Metrics turn into text *before* the unpivot: left alone, a count and a
    decimal would meet in a common decimal type and the count print as ``5.00``.
    """
    metrics = metric_names(wide)
    if not metrics:
        return empty_metrics(wide.sparkSession)
    as_text = wide.selectExpr(
        *_typed(wide, BASE_COLUMNS), *[f"cast({quoted(m)} as string) as {quoted(m)}" for m in metrics]
    )
    long = as_text.unpivot(
        list(BASE_COLUMNS), [quoted(m) for m in metrics], "metric_name", "value"
    )
    return long.withColumn("cluster", F.lit(cluster)).select(*METRIC_SCHEMA.names)


def normalise_metrics(long: DataFrame) -> DataFrame:
    """One spelling of missing: NULL.  Applies to values and partition columns."""
    return long.withColumns(
        {"value": as_missing(F.col("value")), "partition_col": blank_to_null(F.col("partition_col"))}
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate by column name, as a balanced tree so deep plans stay cheap to analyse."""
    level = list(frames)
    if not level:
        raise ValueError("nothing to union")
    while len(level) > 1:
        pairs = [level[i : i + 2] for i in range(0, len(level), 2)]
        level = [p[0].unionByName(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return level[0]
