"""User-written metric SQL: base columns plus any metrics, one result per statement."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..operators.reshape import unpivot_metrics

# Fixed value: the date placeholder of existing metric statements.
DATE_PLACEHOLDER = "{{data_dt}}"

_PLAIN_DATE = re.compile(r"[0-9A-Za-z_-]+")


def bind_date(statement: str, data_dt: str) -> str:
    """Turn a quoted placeholder into the ``:data_dt`` parameter marker.

    A placeholder inside a longer literal cannot be a marker; there the date is
    put in as text, and only if it is a plain word.
    """
    bound = statement.replace(f"'{DATE_PLACEHOLDER}'", ":data_dt")
    if DATE_PLACEHOLDER in bound:
        if not _PLAIN_DATE.fullmatch(data_dt):
            raise ValueError(f"not a plain date: {data_dt!r}")
        bound = bound.replace(DATE_PLACEHOLDER, data_dt)
    return bound


def metric_sql_frame(
    spark: SparkSession, statement: str, data_dt: str, cluster: str
) -> DataFrame:
    """Long metrics of one statement.

    Columns named like a base column are kept as such; all others are metrics.
    """
    return unpivot_metrics(
        spark.sql(bind_date(statement, data_dt), args={"data_dt": data_dt}), cluster
    )
