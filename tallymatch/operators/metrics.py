"""Row count and exact decimal sums of one table, in a single scan."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dashed_date, dashed_date_text, name_col
from ..model import ROW_COUNT, Field, TableSpec


def spec_from_frame(df: DataFrame, name: str, partition_cols: Iterable[str] = ()) -> TableSpec:
    """Spec that sums every DECIMAL column of a frame (P4, driven by the schema)."""
    parts = tuple(partition_cols)
    fields = tuple(
        Field(f.name, f.dataType.simpleString())
        for f in df.schema.fields
        if isinstance(f.dataType, T.DecimalType) and f.name not in parts
    )
    return TableSpec(name, parts, fields)


def metric_columns(spec: TableSpec, cast_override: str | None = None) -> list[Column]:
    """``row_count`` and one ``<field>_sum`` per decimal field.

    ``try_cast`` and ``try_sum`` give NULL for bad text and for overflow, as a
    warehouse without ANSI mode does, instead of failing the job.
    """
    sums = [
        F.try_sum(name_col(f.name).try_cast(cast_override or f.type)).alias(f.metric)
        for f in spec.summed
    ]
    return [F.count(F.lit(1)).alias(ROW_COUNT), *sums] if spec.count_rows else sums


def _type_of(df: DataFrame, column: str) -> T.DataType:
    """Type of a column, found the way Spark resolves its name."""
    return df.select(name_col(column)).schema[0].dataType


def _day(data_dt: str) -> date:
    """A date as ``yyyy-MM-dd`` or ``yyyyMMdd``."""
    try:
        return date.fromisoformat(dashed_date_text(data_dt))
    except ValueError:
        raise ValueError(f"{data_dt!r} is no date, but the partition column holds dates") from None


def on_dates(df: DataFrame, partition_col: str, dates: Iterable[str]) -> Column:
    """Whether a row belongs to one of the dates (P5).

    The literals take the column's type, never the column the literals', so the
    predicate prunes partitions or reaches the file scan.  A time of day does
    not matter.  A date that does not fit the type raises: it would select
    nothing on either side, and nothing equals nothing.
    """
    part, kind = name_col(partition_col), _type_of(df, partition_col)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        days = [_day(d) for d in dates]
        within = [
            (part >= F.lit(day).cast(kind)) & (part < F.lit(day + timedelta(days=1)).cast(kind)) for day in days
        ]
        return reduce(Column.__or__, within, F.lit(False))
    if isinstance(kind, T.DateType):
        wanted = [F.lit(_day(d)) for d in dates]
    elif isinstance(kind, T.IntegralType):
        wanted = [F.lit(int(d)).cast(kind) for d in dates]
    else:
        wanted = [F.lit(d).try_cast(kind) for d in dates]
    return part == wanted[0] if len(wanted) == 1 else part.isin(wanted)


def on_date(df: DataFrame, partition_col: str, data_dt: str) -> DataFrame:
    """Rows of one date."""
    return df.where(on_dates(df, partition_col, [data_dt]))


def _stamp(computed_at: datetime | Column | None) -> Column:
    if computed_at is None:
        return F.current_timestamp()
    at = computed_at if isinstance(computed_at, Column) else F.lit(computed_at)
    return at.cast("timestamp")


def metric_frame(
    df: DataFrame,
    spec: TableSpec,
    data_dt: str,
    *,
    computed_at: datetime | Column | None = None,
    cast_override: str | None = None,
) -> DataFrame:
    """Wide metric row of one table for one date: always one row, also on no input (A3).

    A global aggregate: each task sends one partial row, whatever it read.
    """
    rows = on_date(df, spec.partition_col, data_dt) if spec.partition_cols else df
    metrics = metric_columns(spec, cast_override)
    return rows.agg(*metrics).select(
        F.lit(spec.name).alias("table_name"),
        F.lit(data_dt).alias("data_dt"),
        F.lit(spec.partition_col).alias("partition_col"),
        _stamp(computed_at).alias("computed_at"),
        "*",
    )


def partition_kind(df: DataFrame, spec: TableSpec) -> T.DataType:
    """Type a date of this table is grouped by: time of day does not count."""
    kind = _type_of(df, spec.partition_col)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return T.DateType()
    return kind


def partition_totals(
    df: DataFrame,
    spec: TableSpec,
    *,
    kind: T.DataType,
    dates: Iterable[str] | None = None,
    cast_override: str | None = None,
) -> DataFrame:
    """``data_dt`` and the metrics of every date of one table, from a single scan.

    A date holding a third of the table is no hot spot: partial aggregation
    leaves one row per task and date before the shuffle.
    """
    part = name_col(spec.partition_col)
    own = partition_kind(df, spec)
    as_date = isinstance(own, T.StringType) and isinstance(kind, T.DateType)
    if dates is not None:
        days = [dashed_date_text(d) for d in dates] if as_date else dates
        spelled = [*days, *(d.replace("-", "") for d in days)] if as_date else days
        df = df.where(on_dates(df, spec.partition_col, spelled))
    if as_date:
        day = F.coalesce(part.try_cast(kind), dashed_date(part).try_cast(kind))
    else:
        day = part.cast(own).cast(kind)
    return df.groupBy(day.alias("data_dt")).agg(*metric_columns(spec, cast_override))


def metrics_by_partition(
    df: DataFrame,
    spec: TableSpec,
    *,
    dates: Iterable[str] | None = None,
    computed_at: datetime | Column | None = None,
    cast_override: str | None = None,
) -> DataFrame:
    """Wide metric rows of all dates of one table from a single scan.

    Same rows as one ``metric_frame`` per existing date, without reading the
    table once per date.
    """
    totals = partition_totals(
        df, spec, kind=partition_kind(df, spec), dates=dates, cast_override=cast_override
    )
    return totals.select(
        F.lit(spec.name).alias("table_name"),
        F.col("data_dt").cast("string").alias("data_dt"),
        F.lit(spec.partition_col).alias("partition_col"),
        _stamp(computed_at).alias("computed_at"),
        *[name_col(m) for m in spec.metrics],
    )
