"""Writers: date slices that can be replaced on re-run, and text exports.

A target with a slash is a path, any other a table made by ``create_tables``.
Slices are replaced by dynamic partition overwrite: new files are staged and the
partitions in the data are swapped when the job commits, so a failed or repeated
job leaves the old slice or the new one, and sibling slices are never touched.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import model as M
from .functions import escaped
from .operators.reshape import as_metric_rows, normalise_metrics
from .sources.tables import is_path

METRIC_SLICE = ("cluster", "data_dt")
COMPARISON_SLICE = ("data_dt",)

_SLICE_VALUE = re.compile(r"[0-9A-Za-z_-]+")


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Count rows while they pass, without a pass of their own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def rows_seen(seen: Observation) -> int:
    """Rows counted by a finished action; an input known to be empty reports nothing."""
    return seen.get.get("rows", 0)


def create_tables(
    spark: SparkSession,
    database: str,
    *,
    metrics_table: str = M.METRICS_TABLE,
    comparison_table: str = M.COMPARISON_TABLE,
) -> tuple[str, str]:
    """Create the database and both result tables if absent; returns their full names (K7).

    Dynamic partition overwrite is an option of the tables themselves, because
    inserting does not take it from the writer.
    """
    spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db)", args={"db": database})
    made = []
    for table, schema, by in (
        (metrics_table, M.METRIC_SCHEMA, METRIC_SLICE),
        (comparison_table, M.COMPARISON_TABLE_SCHEMA, COMPARISON_SLICE),
    ):
        full = f"{database}.{table}"
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:t) ({columns}) USING parquet "
            f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({', '.join(by)})",
            args={"t": full},
        )
        made.append(full)
    return made[0], made[1]


def _swaps_slices(spark: SparkSession, table: str) -> bool:
    """Whether overwriting this table replaces only the partitions in the data."""
    if spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic":
        return True
    facts = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:t)", args={"t": table})
    kept = facts.where(F.col("col_name").isin("Provider", "Storage Properties")).collect()
    described = {row.col_name: row.data_type for row in kept}
    return described.get("Provider") == "hive" or "partitionOverwriteMode=dynamic" in described.get(
        "Storage Properties", ""
    )


def write_slices(
    df: DataFrame, target: str, by: Sequence[str], *, overwrite: bool = False
) -> int:
    """Append rows, or replace exactly the slices the rows belong to.  Returns rows written.

    Rebalancing gathers the many tiny outputs of a union into few files and
    splits a slice that holds most of the rows over several tasks.
    """
    data = [c for c in df.columns if c not in by]
    rows, seen = counted(df.select(*data, *by).hint("rebalance", *by))
    if is_path(target):
        writer = rows.write.mode("overwrite" if overwrite else "append")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(target)
    else:
        spark = df.sparkSession
        if overwrite and not _swaps_slices(spark, target):
            raise ValueError(f"overwriting would empty all of {target}: see create_tables")
        rows.select(*spark.table(target).columns).write.insertInto(target, overwrite=overwrite)
    return rows_seen(seen)


def write_metrics(long: DataFrame, target: str, *, overwrite: bool = False) -> int:
    """Store long metrics with one spelling of missing."""
    return write_slices(
        normalise_metrics(as_metric_rows(long)), target, METRIC_SLICE, overwrite=overwrite
    )


def only_value(column: Column, value: str, what: str) -> Column:
    """The column itself, failing the job on a row of another value."""
    message = F.concat(F.lit(f"row of {what} {value} expected, found "), F.coalesce(column, F.lit("none")))
    return F.when(column == value, column).otherwise(F.raise_error(message))


def only_date(column: Column, data_dt: str) -> Column:
    """The column itself, failing the job on a row of another date."""
    return only_value(column, data_dt, "date")


def clear_slice(
    spark: SparkSession, target: str, schema: T.StructType, values: Mapping[str, str]
) -> None:
    """Empty one slice, given by the values of its columns, by overwriting it with no rows."""
    for value in values.values():
        if not _SLICE_VALUE.fullmatch(value):
            raise ValueError(f"not a plain slice value: {value!r}")
    data = [f for f in schema.fields if f.name not in values]
    nothing = spark.createDataFrame([], T.StructType(data))
    if is_path(target):
        place = "/".join(f"{name}={value}" for name, value in values.items())
        nothing.write.mode("overwrite").parquet(f"{target}/{place}")
    else:
        given = ", ".join(f"{name} = :{name}" for name in values)
        spark.sql(
            f"INSERT OVERWRITE TABLE IDENTIFIER(:t) PARTITION ({given}) SELECT * FROM {{nothing}}",
            args={"t": target, **values},
            nothing=nothing,
        )


def replace_comparison(
    comparison: DataFrame, target: str, data_dt: str, *, etl_tm: Column | None = None
) -> int:
    """Replace one date of the stored row-count comparison (K4).  Returns rows written.

    A row of another date fails the job before anything is replaced.  No rows
    at all empty the slice, as a delete followed by an empty insert would.
    """
    if not _SLICE_VALUE.fullmatch(data_dt):
        raise ValueError(f"not a plain date: {data_dt!r}")
    stamped = comparison.withColumns(
        {
            "etl_tm": (F.current_timestamp() if etl_tm is None else etl_tm).cast("timestamp"),
            "data_dt": only_date(F.col("data_dt"), data_dt),
        }
    )
    rows = stamped.select(*M.COMPARISON_TABLE_SCHEMA.fieldNames())
    written = write_slices(rows, target, COMPARISON_SLICE, overwrite=True)
    if written == 0:
        clear_slice(comparison.sparkSession, target, M.COMPARISON_TABLE_SCHEMA, {"data_dt": data_dt})
    return written


def export_metrics_tsv(long: DataFrame, path: str, *, any_text: bool = False) -> int:
    """Long metrics as TSV without header; NULL is written as the word (K3).

    With ``any_text`` line breaks, tabs, backslashes and the word NULL inside values are escaped
    by a backslash, so that every line is one row and each value comes back as it was.
    """
    rows, seen = counted(as_metric_rows(long))
    if any_text:
        times = {"computed_at": F.date_format("computed_at", M.COMPUTED_AT_FORMAT)}
        fields = [F.coalesce(escaped(times.get(c, F.col(c))), F.lit("NULL")) for c in M.METRIC_SCHEMA.fieldNames()]
        rows.select(F.concat_ws("\t", *fields).alias("value")).write.mode("overwrite").text(path)
        return rows_seen(seen)
    writer = rows.write.mode("overwrite").option("sep", "\t").option("header", False)
    writer = writer.option("nullValue", "NULL").option("timestampFormat", M.COMPUTED_AT_FORMAT)
    writer.option("escape", '"').csv(path)
    return rows_seen(seen)


def export_csv(df: DataFrame, path: str, columns: Sequence[str]) -> int:
    """CSV with header and fixed column order, in one pass.

    Without rows an earlier export at that place is gone too: what is left has no rows.
    """
    rows, seen = counted(df.select(*columns))
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return rows_seen(seen)


def export_comparison_csv(comparison: DataFrame, path: str) -> int:
    """Row-count comparison as CSV (K5)."""
    return export_csv(comparison, path, M.ROW_COUNT_COMPARISON_SCHEMA.fieldNames())


def export_stats_csv(stats: DataFrame, path: str) -> int:
    """Statistics as CSV, columns selected by name so header and content agree (K6)."""
    return export_csv(stats, path, M.STATS_SCHEMA.fieldNames())
