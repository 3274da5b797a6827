"""Sources and sinks: written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymatch import model as M
from tallymatch.operators import as_metric_rows, compare_row_counts
from tallymatch.plans import compare_stats_files, ingest_old, publish_comparison
from tallymatch.session import shared_folder
from tallymatch.sinks import (
    export_comparison_csv,
    export_metrics_tsv,
    export_stats_csv,
    replace_comparison,
    write_metrics,
)
from tallymatch.sources import read_metrics_tsv, read_slices, read_stats_csv, read_strict_tsv

from .inputs import AT_TEXT, GROUP_STATS_SQL, group_stats, new_lineitem, table


def _order_metrics(spark, sf):
    """One metric per order, filed under its day, with every spelling of a value."""
    value = (
        F.when(F.col("o_orderstatus") == "F", "")
        .when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
        .otherwise(F.col("o_orderkey").cast("string"))
    )
    return as_metric_rows(
        table(spark, sf, "orders").select(
            F.lit("old").alias("cluster"),
            F.concat(F.lit("o_"), F.col("o_orderkey").cast("string")).alias("table_name"),
            F.lit("o_orderdate").alias("partition_col"),
            F.col("o_orderpriority").alias("metric_name"),
            value.alias("value"),
            F.lit(AT_TEXT).cast("timestamp").alias("computed_at"),
            F.year("o_orderdate").cast("string").alias("data_dt"),
        )
    )


def _customer_counts(spark, sf, data_dt, key="o_custkey"):
    counts = table(spark, sf, "orders").groupBy(F.col(key).cast("string").alias("table_name")).agg(
        F.count(F.lit(1)).alias("num_rows")
    )
    side = counts.select(
        F.lit("sales").alias("database_name"),
        "table_name",
        F.lit("").alias("partition_name"),
        "num_rows",
        F.lit(data_dt).alias("data_dt"),
    )
    return compare_row_counts(side, side)


def sink_overwrite_slice(spark, sf):
    """Replace the 1998 slice by changed rows; the other years must survive."""
    folder = f"{shared_folder(spark)}/metrics"
    rows = _order_metrics(spark, sf)
    write_metrics(rows, folder)
    changed = rows.where(F.col("data_dt") == "1998").withColumn("value", F.lit("1998"))
    write_metrics(changed, folder, overwrite=True)
    stored = read_slices(spark, folder, M.METRIC_SCHEMA)
    return stored.select("cluster", "table_name", "metric_name", "value", "data_dt")


def sink_append(spark, sf):
    """Two appends of the same rows are both kept."""
    folder = f"{shared_folder(spark)}/metrics"
    rows = _order_metrics(spark, sf)
    write_metrics(rows, folder)
    write_metrics(rows, folder)
    return read_slices(spark, folder, M.METRIC_SCHEMA).groupBy("data_dt", "metric_name").agg(
        F.count(F.lit(1)).alias("n")
    )


def sink_replace_slice(spark, sf):
    """Publish two dates, then one of them again: repeatable, and the other survives."""
    folder = f"{shared_folder(spark)}/comparison"
    stamp = F.lit(AT_TEXT).cast("timestamp")
    replace_comparison(_customer_counts(spark, sf, "2026-01-01"), folder, "2026-01-01", etl_tm=stamp)
    replace_comparison(_customer_counts(spark, sf, "2026-01-02"), folder, "2026-01-02", etl_tm=stamp)
    publish_comparison(
        _customer_counts(spark, sf, "2026-01-02", key="o_orderstatus"), folder, "2026-01-02", etl_tm=stamp
    )
    stored = read_slices(spark, folder, M.COMPARISON_TABLE_SCHEMA)
    return stored.withColumn("etl_tm", F.col("etl_tm").cast("string"))


def tsv_roundtrip(spark, sf):
    path = f"{shared_folder(spark)}/metrics_tsv"
    export_metrics_tsv(_order_metrics(spark, sf), path)
    back = read_metrics_tsv(spark, path)
    return back.withColumn("computed_at", F.col("computed_at").cast("string"))


def tsv_ingest(spark, sf):
    folder = shared_folder(spark)
    export_metrics_tsv(_order_metrics(spark, sf), f"{folder}/tsv")
    ingest_old(spark, f"{folder}/tsv", f"{folder}/metrics")
    return read_slices(spark, f"{folder}/metrics", M.METRIC_SCHEMA).select(
        "table_name", "metric_name", "value", "data_dt"
    )


def ragged_drop(spark, sf):
    """Failed orders miss a field and pending ones have one too many; only whole lines count."""
    path = f"{shared_folder(spark)}/ragged"
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    line = (
        F.when(status == "F", F.concat_ws("\t", key, status))
        .when(status == "P", F.concat_ws("\t", key, status, F.col("o_orderpriority"), key))
        .otherwise(F.concat_ws("\t", key, status, F.col("o_orderpriority")))
    )
    table(spark, sf, "orders").select(line.alias("value")).write.text(path)
    rows = read_strict_tsv(spark, path, ["order_key", "status", "priority"])
    return rows.select("order_key", "priority")


def csv_export(spark, sf):
    path = f"{shared_folder(spark)}/comparison_csv"
    export_comparison_csv(_customer_counts(spark, sf, "2026-01-01"), path)
    return spark.read.schema(M.ROW_COUNT_COMPARISON_SCHEMA).option("header", True).csv(path)


def stats_csv_roundtrip(spark, sf):
    path = f"{shared_folder(spark)}/stats_csv"
    stats = group_stats(table(spark, sf, "lineitem")).withColumns(
        {"table_type": F.lit("MANAGED_TABLE"), "last_access_time": F.lit(0)}
    )
    export_stats_csv(stats, path)
    return read_stats_csv(spark, path)


def stats_csv_compare(spark, sf):
    """Both sides exported as files, read back and compared."""
    folder = shared_folder(spark)
    old = table(spark, sf, "lineitem")
    for side, rows in (("old", old), ("new", new_lineitem(old))):
        stats = group_stats(rows).withColumns(
            {"table_type": F.lit("MANAGED_TABLE"), "last_access_time": F.lit(0)}
        )
        export_stats_csv(stats, f"{folder}/{side}")
    return compare_stats_files(spark, f"{folder}/old", f"{folder}/new")


QUERIES = {
    f.__name__: f
    for f in (
        sink_overwrite_slice,
        sink_append,
        sink_replace_slice,
        tsv_roundtrip,
        tsv_ingest,
        ragged_drop,
        csv_export,
        stats_csv_roundtrip,
        stats_csv_compare,
    )
}

_COMPARISON = """
SELECT 'sales' AS database_name, CAST({key} AS VARCHAR) AS table_name,
       CAST(NULL AS VARCHAR) AS partition_name, 'num_rows' AS metric_name,
       count(*) AS old_value, count(*) AS new_value, CAST(0 AS BIGINT) AS diff_value,
       '{date}' AS data_dt {extra}
FROM orders GROUP BY {key}"""

_STAMP = f", '{AT_TEXT}' AS etl_tm"

SQL = {
    "sink_overwrite_slice": """
SELECT 'old' AS cluster, 'o_' || o_orderkey AS table_name, o_orderpriority AS metric_name,
       CASE WHEN year(o_orderdate) = 1998 THEN '1998'
            WHEN o_orderstatus = 'O' THEN CAST(o_orderkey AS VARCHAR) END AS value,
       CAST(year(o_orderdate) AS VARCHAR) AS data_dt
FROM orders""",
    "sink_append": """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS data_dt, o_orderpriority AS metric_name, 2 * count(*) AS n
FROM orders GROUP BY 1, 2""",
    "sink_replace_slice": _COMPARISON.format(key="o_custkey", date="2026-01-01", extra=_STAMP)
    + "\nUNION ALL "
    + _COMPARISON.format(key="o_orderstatus", date="2026-01-02", extra=_STAMP),
    "tsv_roundtrip": f"""
SELECT 'old' AS cluster, 'o_' || o_orderkey AS table_name, 'o_orderdate' AS partition_col,
       o_orderpriority AS metric_name,
       CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN CAST(o_orderkey AS VARCHAR) END AS value,
       '{AT_TEXT}' AS computed_at, CAST(year(o_orderdate) AS VARCHAR) AS data_dt
FROM orders""",
    "tsv_ingest": """
SELECT 'o_' || o_orderkey AS table_name, o_orderpriority AS metric_name,
       CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderkey AS VARCHAR) END AS value,
       CAST(year(o_orderdate) AS VARCHAR) AS data_dt
FROM orders""",
    "ragged_drop": """
SELECT CAST(o_orderkey AS VARCHAR) AS order_key, o_orderpriority AS priority
FROM orders WHERE o_orderstatus = 'O'""",
    "csv_export": _COMPARISON.format(key="o_custkey", date="2026-01-01", extra=""),
    "stats_csv_roundtrip": f"""
WITH {GROUP_STATS_SQL}
SELECT db AS database_name, tbl AS table_name, 'MANAGED_TABLE' AS table_type, part AS partition_name,
       CAST(num_rows AS VARCHAR) AS num_rows, CAST(total_size AS VARCHAR) AS total_size,
       CAST(num_files AS VARCHAR) AS num_files, CAST(raw_data_size AS VARCHAR) AS raw_data_size,
       '0' AS last_access_time, '2026-01-01' AS data_dt
FROM old_stats""",
    "stats_csv_compare": f"""
WITH {GROUP_STATS_SQL}
SELECT coalesce(o.db, n.db) AS database_name, coalesce(o.tbl, n.tbl) AS table_name,
       coalesce(o.part, n.part) AS partition_name, 'num_rows' AS metric_name,
       o.num_rows AS old_value, n.num_rows AS new_value,
       coalesce(n.num_rows, 0) - coalesce(o.num_rows, 0) AS diff_value, '2026-01-01' AS data_dt
FROM old_stats o FULL OUTER JOIN new_stats n ON o.db = n.db AND o.tbl = n.tbl AND o.part = n.part""",
}
