"""Cases in which a wrong PASS or an old result would be easy to get."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymatch import TableSpec
from tallymatch.model import METRIC_SCHEMA
from tallymatch.operators import metric_frame, metrics_by_partition
from tallymatch.plans import (
    compare_stored,
    measure_to_tsv,
    reconcile_metrics,
    reconcile_partitions,
    run_all,
    run_new,
    store_metrics,
)
from tallymatch.session import shared_folder
from tallymatch.sources import read_metrics_tsv, read_slices, read_stats_csv
from tallymatch.sinks import export_metrics_tsv

from .inputs import CUSTOMER, ORDERS, table

DT = "2026-01-01"
LINES = TableSpec.of("sales.lineitem", (), {"l_quantity": "decimal(16,2)"})
EVENTS = TableSpec.of("web.events", ["ts"], {"value": "decimal(16,2)"})
SHOWN = ("table_name", "metric_name", "old_value", "new_value", "status")


def reconcile_missing_table(spark, sf):
    """Orders were not copied: their metrics are missing, not compared with themselves."""
    lines = table(spark, sf, "lineitem")
    old = {"sales.lineitem": lines, "sales.orders": table(spark, sf, "orders")}
    return reconcile_metrics(spark, [LINES, ORDERS], DT, old, {"sales.lineitem": lines}).select(*SHOWN)


def run_all_stored(spark, sf):
    """Text in, the new side measured in jobs of its own, both compared as stored."""
    folder = shared_folder(spark)
    frames = {s.name: table(spark, sf, s.name.split(".")[1]) for s in (LINES, ORDERS, CUSTOMER)}
    measure_to_tsv(spark, [LINES, ORDERS], DT, "old", f"{folder}/tsv", tables=frames)
    compared = run_all(
        spark, f"{folder}/tsv", [LINES, CUSTOMER], DT, f"{folder}/summary", tables=frames, overwrite=True
    )
    return compared.select(*SHOWN)


def run_new_overwrite_empty(spark, sf):
    """A run whose statements give no rows empties yesterday's slice: all is missing there."""
    folder = shared_folder(spark)
    frames = {"sales.lineitem": table(spark, sf, "lineitem")}
    target = f"{folder}/summary"
    for cluster in ("old", "new"):
        store_metrics(spark, [LINES], DT, cluster, target, tables=frames, overwrite=True)
    nothing = f"""SELECT 'sales.lineitem' AS table_name, '{DT}' AS data_dt, '' AS partition_col,
                         current_timestamp() AS computed_at, count(1) AS row_count
                  FROM parquet.`{sf}/lineitem.parquet` GROUP BY l_orderkey HAVING count(1) < 0"""
    run_new(spark, [nothing], DT, target, overwrite=True)
    return compare_stored(spark, target, DT).select(*SHOWN)


def metric_time_of_day(spark, sf):
    """Every date of a timestamp with times of day, read in three ways."""
    events = table(spark, sf, "events")
    together = metrics_by_partition(events, EVENTS)
    dates = ["2024-01-01", "2024-01-02"]
    listed = metrics_by_partition(events, EVENTS, dates=dates)
    picked = lambda df, how: df.select(
        F.lit(how).alias("how"), "data_dt", "row_count", F.col("value_sum").cast("string").alias("value_sum")
    )
    rows = picked(together, "all").union(picked(listed, "listed"))
    for day in dates:
        rows = rows.union(picked(metric_frame(events, EVENTS, day.replace("-", "")), "one").withColumn("data_dt", F.lit(day)))
    return rows


def reconcile_mixed_date_types(spark, sf):
    """Dates are text on the old side and dates on the new one."""
    orders = table(spark, sf, "orders")
    old = orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyyMMdd"))
    new = orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    spec = TableSpec.of("sales.orders", ["o_orderdate"], {"o_totalprice": "decimal(16,2)"})
    return reconcile_partitions(spark, [spec], {spec.name: old}, {spec.name: new}).select("data_dt", *SHOWN[1:])


def metric_sql_skip(spark, sf):
    """One statement fails on a cell while running; the two others are stored."""
    head = f"'{DT}' AS data_dt, '' AS partition_col, current_timestamp() AS computed_at"
    events = f"FROM parquet.`{sf}/events.parquet`"
    target = f"{shared_folder(spark)}/summary"
    skipped = run_new(
        spark,
        [
            f"SELECT 'web.events' AS table_name, {head}, count(1) AS row_count {events}",
            f"SELECT 'web.bad' AS table_name, {head}, sum(cast(props AS decimal(38,2))) AS props_sum {events}",
            f"SELECT 'web.users' AS table_name, {head}, count(DISTINCT user_id) AS users {events}",
        ],
        DT,
        target,
        on_error="skip",
        overwrite=True,
    )
    stored = read_slices(spark, target, METRIC_SCHEMA)
    return stored.select("table_name", "metric_name", "value", F.lit(",".join(sorted(skipped))).alias("skipped"))


def tsv_quoted(spark, sf):
    """Values with quotes survive an export and an import."""
    folder = shared_folder(spark)
    long = table(spark, sf, "events").select(
        F.lit("web.events").alias("table_name"),
        F.lit(DT).alias("data_dt"),
        F.lit("ts").alias("partition_col"),
        F.concat(F.lit("props_"), F.col("event_id")).alias("metric_name"),
        F.col("props").alias("value"),
        F.lit("old").alias("cluster"),
    )
    export_metrics_tsv(long, f"{folder}/tsv")
    return read_metrics_tsv(spark, f"{folder}/tsv").select("metric_name", "value")


def stats_csv_quoted(spark, sf):
    """Names with commas and quotes, in files whose headers stand in two orders."""
    folder = shared_folder(spark)
    text = F.translate("text", "\n\r", "\t\t")
    stats = table(spark, sf, "documents").select(
        F.concat(F.lit('"'), F.coalesce(text, F.lit(""))).alias("table_name"),
        F.col("lang").alias("database_name"),
        F.lit("MANAGED_TABLE").alias("table_type"),
        F.col("doc_id").cast("string").alias("partition_name"),
        F.col("n_chars").alias("num_rows"),
        F.lit(1).alias("num_files"),
        F.lit(DT).alias("data_dt"),
    )
    halves = [stats.where("partition_name % 2 = 0"), stats.where("partition_name % 2 = 1")]
    orders = [stats.columns, list(reversed(stats.columns))]
    for k, (half, columns) in enumerate(zip(halves, orders, strict=True)):
        half.select(*columns).write.option("header", True).option("escape", '"').csv(f"{folder}/{k}")
    back = read_stats_csv(spark, [f"{folder}/0", f"{folder}/1"])
    return back.select(F.sha2("table_name", 256).alias("name_sha256"), "partition_name", "num_rows", "num_files")


QUERIES = {
    f.__name__: f
    for f in (
        reconcile_missing_table,
        run_all_stored,
        run_new_overwrite_empty,
        metric_time_of_day,
        reconcile_mixed_date_types,
        metric_sql_skip,
        tsv_quoted,
        stats_csv_quoted,
    )
}


def _value(select: str) -> str:
    return f"CAST(({select}) AS VARCHAR)"


_LINES = {
    "row_count": _value("SELECT count(*) FROM lineitem"),
    "l_quantity_sum": _value("SELECT sum(CAST(l_quantity AS DECIMAL(16,2))) FROM lineitem"),
}
_ORDERS = {
    "row_count": _value("SELECT count(*) FROM orders"),
    "o_totalprice_sum": _value("SELECT sum(CAST(o_totalprice AS DECIMAL(16,2))) FROM orders"),
}
_CUSTOMER = {
    "row_count": _value("SELECT count(*) FROM customer"),
    "c_acctbal_sum": _value("SELECT sum(CAST(c_acctbal AS DECIMAL(16,2))) FROM customer"),
}


def _status(name: str, metrics: dict[str, str], old: bool, new: bool) -> str:
    """Rows of a table that is there on one side or on both."""
    none = "CAST(NULL AS VARCHAR)"
    status = "PASS" if old and new else "MISSING_NEW" if old else "MISSING_OLD"
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{m}' AS metric_name, {v if old else none} AS old_value, "
        f"{v if new else none} AS new_value, '{status}' AS status"
        for m, v in metrics.items()
    )


_DAY = "strftime(ts, '%Y-%m-%d')"
_EVENTS = (
    f"{_DAY} AS data_dt, count(*) AS row_count, CAST(sum(CAST(value AS DECIMAL(16,2))) AS VARCHAR) AS value_sum FROM events"
)

SQL = {
    "reconcile_missing_table": _status("sales.lineitem", _LINES, True, True)
    + "\nUNION ALL "
    + _status("sales.orders", _ORDERS, True, False),
    "run_all_stored": "\nUNION ALL ".join(
        [
            _status("sales.lineitem", _LINES, True, True),
            _status("sales.orders", _ORDERS, True, False),
            _status("sales.customer", _CUSTOMER, False, True),
        ]
    ),
    "run_new_overwrite_empty": _status("sales.lineitem", _LINES, True, False),
    "metric_time_of_day": f"""
        SELECT 'all' AS how, {_EVENTS} GROUP BY 2
        UNION ALL
        SELECT 'listed' AS how, {_EVENTS} WHERE {_DAY} IN ('2024-01-01', '2024-01-02') GROUP BY 2
        UNION ALL
        SELECT 'one' AS how, {_EVENTS} WHERE {_DAY} IN ('2024-01-01', '2024-01-02') GROUP BY 2""",
    "reconcile_mixed_date_types": """
        WITH d AS (
          SELECT strftime(o_orderdate, '%Y-%m-%d') AS data_dt, CAST(count(*) AS VARCHAR) AS n,
                 CAST(sum(CAST(o_totalprice AS DECIMAL(16,2))) AS VARCHAR) AS s
          FROM orders GROUP BY 1)
        SELECT data_dt, 'row_count' AS metric_name, n AS old_value, n AS new_value, 'PASS' AS status FROM d
        UNION ALL
        SELECT data_dt, 'o_totalprice_sum' AS metric_name, s AS old_value, s AS new_value, 'PASS' AS status FROM d""",
    "metric_sql_skip": """
        SELECT 'web.events' AS table_name, 'row_count' AS metric_name, CAST(count(*) AS VARCHAR) AS value,
               'statement 2' AS skipped FROM events
        UNION ALL
        SELECT 'web.users' AS table_name, 'users' AS metric_name, CAST(count(DISTINCT user_id) AS VARCHAR) AS value,
               'statement 2' AS skipped FROM events""",
    "tsv_quoted": "SELECT 'props_' || event_id AS metric_name, props AS value FROM events",
    "stats_csv_quoted": """
        SELECT sha256('"' || translate(coalesce(text, ''), chr(10) || chr(13), chr(9) || chr(9))) AS name_sha256,
               CAST(doc_id AS VARCHAR) AS partition_name, CAST(n_chars AS VARCHAR) AS num_rows, '1' AS num_files
        FROM documents""",
}
