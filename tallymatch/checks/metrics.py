"""Metrics of tables: one date, all dates, whole tables, user SQL, long form."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymatch import TableSpec
from tallymatch.functions import as_missing, dashed_date
from tallymatch.operators import (
    latest_run,
    metric_frame,
    metrics_by_partition,
    spec_from_frame,
    union_all,
    unpivot_metrics,
)
from tallymatch.plans import collect_metrics, collect_metrics_by_partition, collect_metrics_sql

from .inputs import AT, AT_TEXT, CUSTOMER, LINEITEM, MONEY, ORDERS, metric_groups, new_lineitem, table

DAY = "1998-03-15"
SUMS = ("l_quantity_sum", "l_extendedprice_sum", "l_tax_sum")


def _whole(spec: TableSpec) -> TableSpec:
    return TableSpec(spec.name, (), spec.fields)


def _text(df, *columns):
    """Sums as text: exact in every client."""
    return [F.col(c).cast("string").alias(c) for c in columns]


def metric_row_count(spark, sf):
    wide = metric_frame(table(spark, sf, "lineitem"), TableSpec.of("sales.lineitem"), DAY)
    return wide.select("table_name", "row_count")


def metric_decimal_sum(spark, sf):
    spec = TableSpec.of("sales.lineitem", (), {"l_extendedprice": MONEY})
    wide = metric_frame(table(spark, sf, "lineitem"), spec, DAY)
    return wide.select(*_text(wide, "l_extendedprice_sum"))


def metric_multi(spark, sf):
    wide = metric_frame(table(spark, sf, "lineitem"), _whole(LINEITEM), DAY)
    return wide.select("row_count", *_text(wide, *SUMS))


def metric_cast_override(spark, sf):
    spec = TableSpec.of("sales.orders", (), ["o_totalprice"])
    df = table(spark, sf, "orders")
    declared = metric_frame(df, spec, DAY)
    narrowed = metric_frame(df, spec, DAY, cast_override="decimal(16,0)")
    return union_all(
        [
            declared.select(F.lit("decimal(38,2)").alias("width"), *_text(declared, "o_totalprice_sum")),
            narrowed.select(F.lit("decimal(16,0)").alias("width"), *_text(narrowed, "o_totalprice_sum")),
        ]
    )


def metric_one_partition(spark, sf):
    wide = metric_frame(table(spark, sf, "lineitem"), LINEITEM, DAY)
    return wide.select(
        "table_name", "data_dt", "partition_col", "row_count", *_text(wide, *SUMS)
    )


def metric_unpartitioned(spark, sf):
    wide = metric_frame(table(spark, sf, "orders"), ORDERS, DAY)
    return wide.select("table_name", "partition_col", "row_count", *_text(wide, "o_totalprice_sum"))


def metric_empty_partition(spark, sf):
    wide = metric_frame(table(spark, sf, "lineitem"), LINEITEM, "1900-01-01", computed_at=AT)
    return unpivot_metrics(wide, "old").drop("computed_at")


def metric_field_selection(spark, sf):
    wide = metric_frame(table(spark, sf, "customer"), CUSTOMER, DAY)
    return wide.select("row_count", *[c for c in _text(wide, *wide.columns[5:])])


def metric_schema_fields(spark, sf):
    df = table(spark, sf, "part").withColumn("p_retailprice", F.col("p_retailprice").cast(MONEY))
    wide = metric_frame(df, spec_from_frame(df, "sales.part"), DAY)
    return wide.select("row_count", *_text(wide, "p_retailprice_sum"))


def metric_tagged_wide(spark, sf):
    wide = metric_frame(table(spark, sf, "orders"), ORDERS, DAY, computed_at=AT)
    return wide.select(
        "table_name",
        "data_dt",
        "partition_col",
        F.col("computed_at").cast("string").alias("computed_at"),
        "row_count",
        *_text(wide, "o_totalprice_sum"),
    )


def metric_by_partition(spark, sf):
    wide = metrics_by_partition(table(spark, sf, "lineitem"), LINEITEM)
    return wide.select("data_dt", "partition_col", "row_count", *_text(wide, *SUMS))


def metric_sql_params(spark, sf):
    orders = f"parquet.`{sf}/orders.parquet`"
    statements = [
        f"""SELECT 'sales.orders' AS table_name, '{{{{data_dt}}}}' AS data_dt,
                   'o_orderdate' AS partition_col, current_timestamp() AS computed_at,
                   count(1) AS row_count, sum(cast(o_totalprice AS decimal(16,2))) AS o_totalprice_sum
            FROM {orders} WHERE o_orderdate = '{{{{data_dt}}}}'""",
        f"""SELECT 'sales.orders.all' AS table_name, :data_dt AS data_dt, '' AS partition_col,
                   count(1) AS row_count
            FROM {orders}""",
    ]
    run = collect_metrics_sql(spark, statements, DAY, "new")
    return run.metrics.drop("computed_at")


def metric_unpivot(spark, sf):
    wide = metric_frame(table(spark, sf, "lineitem"), _whole(LINEITEM), DAY, computed_at=AT)
    return unpivot_metrics(wide, "old").withColumn("computed_at", F.col("computed_at").cast("string"))


def metric_union_tables(spark, sf):
    specs = [_whole(LINEITEM), ORDERS, CUSTOMER]
    frames = {s.name: table(spark, sf, s.name.split(".")[1]) for s in specs}
    return collect_metrics(spark, specs, DAY, "old", tables=frames).metrics.drop("computed_at")


def metric_union_partitions(spark, sf):
    orders = TableSpec("sales.orders", ("o_orderdate",), ORDERS.fields)
    frames = {"sales.lineitem": table(spark, sf, "lineitem"), "sales.orders": table(spark, sf, "orders")}
    run = collect_metrics_by_partition(spark, [LINEITEM, orders], "new", tables=frames)
    return run.metrics.drop("computed_at")


def null_normalise(spark, sf):
    spelled = (
        F.when(F.col("event_type") == "click", "")
        .when(F.col("event_type") == "view", "NULL")
        .when(F.col("event_type") == "error", "null")
        .when(F.col("event_type") == "signup", F.lit(None).cast("string"))
        .otherwise(F.get_json_object("props", "$.k"))
    )
    return table(spark, sf, "events").select("event_id", as_missing(spelled).alias("value"))


def date_normalise(spark, sf):
    day = F.col("o_orderdate").cast("date").cast("string")
    spelled = (
        F.when(F.col("o_orderstatus") == "F", F.replace(day, F.lit("-"), F.lit("")))
        .when(F.col("o_orderstatus") == "O", day)
        .otherwise(F.substring(day, 1, 7))
    )
    return table(spark, sf, "orders").select("o_orderkey", dashed_date(spelled).alias("data_dt"))


def _runs(spark, sf):
    """Three runs over line items: the old side, the new side, the new side once more."""
    old = table(spark, sf, "lineitem")
    new = new_lineitem(old)
    again = metric_groups(new, "new").withColumn(
        "computed_at", F.col("computed_at") + F.expr("INTERVAL 1 HOUR")
    )
    stale = metric_groups(old, "new")
    return union_all([metric_groups(old, "old"), stale, again])


def metric_snapshot_union(spark, sf):
    rows = _runs(spark, sf).where((F.col("cluster") == "old") & (F.col("data_dt") == "2026-01-01"))
    return rows.select("cluster", "table_name", "metric_name", "value")


def metric_latest_run(spark, sf):
    latest = latest_run(_runs(spark, sf))
    return latest.select(
        "cluster",
        "table_name",
        "metric_name",
        "value",
        F.col("computed_at").cast("string").alias("computed_at"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        metric_row_count,
        metric_decimal_sum,
        metric_multi,
        metric_cast_override,
        metric_one_partition,
        metric_unpartitioned,
        metric_empty_partition,
        metric_field_selection,
        metric_schema_fields,
        metric_tagged_wide,
        metric_by_partition,
        metric_sql_params,
        metric_unpivot,
        metric_union_tables,
        metric_union_partitions,
        null_normalise,
        date_normalise,
        metric_snapshot_union,
        metric_latest_run,
    )
}


def _sum(column: str, kind: str = "DECIMAL(16,2)") -> str:
    return f"CAST(sum(CAST({column} AS {kind})) AS VARCHAR)"


_LINE_SUMS = (
    f"{_sum('l_quantity')} AS l_quantity_sum, {_sum('l_extendedprice')} AS l_extendedprice_sum, "
    f"{_sum('l_tax')} AS l_tax_sum"
)


def _long(cluster, name, part, date, source, fields, where="", group=""):
    """Long metrics of one table as SQL, one branch per metric."""
    metrics = [("row_count", "CAST(count(*) AS VARCHAR)")] + [(f"{f}_sum", _sum(f)) for f in fields]
    return "\nUNION ALL ".join(
        f"SELECT '{cluster}' AS cluster, '{name}' AS table_name, '{part}' AS partition_col, "
        f"'{m}' AS metric_name, {value} AS value, {date} AS data_dt FROM {source} {where} {group}"
        for m, value in metrics
    )


def _by_day(column: str) -> str:
    return f"CAST(CAST({column} AS DATE) AS VARCHAR)"


def _group_long(cluster: str, at: str, source: str) -> str:
    group = "l_returnflag || '/' || l_linestatus"
    parts = [
        ("row_count", "CAST(count(*) AS VARCHAR)"),
        ("l_quantity_sum", _sum("l_quantity")),
        ("l_extendedprice_sum", _sum("l_extendedprice")),
    ]
    return "\nUNION ALL ".join(
        f"SELECT '{cluster}' AS cluster, {group} AS table_name, '{m}' AS metric_name, "
        f"{value} AS value, '{at}' AS computed_at FROM {source} GROUP BY {group}"
        for m, value in parts
    )


_NEW = """(SELECT * REPLACE (
    CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'H' ELSE l_linestatus END AS l_linestatus,
    l_extendedprice + CASE WHEN l_returnflag = 'R' AND l_discount = 0.1::DOUBLE
                           THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS l_extendedprice)
  FROM lineitem WHERE NOT (l_linestatus = 'F' AND l_quantity = 50))"""

_RUNS = "\nUNION ALL ".join(
    [
        _group_long("old", "2026-01-02 03:04:05", "lineitem"),
        _group_long("new", "2026-01-02 03:04:05", "lineitem"),
        _group_long("new", "2026-01-02 04:04:05", _NEW),
    ]
)

SQL = {
    "metric_row_count": "SELECT 'sales.lineitem' AS table_name, count(*) AS row_count FROM lineitem",
    "metric_decimal_sum": f"SELECT {_sum('l_extendedprice')} AS l_extendedprice_sum FROM lineitem",
    "metric_multi": f"SELECT count(*) AS row_count, {_LINE_SUMS} FROM lineitem",
    "metric_cast_override": f"""
        SELECT 'decimal(38,2)' AS width, {_sum('o_totalprice', 'DECIMAL(38,2)')} AS o_totalprice_sum
        FROM orders
        UNION ALL
        SELECT 'decimal(16,0)', {_sum('o_totalprice', 'DECIMAL(16,0)')} FROM orders""",
    "metric_one_partition": f"""
        SELECT 'sales.lineitem' AS table_name, '{DAY}' AS data_dt, 'l_shipdate' AS partition_col,
               count(*) AS row_count, {_LINE_SUMS}
        FROM lineitem WHERE l_shipdate = TIMESTAMP '{DAY}'""",
    "metric_unpartitioned": f"""
        SELECT 'sales.orders' AS table_name, '' AS partition_col, count(*) AS row_count,
               {_sum('o_totalprice')} AS o_totalprice_sum
        FROM orders""",
    "metric_empty_partition": _long(
        "old", "sales.lineitem", "l_shipdate", "'1900-01-01'", "lineitem",
        ("l_quantity", "l_extendedprice", "l_tax"), "WHERE l_shipdate = TIMESTAMP '1900-01-01'",
    ),
    "metric_field_selection": f"""
        SELECT count(*) AS row_count, {_sum('c_acctbal')} AS c_acctbal_sum FROM customer""",
    "metric_schema_fields": f"""
        SELECT count(*) AS row_count, {_sum('p_retailprice')} AS p_retailprice_sum FROM part""",
    "metric_tagged_wide": f"""
        SELECT 'sales.orders' AS table_name, '{DAY}' AS data_dt, '' AS partition_col,
               '{AT_TEXT}' AS computed_at, count(*) AS row_count,
               {_sum('o_totalprice')} AS o_totalprice_sum
        FROM orders""",
    "metric_by_partition": f"""
        SELECT {_by_day('l_shipdate')} AS data_dt, 'l_shipdate' AS partition_col,
               count(*) AS row_count, {_LINE_SUMS}
        FROM lineitem GROUP BY 1""",
    "metric_sql_params": _long(
        "new", "sales.orders", "o_orderdate", f"'{DAY}'", "orders", ("o_totalprice",),
        f"WHERE o_orderdate = TIMESTAMP '{DAY}'",
    )
    + "\nUNION ALL "
    + _long("new", "sales.orders.all", "", f"'{DAY}'", "orders", ()),
    "metric_unpivot": f"""
        SELECT *, '{AT_TEXT}' AS computed_at FROM ({_long(
            "old", "sales.lineitem", "", f"'{DAY}'", "lineitem",
            ("l_quantity", "l_extendedprice", "l_tax"))})""",
    "metric_union_tables": "\nUNION ALL ".join(
        [
            _long("old", "sales.lineitem", "", f"'{DAY}'", "lineitem",
                  ("l_quantity", "l_extendedprice", "l_tax")),
            _long("old", "sales.orders", "", f"'{DAY}'", "orders", ("o_totalprice",)),
            _long("old", "sales.customer", "", f"'{DAY}'", "customer", ("c_acctbal",)),
        ]
    ),
    "metric_union_partitions": "\nUNION ALL ".join(
        [
            _long("new", "sales.lineitem", "l_shipdate", _by_day("l_shipdate"), "lineitem",
                  ("l_quantity", "l_extendedprice", "l_tax"), group=f"GROUP BY {_by_day('l_shipdate')}"),
            _long("new", "sales.orders", "o_orderdate", _by_day("o_orderdate"), "orders",
                  ("o_totalprice",), group=f"GROUP BY {_by_day('o_orderdate')}"),
        ]
    ),
    "null_normalise": """
        SELECT event_id, CASE WHEN event_type = 'purchase' THEN props ->> '$.k' END AS value
        FROM events""",
    "date_normalise": """
        SELECT o_orderkey,
               CASE WHEN o_orderstatus IN ('F', 'O') THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
                    ELSE substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 7) END AS data_dt
        FROM orders""",
    "metric_snapshot_union": f"""
        SELECT cluster, table_name, metric_name, value FROM ({_RUNS}) WHERE cluster = 'old'""",
    "metric_latest_run": f"""
        SELECT cluster, table_name, metric_name, value, computed_at FROM (
          SELECT *, row_number() OVER (PARTITION BY cluster, table_name, metric_name
                                       ORDER BY computed_at DESC, value DESC) AS rn
          FROM ({_RUNS}))
        WHERE rn = 1""",
}
