"""Comparisons of long metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymatch import TableSpec
from tallymatch.functions import ORIGINAL
from tallymatch.operators import compare_metric_slices, compare_metrics, unpivot_metrics
from tallymatch.plans import (
    collect_metrics,
    compare_stored,
    reconcile_metrics,
    reconcile_partitions,
)
from tallymatch.session import shared_folder
from tallymatch.sinks import write_metrics

from .inputs import (
    AT,
    CUSTOMER,
    LINEITEM,
    METRIC_PAIRS_SQL,
    MONEY,
    NEW_LINEITEM_SQL,
    ORDERS,
    metric_groups,
    new_lineitem,
    status_sql,
    table,
)

DT = "2026-01-01"


def _sides(spark, sf):
    old = table(spark, sf, "lineitem")
    return metric_groups(old, "old"), metric_groups(new_lineitem(old), "new")


def compare_metrics_status(spark, sf):
    compared = compare_metrics(*_sides(spark, sf))
    return compared.select("table_name", "metric_name", "old_value", "new_value", "status")


def compare_metrics_diff(spark, sf):
    compared = compare_metrics(*_sides(spark, sf))
    return compared.select("table_name", "partition_col", "metric_name", "data_dt", "diff_num")


def compare_metrics_reason(spark, sf):
    compared = compare_metrics(*_sides(spark, sf))
    original = compare_metrics(*_sides(spark, sf), wording=ORIGINAL)
    keys = ["table_name", "metric_name"]
    return compared.select(*keys, "reason").join(
        original.select(*keys, F.col("reason").alias("original_reason")), keys
    )


def compare_metrics_slices(spark, sf):
    """Both clusters in one frame, with a date that must not take part."""
    old, new = _sides(spark, sf)
    other = new.withColumn("data_dt", F.lit("2025-12-31")).withColumn("value", F.lit("0"))
    summary = old.unionByName(new).unionByName(other)
    compared = compare_metric_slices(summary, DT)
    return compared.select("table_name", "metric_name", "data_dt", "status")


def compare_metrics_stored(spark, sf):
    """Store both sides and an outdated run of the new one, then compare what is stored."""
    folder = f"{shared_folder(spark)}/metrics"
    old, new = _sides(spark, sf)
    earlier = F.col("computed_at") - F.expr("INTERVAL 1 DAY")
    stale = new.withColumns({"value": F.lit("0"), "computed_at": earlier})
    write_metrics(old.unionByName(new), folder)
    write_metrics(stale, folder)
    return compare_stored(spark, folder, DT).select(
        "table_name", "metric_name", "old_value", "new_value", "status"
    )


def compare_metrics_exact(spark, sf):
    """Sums scaled past 2^53 that differ in the last digit."""
    scaled = []
    for cluster, last in (("old", "1"), ("new", "2")):
        sums = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
            F.sum(F.col("l_extendedprice").cast(MONEY)).alias("s")
        )
        digits = F.concat(
            F.regexp_replace(F.col("s").cast("string"), "[.]", ""),
            F.lit("00000000000.0" + last),
        )
        wide = sums.select(
            F.concat(F.lit("supplier_"), F.col("l_suppkey").cast("string")).alias("table_name"),
            F.lit(DT).alias("data_dt"),
            digits.alias("scaled_sum"),
        )
        scaled.append(unpivot_metrics(wide, cluster))
    rounded = compare_metrics(*scaled)
    exact = compare_metrics(*scaled, exact_scale=2)
    return rounded.select("table_name", F.col("status").alias("status")).join(
        exact.select("table_name", F.col("status").alias("exact_status"), F.col("diff").alias("exact_diff")),
        "table_name",
    )


def compare_unpartitioned_keys(spark, sf):
    """Unpartitioned tables: blank partition column on the old side, NULL on the new."""
    specs = [ORDERS, CUSTOMER, TableSpec.of("sales.part", (), {"p_retailprice": MONEY})]
    frames = {s.name: table(spark, sf, s.name.split(".")[1]) for s in specs}
    old = collect_metrics(spark, specs, DT, "old", tables=frames, computed_at=AT).metrics
    new = collect_metrics(spark, specs, DT, "new", tables=frames, computed_at=AT).metrics
    new = new.withColumn("partition_col", F.lit(None).cast("string"))
    return compare_metrics(old, new).select(
        "table_name", "partition_col", "metric_name", "old_value", "new_value", "status"
    )


def reconcile_date(spark, sf):
    """One date of two tables measured on both sides and compared in one plan."""
    old = table(spark, sf, "lineitem")
    orders = table(spark, sf, "orders")
    compared = reconcile_metrics(
        spark,
        [LINEITEM, ORDERS],
        "1998-03-15",
        {"sales.lineitem": old, "sales.orders": orders},
        {"sales.lineitem": new_lineitem(old), "sales.orders": orders},
    )
    return compared.select("table_name", "partition_col", "metric_name", "old_value", "new_value", "status")


def reconcile_all_dates(spark, sf):
    """Every ship date measured on both sides and compared: one scan per side."""
    old = table(spark, sf, "lineitem")
    compared = reconcile_partitions(
        spark, [LINEITEM], {"sales.lineitem": old}, {"sales.lineitem": new_lineitem(old)}
    )
    return compared.select("data_dt", "metric_name", "old_value", "new_value", "status", "diff_num")


QUERIES = {
    "compare_metrics": compare_metrics_status,
    "compare_metrics_diff": compare_metrics_diff,
    "compare_metrics_reason": compare_metrics_reason,
    "compare_metrics_slices": compare_metrics_slices,
    "compare_metrics_stored": compare_metrics_stored,
    "compare_metrics_exact": compare_metrics_exact,
    "compare_unpartitioned_keys": compare_unpartitioned_keys,
    "reconcile_date": reconcile_date,
    "reconcile_all_dates": reconcile_all_dates,
}


_LINE_METRICS = ("l_quantity", "l_extendedprice", "l_tax")


def _values(fields) -> str:
    sums = ", ".join(f"CAST(sum(CAST({f} AS DECIMAL(16,2))) AS VARCHAR)" for f in fields)
    return f"[CAST(count(*) AS VARCHAR){', ' + sums if fields else ''}]"


def _names(fields) -> str:
    return "[" + ", ".join(["'row_count'"] + [f"'{f}_sum'" for f in fields]) + "]"


def _day_long(source: str, where: str = "") -> str:
    return f"""
  SELECT data_dt, unnest({_names(_LINE_METRICS)}) AS metric_name, unnest(v) AS value FROM (
    SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS data_dt, {_values(_LINE_METRICS)} AS v
    FROM {source} {where} GROUP BY 1)"""


def _whole_long(name: str, source: str, fields, where: str = "") -> str:
    return f"""
  SELECT '{name}' AS table_name, unnest({_names(fields)}) AS metric_name, unnest(v) AS value
  FROM (SELECT {_values(fields)} AS v FROM {source} {where})"""


_MISMATCH = f"""
  CASE {status_sql("old_value", "new_value")}
    WHEN 'MISSING_OLD' THEN 'missing in old cluster'
    WHEN 'MISSING_NEW' THEN 'missing in new cluster'
    WHEN 'FAIL' THEN 'values differ: ' || old_value || ' vs ' || new_value END"""

_ORIGINAL_MISMATCH = f"""
  CASE {status_sql("old_value", "new_value")}
    WHEN 'MISSING_OLD' THEN '旧集群缺失'
    WHEN 'MISSING_NEW' THEN '新集群缺失'
    WHEN 'FAIL' THEN '值不一致: ' || old_value || ' vs ' || new_value END"""

_STATUS_ROWS = f"""
WITH {METRIC_PAIRS_SQL}
SELECT table_name, metric_name, old_value, new_value, {status_sql("old_value", "new_value")} AS status
FROM pairs"""

_ON_DAY = "WHERE l_shipdate = TIMESTAMP '1998-03-15'"

SQL = {
    "compare_metrics": _STATUS_ROWS,
    "compare_metrics_stored": _STATUS_ROWS,
    "compare_metrics_diff": f"""
WITH {METRIC_PAIRS_SQL}
SELECT table_name, 'l_shipdate' AS partition_col, metric_name, '{DT}' AS data_dt,
       CAST(new_value AS DOUBLE) - CAST(old_value AS DOUBLE) AS diff_num
FROM pairs""",
    "compare_metrics_reason": f"""
WITH {METRIC_PAIRS_SQL}
SELECT table_name, metric_name, {_MISMATCH} AS reason, {_ORIGINAL_MISMATCH} AS original_reason
FROM pairs""",
    "compare_metrics_slices": f"""
WITH {METRIC_PAIRS_SQL}
SELECT table_name, metric_name, '{DT}' AS data_dt, {status_sql("old_value", "new_value")} AS status
FROM pairs""",
    "compare_metrics_exact": """
WITH sums AS (
  SELECT 'supplier_' || l_suppkey AS table_name,
         replace(CAST(sum(CAST(l_extendedprice AS DECIMAL(16,2))) AS VARCHAR), '.', '')
           || '00000000000' AS digits
  FROM lineitem GROUP BY l_suppkey)
SELECT table_name,
       CASE WHEN CAST(digits || '.01' AS DOUBLE) = CAST(digits || '.02' AS DOUBLE)
            THEN 'PASS' ELSE 'FAIL' END AS status,
       CASE WHEN CAST(digits || '.01' AS DECIMAL(38,2)) = CAST(digits || '.02' AS DECIMAL(38,2))
            THEN 'PASS' ELSE 'FAIL' END AS exact_status,
       CAST(CAST(digits || '.02' AS DECIMAL(38,2)) - CAST(digits || '.01' AS DECIMAL(38,2)) AS VARCHAR)
         AS exact_diff
FROM sums""",
    "compare_unpartitioned_keys": f"""
SELECT table_name, CAST(NULL AS VARCHAR) AS partition_col, metric_name,
       value AS old_value, value AS new_value, 'PASS' AS status
FROM ({_whole_long("sales.orders", "orders", ("o_totalprice",))}
  UNION ALL {_whole_long("sales.customer", "customer", ("c_acctbal",))}
  UNION ALL {_whole_long("sales.part", "part", ("p_retailprice",))})""",
    "reconcile_date": f"""
WITH {NEW_LINEITEM_SQL},
old_long AS ({_whole_long("sales.lineitem", "lineitem", _LINE_METRICS, _ON_DAY)}
  UNION ALL {_whole_long("sales.orders", "orders", ("o_totalprice",))}),
new_long AS ({_whole_long("sales.lineitem", "new_lineitem", _LINE_METRICS, _ON_DAY)}
  UNION ALL {_whole_long("sales.orders", "orders", ("o_totalprice",))})
SELECT o.table_name, CASE WHEN o.table_name = 'sales.lineitem' THEN 'l_shipdate' END AS partition_col,
       o.metric_name, o.value AS old_value, n.value AS new_value,
       {status_sql("o.value", "n.value")} AS status
FROM old_long o JOIN new_long n USING (table_name, metric_name)""",
    "reconcile_all_dates": f"""
WITH {NEW_LINEITEM_SQL},
old_long AS ({_day_long("lineitem")}),
new_long AS ({_day_long("new_lineitem")})
SELECT coalesce(o.data_dt, n.data_dt) AS data_dt, coalesce(o.metric_name, n.metric_name) AS metric_name,
       o.value AS old_value, n.value AS new_value, {status_sql("o.value", "n.value")} AS status,
       CAST(n.value AS DOUBLE) - CAST(o.value AS DOUBLE) AS diff_num
FROM old_long o FULL OUTER JOIN new_long n
  ON o.data_dt = n.data_dt AND o.metric_name = n.metric_name""",
}
