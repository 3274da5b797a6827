"""Row counts and table statistics compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymatch.functions import or_zero, to_long
from tallymatch.operators import (
    compare_row_counts,
    compare_stats_wide,
    latest_by_key,
    preview,
    table_stats,
)
from tallymatch.operators.compare import TABLE_KEY

from .inputs import GROUP_STATS_SQL, group_stats, new_lineitem, table

MEASURES = ("num_rows", "total_size", "num_files", "raw_data_size")


def _sides(spark, sf):
    old = table(spark, sf, "lineitem")
    return group_stats(old), group_stats(new_lineitem(old))


def table_stats_rows(spark, sf):
    stats = table_stats(table(spark, sf, "lineitem"), "sales", "lineitem", data_dt="2026-01-01")
    return stats.select(
        "database_name", "table_name", "table_type", "partition_name", "num_rows", "data_dt"
    )


def table_stats_files(spark, sf):
    """Files and bytes, which SQL cannot see; the estimate reads whole rows."""
    return table_stats(
        table(spark, sf, "orders"), "sales", "orders", data_dt="2026-01-01", estimate_raw_size=True
    )


def stats_int_parse(spark, sf):
    digits = F.get_json_object("props", "$.k")
    raw = (
        F.when(F.col("event_type") == "click", digits)
        .when(F.col("event_type") == "view", F.concat(F.lit(" "), digits, F.lit(" ")))
        .when(F.col("event_type") == "purchase", F.concat(digits, F.lit(".5")))
        .when(F.col("event_type") == "signup", "")
        .otherwise(F.concat(F.lit("k"), digits))
    )
    parsed = to_long(F.col("raw"))
    return table(spark, sf, "events").select("event_id", raw.alias("raw")).select(
        "event_id", "raw", parsed.alias("parsed"), or_zero(parsed).alias("safe")
    )


def stats_last_wins(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("database_name"),
        F.col("o_custkey").cast("string").alias("table_name"),
        "o_orderkey",
        F.col("o_orderpriority").alias("priority"),
    )
    return latest_by_key(orders, ("database_name", "table_name"), ("o_orderkey",))


def rowcount_compare(spark, sf):
    return compare_row_counts(*_sides(spark, sf))


def rowcount_partition_pref(spark, sf):
    """One row per table: last partition wins, blank partition names stay the old side's."""
    old, new = _sides(spark, sf)
    blank = F.when(F.col("partition_name") == "O", "").otherwise(F.col("partition_name"))
    order = F.col("partition_name").alias("position")
    old = old.withColumn("position", order).withColumn("partition_name", blank)
    new = new.withColumn("position", order)
    return compare_row_counts(old, new, key=TABLE_KEY, order=("position",))


def rowcount_preview(spark, sf):
    return preview(compare_row_counts(*_sides(spark, sf)))


def stats_wide_compare(spark, sf):
    return compare_stats_wide(*_sides(spark, sf))


def stats_wide_all(spark, sf):
    wide = compare_stats_wide(*_sides(spark, sf), include_equal=True, with_diff=False)
    return wide.groupBy("status").agg(
        F.count(F.lit(1)).alias("tables"),
        F.sum("old_num_rows").alias("old_num_rows"),
        F.sum("new_num_rows").alias("new_num_rows"),
    )


QUERIES = {
    "table_stats_from_data": table_stats_rows,
    "table_stats_files": table_stats_files,
    "stats_int_parse": stats_int_parse,
    "stats_last_wins": stats_last_wins,
    "rowcount_compare": rowcount_compare,
    "rowcount_partition_pref": rowcount_partition_pref,
    "rowcount_preview": rowcount_preview,
    "stats_wide_compare": stats_wide_compare,
    "stats_wide_all": stats_wide_all,
}

_PAIRS = f"""{GROUP_STATS_SQL},
pairs AS (
  SELECT coalesce(o.db, n.db) AS db, coalesce(o.tbl, n.tbl) AS tbl, coalesce(o.part, n.part) AS part,
         o.db IS NOT NULL AS in_old, n.db IS NOT NULL AS in_new,
         {", ".join(f"o.{m} AS old_{m}, n.{m} AS new_{m}" for m in MEASURES)}
  FROM old_stats o FULL OUTER JOIN new_stats n ON o.db = n.db AND o.tbl = n.tbl AND o.part = n.part)"""

_ROWCOUNT = """
SELECT db AS database_name, tbl AS table_name, part AS partition_name, 'num_rows' AS metric_name,
       old_num_rows AS old_value, new_num_rows AS new_value,
       coalesce(new_num_rows, 0) - coalesce(old_num_rows, 0) AS diff_value, '2026-01-01' AS data_dt
FROM pairs"""

_WIDE_STATUS = f"""
CASE WHEN NOT in_new THEN 'only_in_old' WHEN NOT in_old THEN 'only_in_new'
     WHEN {" OR ".join(f"old_{m} IS DISTINCT FROM new_{m}" for m in MEASURES)} THEN 'difference'
     ELSE 'equal' END"""


def _last(source: str) -> str:
    return f"""
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY db, tbl ORDER BY part DESC) AS rn
                 FROM {source}) WHERE rn = 1"""


SQL = {
    "table_stats_from_data": """
SELECT 'sales' AS database_name, 'lineitem' AS table_name, 'EXTERNAL_TABLE' AS table_type,
       '' AS partition_name, count(*) AS num_rows, '2026-01-01' AS data_dt
FROM lineitem""",
    "stats_int_parse": """
WITH spelled AS (
  SELECT event_id, CASE event_type
           WHEN 'click' THEN props ->> '$.k'
           WHEN 'view' THEN ' ' || (props ->> '$.k') || ' '
           WHEN 'purchase' THEN (props ->> '$.k') || '.5'
           WHEN 'signup' THEN ''
           ELSE 'k' || (props ->> '$.k') END AS raw
  FROM events)
SELECT event_id, raw,
       CASE WHEN regexp_full_match(trim(raw), '[+-]?[0-9]+') THEN CAST(trim(raw) AS BIGINT) END AS parsed,
       coalesce(CASE WHEN regexp_full_match(trim(raw), '[+-]?[0-9]+') THEN CAST(trim(raw) AS BIGINT) END, 0)
         AS safe
FROM spelled""",
    "stats_last_wins": """
SELECT database_name, table_name, o_orderkey, priority FROM (
  SELECT o_orderstatus AS database_name, CAST(o_custkey AS VARCHAR) AS table_name, o_orderkey,
         o_orderpriority AS priority,
         row_number() OVER (PARTITION BY o_orderstatus, o_custkey
                            ORDER BY o_orderkey DESC, o_orderpriority DESC) AS rn
  FROM orders)
WHERE rn = 1""",
    "rowcount_compare": f"WITH {_PAIRS} {_ROWCOUNT}",
    "rowcount_partition_pref": f"""
WITH {GROUP_STATS_SQL}, o AS ({_last("old_stats")}), n AS ({_last("new_stats")})
SELECT coalesce(o.db, n.db) AS database_name, coalesce(o.tbl, n.tbl) AS table_name,
       CASE WHEN o.db IS NULL THEN n.part WHEN o.part = 'O' THEN NULL ELSE o.part END AS partition_name,
       'num_rows' AS metric_name, o.num_rows AS old_value, n.num_rows AS new_value,
       coalesce(n.num_rows, 0) - coalesce(o.num_rows, 0) AS diff_value, '2026-01-01' AS data_dt
FROM o FULL OUTER JOIN n ON o.db = n.db AND o.tbl = n.tbl""",
    "rowcount_preview": f"""
WITH {_PAIRS} {_ROWCOUNT}
ORDER BY database_name, table_name, partition_name LIMIT 10""",
    "stats_wide_compare": f"""
WITH {_PAIRS}
SELECT * FROM (
  SELECT db AS database_name, tbl AS table_name, part AS partition_name, {_WIDE_STATUS} AS status,
         {", ".join(f"old_{m}, new_{m}, new_{m} - old_{m} AS diff_{m}" for m in MEASURES)}
  FROM pairs)
WHERE status <> 'equal'""",
    "stats_wide_all": f"""
WITH {_PAIRS}
SELECT {_WIDE_STATUS} AS status, count(*) AS tables,
       CAST(sum(old_num_rows) AS BIGINT) AS old_num_rows,
       CAST(sum(new_num_rows) AS BIGINT) AS new_num_rows
FROM pairs GROUP BY 1""",
}
