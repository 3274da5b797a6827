"""Parts that the other queries pass by: spec files, counts while writing, absent columns, words, file facts."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tallymatch.model import specs_from_json
from tallymatch.operators import as_metric_rows, compare_metrics, table_stats, unpivot_metrics
from tallymatch.plans import collect_metrics, store_catalog_stats
from tallymatch.session import shared_folder
from tallymatch.sinks import export_metrics_tsv
from tallymatch.sources import read_metrics_tsv, read_stats_csv

from .catalog import DAY, _partitions, _tables
from .inputs import AT_TEXT, METASTORE_SQL, metastore, table

DT = "2026-01-01"
SPECS = {
    "tables": [
        {
            "name": "sales.lineitem",
            "partition_cols": [],
            "fields": [{"name": "l_quantity", "type": "decimal(16,2)"}, {"name": "l_tax"}],
        },
        {"name": "sales.orders", "fields": []},
        {"name": "sales.part", "partition_cols": None, "fields": [{"name": "p_type", "type": "string"}]},
    ]
}


def specs_json_metrics(spark, sf):
    """Metrics of tables described in JSON: a type left out, no fields, no partition columns."""
    specs = specs_from_json(json.dumps(SPECS))
    frames = {s.name: table(spark, sf, s.name.split(".")[1]) for s in specs}
    run = collect_metrics(spark, specs, DT, "old", tables=frames)
    return run.metrics.select("table_name", "metric_name", "value")


def metric_absent_base(spark, sf):
    """Wide rows without a partition column and a time: both are missing in the long ones."""
    wide = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("table_name")).agg(
        F.lit(DT).alias("data_dt"), F.count(F.lit(1)).alias("row_count"), F.max("o_orderkey").alias("last_key")
    )
    return unpivot_metrics(wide, "old").select(
        "cluster", "table_name", "partition_col", "metric_name", "value", "data_dt",
        F.col("computed_at").isNull().alias("no_time"),
    )


def _order_rows(spark, sf, cluster, value):
    return as_metric_rows(
        table(spark, sf, "orders").select(
            F.lit(cluster).alias("cluster"),
            F.col("o_orderkey").cast("string").alias("table_name"),
            F.lit(None).cast("string").alias("partition_col"),
            F.lit("priority").alias("metric_name"),
            value.alias("value"),
            F.lit(AT_TEXT).cast("timestamp").alias("computed_at"),
            F.lit(DT).alias("data_dt"),
        )
    )


def compare_metrics_words(spark, sf):
    """Values that are no numbers never pass, not even equal ones; numbers in another spelling do."""
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    old = F.when(status == "F", F.col("o_orderpriority")).otherwise(key)
    new = F.when(status == "P", F.concat(F.lit("n"), key)).when(status == "O", F.concat(key, F.lit(".0"))).otherwise(old)
    sides = (_order_rows(spark, sf, c, v) for c, v in (("old", old), ("new", new)))
    return compare_metrics(*sides).select("table_name", "old_value", "new_value", "status")


def written_counts(spark, sf):
    """Rows counted while they are written, and the rows that are there afterwards."""
    place = f"{shared_folder(spark)}/tsv"
    written = export_metrics_tsv(_order_rows(spark, sf, "old", F.col("o_orderpriority")), place)
    back = read_metrics_tsv(spark, place)
    return back.agg(F.count(F.lit(1)).alias("rows_read")).withColumn("rows_written", F.lit(written).cast("bigint"))


def catalog_stats_stored(spark, sf):
    """Statistics of a catalog written as CSV and read again, blank partition names as none."""
    place = f"{shared_folder(spark)}/stats"
    written = store_catalog_stats(metastore(spark, sf), DAY, place)
    numbers = ("num_rows", "total_size", "num_files", "raw_data_size", "last_access_time")
    return read_stats_csv(spark, place).select(
        "database_name", "table_name", "table_type",
        F.nullif("partition_name", F.lit("")).alias("partition_name"),
        *[F.expr(f"try_cast({n} as bigint)").alias(n) for n in numbers],
        "data_dt",
        F.lit(written).cast("bigint").alias("rows_written"),
    )


def table_stats_by_year(spark, sf):
    """Rows and files per year of a table of many files, with a year whose only file is empty.

    A pair of year and part is one task's, so it is one file.
    """
    place = f"{shared_folder(spark)}/orders"
    rows = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("o_year"), (F.col("o_orderkey") % 8).alias("part")
    )
    rows.repartition("o_year", "part").write.partitionBy("o_year", "part").parquet(place)
    nothing = spark.createDataFrame([], rows.drop("o_year", "part").schema)
    nothing.coalesce(1).write.parquet(f"{place}/o_year=1900/part=0")
    stats = table_stats(
        spark.read.parquet(place), "sales", "orders", partition_cols=["o_year"], data_dt=DT, path=place
    )
    return stats.select("database_name", "table_name", "table_type", "partition_name", "num_rows", "num_files", "data_dt")


QUERIES = {
    f.__name__: f
    for f in (
        specs_json_metrics,
        metric_absent_base,
        compare_metrics_words,
        written_counts,
        catalog_stats_stored,
        table_stats_by_year,
    )
}


def _metric(relation: str, metric: str, value: str) -> str:
    return (
        f"SELECT 'sales.{relation}' AS table_name, '{metric}' AS metric_name, "
        f"CAST({value} AS VARCHAR) AS value FROM {relation}"
    )


SQL = {
    "specs_json_metrics": " UNION ALL ".join(
        [
            _metric("lineitem", "row_count", "count(*)"),
            _metric("lineitem", "l_quantity_sum", "sum(CAST(l_quantity AS DECIMAL(16,2)))"),
            _metric("lineitem", "l_tax_sum", "sum(CAST(l_tax AS DECIMAL(38,2)))"),
            _metric("orders", "row_count", "count(*)"),
            _metric("part", "row_count", "count(*)"),
        ]
    ),
    "metric_absent_base": f"""
WITH w AS (SELECT o_orderstatus, count(*) AS n, max(o_orderkey) AS k FROM orders GROUP BY 1)
SELECT 'old' AS cluster, o_orderstatus AS table_name, CAST(NULL AS VARCHAR) AS partition_col,
       metric_name, value, '{DT}' AS data_dt, true AS no_time
FROM (SELECT o_orderstatus, 'row_count' AS metric_name, CAST(n AS VARCHAR) AS value FROM w
      UNION ALL SELECT o_orderstatus, 'last_key', CAST(k AS VARCHAR) FROM w)""",
    "compare_metrics_words": """
SELECT CAST(o_orderkey AS VARCHAR) AS table_name,
       CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE CAST(o_orderkey AS VARCHAR) END AS old_value,
       CASE o_orderstatus WHEN 'F' THEN o_orderpriority WHEN 'P' THEN 'n' || o_orderkey
            WHEN 'O' THEN o_orderkey || '.0' ELSE CAST(o_orderkey AS VARCHAR) END AS new_value,
       CASE WHEN o_orderstatus IN ('F', 'P') THEN 'FAIL' ELSE 'PASS' END AS status
FROM orders""",
    "written_counts": "SELECT count(*) AS rows_read, count(*) AS rows_written FROM orders",
    "catalog_stats_stored": f"""
WITH {METASTORE_SQL}, s AS ({_tables(DAY)} UNION ALL {_partitions(DAY, "1998-03-15")})
SELECT * REPLACE (nullif(partition_name, '') AS partition_name), (SELECT count(*) FROM s) AS rows_written
FROM s""",
    "table_stats_by_year": f"""
SELECT 'sales' AS database_name, 'orders' AS table_name, 'EXTERNAL_TABLE' AS table_type,
       'o_year=' || year AS partition_name, num_rows, num_files, '{DT}' AS data_dt
FROM (SELECT year(o_orderdate) AS year, count(*) AS num_rows, count(DISTINCT o_orderkey % 8) AS num_files
      FROM orders GROUP BY 1 UNION ALL SELECT 1900, 0, 1)""",
}
