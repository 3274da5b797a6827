"""Inputs the queries share, defined once for Spark and once as SQL.

All derive from whole given tables and grow with them.  The *new* copy of
``lineitem`` shows every kind of disagreement: one group arrives under another
status (missing on either side), some prices differ, some rows got lost.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymatch import TableSpec
from tallymatch.operators import Metastore, metric_columns, unpivot_metrics
from tallymatch.session import shared_folder
from tallymatch.sources import file_metastore

AT = datetime(2026, 1, 2, 3, 4, 5)
AT_TEXT = "2026-01-02 03:04:05"
MONEY = "decimal(16,2)"

LINEITEM = TableSpec.of(
    "sales.lineitem",
    ["l_shipdate"],
    {"l_quantity": MONEY, "l_extendedprice": MONEY, "l_tax": "DECIMAL(16,2)", "l_returnflag": "string"},
)
ORDERS = TableSpec.of("sales.orders", (), {"o_totalprice": MONEY})
CUSTOMER = TableSpec.of(
    "sales.customer", (), {"c_name": "string", "c_acctbal": MONEY, "c_nationkey": "int"}
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def new_lineitem(old: DataFrame) -> DataFrame:
    """The copy under test."""
    moved = (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O")
    raised = (F.col("l_returnflag") == "R") & (F.col("l_discount") == 0.1)
    lost = (F.col("l_linestatus") == "F") & (F.col("l_quantity") == 50)
    return old.where(~lost).withColumns(
        {
            "l_linestatus": F.when(moved, "H").otherwise(F.col("l_linestatus")),
            "l_extendedprice": F.col("l_extendedprice") + F.when(raised, 1.0).otherwise(0.0),
        }
    )


NEW_LINEITEM_SQL = """
new_lineitem AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_tax,
         l_returnflag, l_shipdate,
         CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'H' ELSE l_linestatus END
           AS l_linestatus,
         l_extendedprice + CASE WHEN l_returnflag = 'R' AND l_discount = 0.1::DOUBLE
                                THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS l_extendedprice
  FROM lineitem
  WHERE NOT (l_linestatus = 'F' AND l_quantity = 50)
)"""


def metric_groups(df: DataFrame, cluster: str) -> DataFrame:
    """Long metrics per group of lineitem; the group plays the part of the table."""
    wide = df.groupBy(
        F.concat_ws("/", "l_returnflag", "l_linestatus").alias("table_name")
    ).agg(*metric_columns(TableSpec.of("g", (), {"l_quantity": MONEY, "l_extendedprice": MONEY})))
    tagged = wide.select(
        "table_name",
        F.lit("l_shipdate").alias("partition_col"),
        F.lit(AT).cast("timestamp").alias("computed_at"),
        F.lit("2026-01-01").alias("data_dt"),
        "row_count",
        "l_quantity_sum",
        "l_extendedprice_sum",
    )
    return unpivot_metrics(tagged, cluster)


def _long_sql(source: str) -> str:
    return f"""
  SELECT table_name, metric_name, value FROM (
    SELECT table_name, unnest(['row_count', 'l_quantity_sum', 'l_extendedprice_sum']) AS metric_name,
           unnest([n, q, p]) AS value
    FROM (
      SELECT l_returnflag || '/' || l_linestatus AS table_name,
             CAST(count(*) AS VARCHAR) AS n,
             CAST(sum(CAST(l_quantity AS DECIMAL(16,2))) AS VARCHAR) AS q,
             CAST(sum(CAST(l_extendedprice AS DECIMAL(16,2))) AS VARCHAR) AS p
      FROM {source} GROUP BY 1))"""


METRIC_PAIRS_SQL = f"""{NEW_LINEITEM_SQL},
old_long AS ({_long_sql("lineitem")}),
new_long AS ({_long_sql("new_lineitem")}),
pairs AS (
  SELECT coalesce(o.table_name, n.table_name) AS table_name,
         coalesce(o.metric_name, n.metric_name) AS metric_name,
         o.value AS old_value, n.value AS new_value
  FROM old_long o FULL OUTER JOIN new_long n
    ON o.table_name = n.table_name AND o.metric_name = n.metric_name)"""


def status_sql(old: str, new: str, number: str = "DOUBLE") -> str:
    equal = f"TRY_CAST({old} AS {number}) = TRY_CAST({new} AS {number})"
    return (
        f"CASE WHEN nullif({old}, '') IS NULL THEN 'MISSING_OLD' "
        f"WHEN nullif({new}, '') IS NULL THEN 'MISSING_NEW' "
        f"ELSE if(coalesce({equal}, false), 'PASS', 'FAIL') END"
    )


# --- metastore relations ----------------------------------------------------
# Parts stand for tables, brands for databases; economy parts have one partition
# key and promo parts two.  Line items per part (and ship date) supply the
# parameters, some of which are left out.


_written: dict[tuple[str, str], str] = {}


def metastore(spark: SparkSession, sf: str) -> Metastore:
    """The six relations, derived and written once a session, so that queries read tables."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _written:
        place = shared_folder(spark)
        for name, relation in vars(_derived_metastore(spark, sf)).items():
            relation.write.parquet(f"{place}/{name}")
        _written[key] = place
    return file_metastore(spark, _written[key])


def _derived_metastore(spark: SparkSession, sf: str) -> Metastore:
    part, line = table(spark, sf, "part"), table(spark, sf, "lineitem")
    brand = F.substring("p_brand", 7, 10).cast("bigint")
    one_key, two_keys = F.col("p_type") == "ECONOMY", F.col("p_type") == "PROMO"
    tables = part.select(
        F.col("p_partkey").alias("TBL_ID"),
        brand.alias("DB_ID"),
        F.concat(F.lit("t_"), F.col("p_partkey").cast("string")).alias("TBL_NAME"),
        F.when(F.col("p_size") > 25, "MANAGED_TABLE").otherwise("EXTERNAL_TABLE").alias("TBL_TYPE"),
        F.col("p_size").cast("bigint").alias("LAST_ACCESS_TIME"),
    )
    keys = part.where(one_key | two_keys).select(F.col("p_partkey").alias("TBL_ID"))
    second = part.where(two_keys).select(F.col("p_partkey").alias("TBL_ID"))

    facts = [
        F.count(F.lit(1)).alias("numRows"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("totalSize"),
        F.max(F.col("l_linenumber").cast("bigint")).alias("numFiles"),
        F.max("l_orderkey").alias("rawDataSize"),
    ]

    def params(facts_by_id: DataFrame, id_col: str) -> DataFrame:
        known = facts_by_id.select(
            id_col,
            F.col("numRows").cast("string").alias("numRows"),
            F.col("totalSize").cast("string").alias("totalSize"),
            F.when(F.col("numFiles") > 6, F.col("numFiles").cast("string")).alias("numFiles"),
            F.when(F.col("totalSize") > 25, F.col("rawDataSize").cast("string")).alias("rawDataSize"),
            F.lit("1").alias("transient_lastDdlTime"),
        )
        names = ["numRows", "totalSize", "numFiles", "rawDataSize", "transient_lastDdlTime"]
        return known.unpivot([id_col], names, "PARAM_KEY", "PARAM_VALUE").where(
            F.col("PARAM_VALUE").isNotNull()
        )

    by_table = line.groupBy(F.col("l_partkey").alias("TBL_ID")).agg(*facts)
    day = F.col("l_shipdate").cast("date")
    by_part = line.groupBy(F.col("l_partkey").alias("TBL_ID"), day.alias("day")).agg(*facts)
    kinds = part.where(one_key | two_keys).select(F.col("p_partkey").alias("TBL_ID"), "p_type")
    days = F.datediff(F.col("day"), F.lit("1970-01-01").cast("date")).cast("bigint")
    known = by_part.join(kinds, "TBL_ID").withColumn("PART_ID", F.col("TBL_ID") * 100000 + days)
    partitions = known.select(
        "PART_ID",
        "TBL_ID",
        F.concat(
            F.when(two_keys, "region=x/dt=").otherwise("dt="), F.col("day").cast("string")
        ).alias("PART_NAME"),
        days.alias("LAST_ACCESS_TIME"),
    )
    return Metastore(
        DBS=part.select(brand.alias("DB_ID"), F.col("p_brand").alias("NAME")).distinct(),
        TBLS=tables,
        PARTITION_KEYS=keys.unionByName(second),
        TABLE_PARAMS=params(by_table, "TBL_ID"),
        PARTITIONS=partitions,
        PARTITION_PARAMS=params(known, "PART_ID"),
    )


def _params_sql(source: str, id_col: str) -> str:
    return f"""
  SELECT {id_col}, 'numRows' AS PARAM_KEY, CAST(num_rows AS VARCHAR) AS PARAM_VALUE FROM {source}
  UNION ALL SELECT {id_col}, 'totalSize', CAST(total_size AS VARCHAR) FROM {source}
  UNION ALL SELECT {id_col}, 'numFiles', CAST(num_files AS VARCHAR) FROM {source} WHERE num_files > 6
  UNION ALL SELECT {id_col}, 'rawDataSize', CAST(raw_size AS VARCHAR) FROM {source}
            WHERE total_size > 25
  UNION ALL SELECT {id_col}, 'transient_lastDdlTime', '1' FROM {source}"""


_FACTS_SQL = """count(*) AS num_rows, CAST(sum(l_quantity) AS BIGINT) AS total_size,
         CAST(max(l_linenumber) AS BIGINT) AS num_files, max(l_orderkey) AS raw_size"""

METASTORE_SQL = f"""
DBS AS (SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS DB_ID, p_brand AS NAME FROM part),
TBLS AS (
  SELECT p_partkey AS TBL_ID, CAST(substr(p_brand, 7) AS BIGINT) AS DB_ID,
         't_' || p_partkey AS TBL_NAME,
         CASE WHEN p_size > 25 THEN 'MANAGED_TABLE' ELSE 'EXTERNAL_TABLE' END AS TBL_TYPE,
         CAST(p_size AS BIGINT) AS LAST_ACCESS_TIME
  FROM part),
PARTITION_KEYS AS (
  SELECT p_partkey AS TBL_ID FROM part WHERE p_type IN ('ECONOMY', 'PROMO')
  UNION ALL SELECT p_partkey FROM part WHERE p_type = 'PROMO'),
by_table AS (SELECT l_partkey AS TBL_ID, {_FACTS_SQL} FROM lineitem GROUP BY 1),
by_part AS (
  SELECT TBL_ID, day, num_rows, total_size, num_files, raw_size, p_type,
         day - DATE '1970-01-01' AS days,
         TBL_ID * 100000 + (day - DATE '1970-01-01') AS PART_ID
  FROM (SELECT l_partkey AS TBL_ID, CAST(l_shipdate AS DATE) AS day, {_FACTS_SQL}
        FROM lineitem GROUP BY 1, 2)
  JOIN part ON p_partkey = TBL_ID AND p_type IN ('ECONOMY', 'PROMO')),
TABLE_PARAMS AS ({_params_sql("by_table", "TBL_ID")}),
PARTITIONS AS (
  SELECT PART_ID, TBL_ID, CAST(days AS BIGINT) AS LAST_ACCESS_TIME,
         CASE WHEN p_type = 'PROMO' THEN 'region=x/dt=' ELSE 'dt=' END || CAST(day AS VARCHAR)
           AS PART_NAME
  FROM by_part),
PARTITION_PARAMS AS ({_params_sql("by_part", "PART_ID")})"""


# --- statistics -------------------------------------------------------------


def group_stats(df: DataFrame) -> DataFrame:
    """Statistics rows counted from line items per part, flag and status."""
    return df.groupBy(
        F.col("l_returnflag").alias("database_name"),
        F.col("l_partkey").cast("string").alias("table_name"),
        F.col("l_linestatus").alias("partition_name"),
    ).agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("total_size"),
        F.max(F.col("l_linenumber").cast("bigint")).alias("num_files"),
        F.sum(F.floor(F.col("l_extendedprice")).cast("bigint")).alias("raw_data_size"),
        F.lit("2026-01-01").alias("data_dt"),
    )


def _group_stats_sql(source: str) -> str:
    return f"""
  SELECT l_returnflag AS db, CAST(l_partkey AS VARCHAR) AS tbl, l_linestatus AS part,
         count(*) AS num_rows, CAST(sum(l_quantity) AS BIGINT) AS total_size,
         CAST(max(l_linenumber) AS BIGINT) AS num_files,
         CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) AS raw_data_size
  FROM {source} GROUP BY 1, 2, 3"""


GROUP_STATS_SQL = f"""{NEW_LINEITEM_SQL},
old_stats AS ({_group_stats_sql("lineitem")}),
new_stats AS ({_group_stats_sql("new_lineitem")})"""
