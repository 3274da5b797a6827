"""Results that must be proven: runs of the right date, expected metrics, exact numbers, other tables, any text."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallymatch import TableSpec
from tallymatch.functions import ANY_SCALE
from tallymatch.operators import compare_metrics
from tallymatch.plans import compare_stored, measure_to_tsv, reconcile_metrics, run_all, run_new, store_metrics
from tallymatch.session import shared_folder
from tallymatch.sinks import create_tables, export_metrics_tsv
from tallymatch.sources import read_metrics_tsv, read_stats_csv, read_strict_tsv

from .inputs import ORDERS, table
from .safety import DT, LINES, SHOWN

OTHER = "2025-12-31"


def _raises(call) -> bool:
    try:
        call()
    except Exception:  # noqa: BLE001  the query shows that the job failed, however it did
        return True
    return False


def run_all_other_date(spark, sf):
    """Runs that bring rows of another date fail, and yesterday's slices are not judged for them."""
    folder = shared_folder(spark)
    frames = {"sales.lineitem": table(spark, sf, "lineitem")}
    shown = []

    def show(case, target, failed):
        rows = compare_stored(spark, target, DT).select(*SHOWN)
        rows = rows.select(F.lit(case).alias("case"), "*", F.lit(failed).alias("failed"))
        rows.write.parquet(f"{folder}/shown_{case}")  # as the slices are now
        shown.append(spark.read.parquet(f"{folder}/shown_{case}"))

    for case in ("new", "old"):
        target = f"{folder}/{case}"
        for cluster in ("old", "new"):
            store_metrics(spark, [LINES], DT, cluster, target, tables=frames, overwrite=True)
        if case == "new":
            foreign = f"""SELECT 'sales.lineitem' AS table_name, '{OTHER}' AS data_dt, '' AS partition_col,
                                 current_timestamp() AS computed_at, count(1) AS row_count
                          FROM parquet.`{sf}/lineitem.parquet`"""
            failed = _raises(lambda: run_new(spark, [foreign], DT, target, overwrite=True))
        else:
            measure_to_tsv(spark, [LINES], OTHER, "old", f"{folder}/tsv", tables=frames)
            failed = _raises(lambda: run_all(spark, f"{folder}/tsv", [LINES], DT, target, overwrite=True, tables=frames))
        show(case, target, failed)
    measure_to_tsv(spark, [LINES], DT, "old", f"{folder}/right", tables=frames)
    failed = _raises(lambda: run_all(spark, f"{folder}/right", [LINES], DT, target, overwrite=True, tables=frames))
    show("again", target, failed)
    return shown[0].union(shown[1]).union(shown[2])


def reconcile_expected_grid(spark, sf):
    """A table absent on both sides, one that fails on both, one that fails on the new side only."""
    lines, orders, customers = (table(spark, sf, t) for t in ("lineitem", "orders", "customer"))
    gone = TableSpec.of("sales.gone", (), {"amount": "decimal(16,2)"})
    broken = TableSpec.of("sales.customer", (), {"no_such_column": "decimal(16,2)"})
    old = {"sales.lineitem": lines, "sales.orders": orders, "sales.customer": customers}
    new = {**old, "sales.orders": orders.drop("o_totalprice")}
    compared = reconcile_metrics(spark, [LINES, ORDERS, gone, broken], DT, old, new, on_error="skip")
    return compared.select(*SHOWN, F.col("reason").isNotNull().alias("has_reason"))


# The same expressions in Spark and in the checking SQL; {h} is a digest of the key in hexadecimal.
_DIGITS = "substr(translate({h}, 'abcdef', '123456'), 1, CAST(1 + o_orderkey % 38 AS INT)) AS d"
_PLACED = "CAST(o_orderkey % (length(d) + 1) AS INT) AS p, CASE WHEN o_orderkey % 3 = 0 THEN '-' ELSE '' END AS s"
_OLD = "CASE WHEN o_orderkey % 5 = 4 THEN '-0' ELSE concat(s, substr(d, 1, p), '.', substr(d, p + 1)) END"
_LAST = "concat(substr(d, 1, length(d) - 1), translate(substr(d, length(d), 1), '0123456789', '1234567890'))"
_NEW = f"""CASE o_orderkey % 5
  WHEN 0 THEN concat(s, substr(d, 1, p), '.', substr(d, p + 1))
  WHEN 1 THEN concat(s, '00', substr(d, 1, p), '.', substr(d, p + 1), '000')
  WHEN 2 THEN concat(s, d, 'E', CAST(p - length(d) AS {{text}}))
  WHEN 3 THEN concat(s, substr({_LAST}, 1, p), '.', substr({_LAST}, p + 1))
  ELSE '0.000e5' END"""


def compare_metrics_canonical(spark, sf):
    """Numbers of 1 to 38 digits, written with points, outer zeros, exponents and as minus zero."""
    digits = table(spark, sf, "orders").selectExpr(
        "o_orderkey", _DIGITS.format(h="sha2(cast(o_orderkey as string), 256)")
    )
    pairs = digits.selectExpr("o_orderkey", "d", *_PLACED.rsplit(", ", 1)).selectExpr(
        "concat('t_', o_orderkey) as table_name", f"{_OLD} as old", f"{_NEW.format(text='string')} as new"
    )
    sides = [
        pairs.selectExpr(
            f"'{side}' as cluster", "table_name", "'' as partition_col", "'m' as metric_name", f"{side} as value",
            "timestamp'2026-01-01' as computed_at", f"'{DT}' as data_dt",
        )
        for side in ("old", "new")
    ]
    compared = compare_metrics(*sides, exact_scale=ANY_SCALE)
    return compared.select("table_name", "old_value", "new_value", "status", F.coalesce(F.col("diff") == "0", F.lit(False)).alias("no_diff"))


def reconcile_namespaces(spark, sf):
    """Two databases with the same tables, a name of one of them in other letters, and a table at the same place."""
    folder, mark = shared_folder(spark), uuid.uuid4().hex[:12]
    old, new, alias, results = (f"tm_{kind}_{mark}" for kind in ("old", "new", "alias", "results"))
    lines = TableSpec.of("sales.lineitem", (), {"l_quantity": "decimal(16,2)"})
    for database in (old, new, alias):
        spark.sql(f"CREATE DATABASE {database}")
    for database, least in ((old, 1), (new, 2)):
        rows = table(spark, sf, "lineitem").where(F.col("l_linenumber") >= least)
        rows.write.option("path", f"{folder}/{database}").saveAsTable(f"{database}.lineitem")
    spark.sql(f"CREATE TABLE {alias}.lineitem USING parquet LOCATION '{folder}/{old}'")

    def side(database):
        return {"sales.lineitem": spark.table(f"{database}.lineitem")}

    cases = {
        "letters": dict(old_namespace=old, new_namespace=old.upper()),
        "place": dict(old_namespace=old, new_namespace=alias),
        "mapping": dict(old_namespace=old, new_tables=side(old)),
    }
    refused = [(name, _raises(lambda how=how: reconcile_metrics(spark, [lines], DT, **how))) for name, how in cases.items()]
    summary, _ = create_tables(spark, results)
    for cluster, database in (("old", old), ("new", new)):
        store_metrics(spark, [lines], DT, cluster, summary, tables=side(database), overwrite=True)
    both = {
        "direct": reconcile_metrics(spark, [lines], DT, old_namespace=old, new_namespace=new),
        "stored": compare_stored(spark, summary, DT, proven=True),
    }
    parts = [df.select(F.lit(case).alias("case"), *SHOWN) for case, df in both.items()]
    found = spark.createDataFrame(
        [(name, None, None, None, None, "REFUSED" if was else "COMPARED") for name, was in refused],
        "case string, table_name string, metric_name string, old_value string, new_value string, status string",
    )
    result = parts[0].union(parts[1]).union(found)
    result.write.parquet(f"{folder}/result")  # kept, as the databases go now
    for database in (old, new, alias, results):
        spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.read.parquet(f"{folder}/result")


def stats_csv_mixed_folder(spark, sf):
    """One folder of files whose headers stand in two orders."""
    folder = shared_folder(spark)
    stats = table(spark, sf, "documents").select(
        F.concat(F.lit('"'), F.translate(F.coalesce("text", F.lit("")), "\n\r", "\t\t")).alias("table_name"),
        F.col("lang").alias("database_name"),
        F.col("doc_id").cast("string").alias("partition_name"),
        F.col("n_chars").alias("num_rows"),
        F.lit(1).alias("num_files"),
        F.lit(DT).alias("data_dt"),
    )
    for rest, columns in enumerate((stats.columns, list(reversed(stats.columns)))):
        half = stats.where(F.col("partition_name") % 2 == rest).select(*columns)
        half.write.mode("append").option("header", True).option("escape", '"').csv(f"{folder}/stats")
    back = read_stats_csv(spark, f"{folder}/stats")
    return back.select(F.sha2("table_name", 256).alias("name_sha256"), "partition_name", "num_rows", "num_files")


def tsv_any_text(spark, sf):
    """Whole texts with their line breaks, through a file of lines and back."""
    folder = shared_folder(spark)
    long = table(spark, sf, "documents").select(
        F.lit("web.documents").alias("table_name"),
        F.lit(DT).alias("data_dt"),
        F.lit("").alias("partition_col"),
        F.concat(F.lit("text_"), F.col("doc_id").cast("string")).alias("metric_name"),
        F.col("text").alias("value"),
        F.lit("old").alias("cluster"),
    )
    export_metrics_tsv(long, f"{folder}/tsv", any_text=True)
    back = read_metrics_tsv(spark, f"{folder}/tsv", any_text=True)
    return back.select("metric_name", F.sha2("value", 256).alias("value_sha256"), F.length("value").alias("chars"))


def ragged_foreign_header(spark, sf):
    """Files whose header has other names than the reader, with a row that reads like the reader's names."""
    folder = shared_folder(spark)
    names = ("id", "status", "price")
    rows = table(spark, sf, "orders").selectExpr(
        "cast(o_orderkey as string) as some_key", "o_orderstatus as state", "cast(o_totalprice as string) as total"
    )
    odd = spark.createDataFrame([names], "some_key string, state string, total string")
    rows.union(odd).repartition(3).write.option("sep", "\t").option("header", True).csv(f"{folder}/tsv")
    return read_strict_tsv(spark, f"{folder}/tsv", names, header=True).select("id", "status")


QUERIES = {
    f.__name__: f
    for f in (
        run_all_other_date,
        reconcile_expected_grid,
        compare_metrics_canonical,
        reconcile_namespaces,
        stats_csv_mixed_folder,
        tsv_any_text,
        ragged_foreign_header,
    )
}


def _rows(name: str, values: dict[str, str], status: str, old: bool = True, new: bool = True, more: str = "") -> str:
    none = "CAST(NULL AS VARCHAR)"
    return "\nUNION ALL ".join(
        f"SELECT {more}'{name}' AS table_name, '{metric}' AS metric_name, {value if old else none} AS old_value, "
        f"{value if new else none} AS new_value, '{status}' AS status"
        for metric, value in values.items()
    )


def _of(relation: str, total: str, metric: str) -> dict[str, str]:
    return {
        "row_count": f"(SELECT CAST(count(*) AS VARCHAR) FROM {relation})",
        metric: f"(SELECT CAST(sum(CAST({total} AS DECIMAL(16,2))) AS VARCHAR) FROM {relation})",
    }


_LINES = _of("lineitem", "l_quantity", "l_quantity_sum")
_ORDERS = _of("orders", "o_totalprice", "o_totalprice_sum")
_SOME = "(SELECT * FROM lineitem WHERE l_linenumber >= 2)"
_NONE = {"row_count": "NULL", "amount_sum": "NULL"}
_BROKEN = {"row_count": "NULL", "no_such_column_sum": "NULL"}


def _namespace_rows(case: str) -> str:
    old, new = _LINES, _of(_SOME, "l_quantity", "l_quantity_sum")
    return "\nUNION ALL ".join(
        f"SELECT '{case}' AS \"case\", 'sales.lineitem' AS table_name, '{m}' AS metric_name, {old[m]} AS old_value, "
        f"{new[m]} AS new_value, CASE WHEN {old[m]} = {new[m]} THEN 'PASS' ELSE 'FAIL' END AS status"
        for m in old
    )


SQL = {
    "run_all_other_date": "\nUNION ALL ".join(
        f"SELECT '{case}' AS \"case\", *, {failed} AS failed FROM ({_rows('sales.lineitem', _LINES, status)})"
        for case, status, failed in (
            ("new", "NOT_MEASURED", "true"), ("old", "NOT_MEASURED", "true"), ("again", "PASS", "false"),
        )
    ),
    "reconcile_expected_grid": "\nUNION ALL ".join(
        f"SELECT *, {reason} AS has_reason FROM ({rows})"
        for reason, rows in (
            ("false", _rows("sales.lineitem", _LINES, "PASS")),
            ("true", _rows("sales.orders", _ORDERS, "NOT_MEASURED", new=False)),
            ("true", _rows("sales.gone", _NONE, "NOT_MEASURED", False, False)),
            ("true", _rows("sales.customer", _BROKEN, "NOT_MEASURED", False, False)),
        )
    ),
    "compare_metrics_canonical": f"""
        WITH a AS (SELECT o_orderkey, {_DIGITS.format(h="sha256(CAST(o_orderkey AS VARCHAR))")} FROM orders),
        b AS (SELECT o_orderkey, d, {_PLACED} FROM a)
        SELECT 't_' || o_orderkey AS table_name, {_OLD} AS old_value, {_NEW.format(text="VARCHAR")} AS new_value,
               CASE WHEN o_orderkey % 5 = 3 THEN 'FAIL' ELSE 'PASS' END AS status,
               CASE WHEN o_orderkey % 5 = 3 THEN false ELSE true END AS no_diff
        FROM b""",
    "reconcile_namespaces": "\nUNION ALL ".join(
        [_namespace_rows("direct"), _namespace_rows("stored")]
        + [f"SELECT '{case}', NULL, NULL, NULL, NULL, 'REFUSED'" for case in ("letters", "place", "mapping")]
    ),
    "stats_csv_mixed_folder": """
        SELECT sha256('"' || translate(coalesce(text, ''), chr(10) || chr(13), chr(9) || chr(9))) AS name_sha256,
               CAST(doc_id AS VARCHAR) AS partition_name, CAST(n_chars AS VARCHAR) AS num_rows, '1' AS num_files
        FROM documents""",
    "tsv_any_text": """
        SELECT 'text_' || doc_id AS metric_name, sha256(text) AS value_sha256, CAST(length(text) AS INTEGER) AS chars
        FROM documents""",
    "ragged_foreign_header": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status FROM orders
        UNION ALL SELECT 'id', 'status'""",
}
