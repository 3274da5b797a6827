"""Proof of runs, grids of expected metrics, exact numbers, identities of tables, and text of any kind."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal, getcontext

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymatch import TableSpec
from tallymatch import model as M
from tallymatch.functions import ANY_SCALE, canonical, escaped, exact_difference, plain, unescaped
from tallymatch.functions.verdict import metric_diff, metric_status
from tallymatch.manifest import read_manifest, record_slices
from tallymatch.plans import (
    compare_stored,
    ingest_old,
    measure_to_tsv,
    reconcile_metrics,
    run_all,
    run_new,
    store_metrics,
)
from tallymatch.sinks import create_tables, export_metrics_tsv, write_metrics
from tallymatch.sources import read_metrics_tsv, read_stats_csv, read_strict_tsv
from tallymatch.sources.tables import table_identity

getcontext().prec = 200
DT, AT = "2026-01-01", datetime(2026, 1, 1)
SPEC = TableSpec.of("shop.b", (), {"y": "decimal(16,2)"})
RELAXED = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.fixture
def frame(spark):
    return {"shop.b": spark.createDataFrame([("5",)], "y string")}


# --- exact numbers ----------------------------------------------------------

DIGITS = st.text(alphabet="0123456789", max_size=45)
NUMBERS = st.builds(
    lambda sign, whole, point, part, exponent: f"{sign}{whole or '0'}{point}{part if point else ''}{exponent}",
    st.sampled_from(["", "-", "+"]),
    DIGITS,
    st.sampled_from(["", "."]),
    DIGITS,
    st.sampled_from(["", "e3", "E-7", "e+12", "E0"]),
)


@RELAXED
@given(st.lists(st.tuples(NUMBERS, NUMBERS), min_size=20, max_size=40))
def test_canonical_numbers(spark, pairs):
    pairs += [(a, a.replace("e3", "E+03")) for a, _ in pairs] + [("-0", "0.00e9"), ("1e2", "100"), (".5", "0.50"), ("7.", "7")]
    df = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", canonical(F.col("a")).alias("c"), plain(F.col("a")).alias("p"),
        metric_status(F.col("a"), F.col("b"), ANY_SCALE).alias("status"),
        metric_diff(F.col("a"), F.col("b"), ANY_SCALE).alias("diff"),
    )
    for r in df.collect():
        a, b = Decimal(r.a), Decimal(r.b)
        assert Decimal(r.c) == a and Decimal(r.p) == a and "E" not in r.p, r
        assert r.status == ("PASS" if a == b else "FAIL"), r
        assert r.diff is None or Decimal(r.diff) == b - a, r
        if max(len(r.a), len(r.b)) <= 12 and "e+12" not in r.a + r.b:
            assert r.diff is not None, r


def test_what_is_no_number(spark):
    texts = ["", " ", ".", "+", "e5", "1e", "1,5", "0x1", "NaN", "Infinity", "1 2", "١", "1e9999999999", None]
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    assert rows(df.select(canonical(F.col("a")))) == [(None,)] * len(texts)
    spaced = spark.createDataFrame([(" 1.50\n",)], "a string")
    assert rows(spaced.select(canonical(F.col("a")), plain(F.col("a")))) == [("15E-1", "1.5")]


def test_difference_of_many_digits(spark):
    big = "9" * 37
    cases = [(big, "1" + "0" * 36), ("0." + "1" * 36, "0"), ("1", "1e40"), ("1.10", "1.1"), ("0.001", "1000")]
    df = spark.createDataFrame(cases, "new string, old string")
    got = [r[0] for r in df.select(exact_difference(F.col("new"), F.col("old"))).collect()]
    assert got == [str(int(big) - 10**36), "0." + "1" * 36, None, "0", "-999.999"]


# --- runs and slices --------------------------------------------------------


def test_run_of_another_date_leaves_the_slice_and_no_verdict(spark, frame, folder):
    target = f"{folder}/s"
    for cluster in ("old", "new"):
        store_metrics(spark, [SPEC], DT, cluster, target, tables=frame, overwrite=True)
    assert rows(compare_stored(spark, target, DT), "status") == [("PASS",)] * 2
    foreign = ["select 'shop.b' table_name, '2026-01-02' data_dt, 9 as row_count"]
    with pytest.raises(Exception, match="row of date 2026-01-01 expected, found 2026-01-02"):
        run_new(spark, foreign, DT, target, overwrite=True)
    for found in (compare_stored(spark, target, DT), compare_stored(spark, target), compare_stored(spark, target, proven=True)):
        assert rows(found, "status", "diff", "diff_num") == [("NOT_MEASURED", None, None)] * 2
        assert {r.reason for r in found.collect()} == {"run not finished: new"}
    run_new(spark, [SPEC], DT, target, tables=frame, overwrite=True)
    assert rows(compare_stored(spark, target, DT, proven=True), "status") == [("PASS",)] * 2


def test_text_of_another_date_or_cluster(spark, frame, folder):
    measure_to_tsv(spark, [SPEC], "2025-12-31", "old", f"{folder}/old", tables=frame)
    measure_to_tsv(spark, [SPEC], DT, "third", f"{folder}/third", tables=frame)
    with pytest.raises(Exception, match="row of date 2026-01-01 expected"):
        run_all(spark, f"{folder}/old", [SPEC], DT, f"{folder}/s", tables=frame, overwrite=True)
    with pytest.raises(Exception, match="row of cluster old expected, found third"):
        ingest_old(spark, f"{folder}/third", f"{folder}/s")
    assert ingest_old(spark, f"{folder}/third", f"{folder}/s", cluster="third") == 2


def test_only_rows_of_the_newest_run_are_judged(spark, frame, folder):
    """An older run appended another table; today's did not measure it."""
    target = f"{folder}/s"
    other = TableSpec.of("shop.c", (), {"y": "decimal(16,2)"})
    both = {**frame, "shop.c": frame["shop.b"]}
    for cluster in ("old", "new"):
        store_metrics(spark, [SPEC, other], DT, cluster, target, tables=both, computed_at=AT)
    store_metrics(spark, [SPEC], DT, "new", target, tables=frame)
    assert rows(compare_stored(spark, target, DT), "status") == [("PASS",)] * 4
    assert rows(compare_stored(spark, target, DT, proven=True), "table_name", "status") == (
        [("shop.b", "PASS")] * 2 + [("shop.c", "MISSING_NEW")] * 2
    )


def test_skipped_tables_are_not_missing(spark, frame, folder):
    target = f"{folder}/s"
    broken = TableSpec.of("shop.broken", (), {"y": "decimal(16,2)"})
    fine = {**frame, "shop.broken": frame["shop.b"]}
    bad = {**frame, "shop.broken": frame["shop.b"].withColumn("y", F.raise_error(F.lit("disk gone")).cast("string"))}
    store_metrics(spark, [SPEC, broken], DT, "old", target, tables=fine)
    assert list(store_metrics(spark, [SPEC, broken], DT, "new", target, tables=bad, on_error="skip")) == ["shop.broken"]
    found = {r.table_name: r for r in compare_stored(spark, target, DT, proven=True).collect()}
    assert found["shop.b"].status == "PASS" and found["shop.broken"].status == "NOT_MEASURED"
    assert found["shop.broken"].old_value and "disk gone" in found["shop.broken"].reason


def test_planned_metrics_of_an_unfinished_run_are_rows(spark, frame, folder):
    bad = {"shop.b": frame["shop.b"].withColumn("y", F.raise_error(F.lit("disk gone")).cast("string"))}
    with pytest.raises(Exception, match="disk gone"):
        store_metrics(spark, [SPEC], DT, "new", f"{folder}/s", tables=bad)
    store_metrics(spark, [TableSpec.of("shop.z")], DT, "old", f"{folder}/s", tables={"shop.z": frame["shop.b"]})
    found = compare_stored(spark, f"{folder}/s", DT, proven=True)
    assert rows(found, "table_name", "metric_name", "status") == [
        ("shop.b", "row_count", "NOT_MEASURED"), ("shop.b", "y_sum", "NOT_MEASURED"), ("shop.z", "row_count", "NOT_MEASURED"),
    ]


def test_slices_without_manifest(spark, frame, folder):
    """Rows that were written without a run are compared as before, but prove nothing."""
    rows_ = [(c, "t", "", "m", "1", AT, DT) for c in ("old", "new")]
    write_metrics(spark.createDataFrame(rows_, M.METRIC_SCHEMA), f"{folder}/s")
    assert rows(compare_stored(spark, f"{folder}/s", DT), "status") == [("PASS",)]
    assert rows(compare_stored(spark, f"{folder}/s", DT, proven=True), "status") == [("NOT_MEASURED",)]


def test_manifest_of_a_table(spark, frame):
    summary, _ = create_tables(spark, "tm_manifest")
    run_new(spark, [SPEC], DT, summary, tables=frame, overwrite=True)
    entries = read_manifest(spark, summary)
    assert entries.schema.fieldNames() == M.MANIFEST_SCHEMA.fieldNames()
    assert rows(entries, "state", "table_name", "rows_written") == [
        ("done", None, None), ("measured", "shop.b", 2), ("planned", "shop.b", None), ("started", None, None),
    ]
    assert rows(entries.where("state = 'planned'"), "expected") == [(["row_count", "y_sum"],)]
    spark.sql("DROP DATABASE tm_manifest CASCADE")


# --- expected metrics and identities ----------------------------------------


def test_expected_grid(spark, frame):
    specs = [SPEC, TableSpec.of("shop.gone", ["dt"], {"x": "decimal(9,2)"})]
    result = reconcile_metrics(spark, specs, DT, frame, {})
    assert rows(result, "table_name", "metric_name", "status", "reason") == [
        ("shop.b", "row_count", "MISSING_NEW", "new: no such table"),
        ("shop.b", "y_sum", "MISSING_NEW", "new: no such table"),
        ("shop.gone", "row_count", "NOT_MEASURED", "old: no such table; new: no such table"),
        ("shop.gone", "x_sum", "NOT_MEASURED", "old: no such table; new: no such table"),
    ]


def test_identity(spark, folder):
    for database in ("tm_one", "tm_two"):
        spark.sql(f"CREATE DATABASE {database}")
    spark.sql(f"CREATE TABLE tm_one.t (y STRING) USING parquet LOCATION '{folder}/t'")
    spark.sql(f"CREATE TABLE tm_two.t (y STRING) USING parquet LOCATION '{folder}/t'")
    spark.sql(f"CREATE TABLE tm_two.u (y STRING) USING parquet LOCATION '{folder}/u'")
    try:
        assert table_identity(spark, "TM_ONE.T") == table_identity(spark, "tm_one.t")
        assert table_identity(spark, "tm_one.t").location.endswith("/t")
        specs = [TableSpec.of("x.t", (), {"y": "decimal(9,2)"})]
        mapped = {"x.t": spark.table("tm_one.t")}
        for how in (
            dict(old_namespace="tm_one", new_namespace="TM_ONE"),
            dict(old_namespace="tm_one", new_namespace="tm_two"),
            dict(old_namespace="tm_one", new_tables=mapped),
            dict(new_namespace="tm_one", old_tables=mapped),
        ):
            with pytest.raises(ValueError, match="same table"):
                reconcile_metrics(spark, specs, DT, **how)
        other = {"x.t": spark.table("tm_two.u")}
        assert reconcile_metrics(spark, specs, DT, old_namespace="tm_one", new_tables=other).count() == 2
    finally:
        for database in ("tm_one", "tm_two"):
            spark.sql(f"DROP DATABASE {database} CASCADE")


# --- text -------------------------------------------------------------------


@RELAXED
@given(st.lists(st.text(alphabet="\\\t\n\rNUL tn\"'é", max_size=12), min_size=5, max_size=30))
def test_escapes(spark, texts):
    texts += ["NULL", "\\NULL", "\\\\NULL", "\\", "\\n", "\\\\n", "\n\\", "", "null"]
    df = spark.createDataFrame([(t,) for t in texts], "a string").select("a", escaped(F.col("a")).alias("e"))
    for r in df.select("a", "e", unescaped(F.col("e")).alias("b")).collect():
        assert r.b == r.a and not set(r.e) & set("\t\n\r") and r.e != "NULL"


def test_metrics_of_any_text(spark, folder):
    values = ["NULL", None, "", "a\tb\nc\\d\re", '"quoted"', "\\N", " lead"]
    data = [("old", "t\n1", "", f"m{k}", v, AT, DT) for k, v in enumerate(values)]
    long = spark.createDataFrame(data, M.METRIC_SCHEMA)
    assert export_metrics_tsv(long, f"{folder}/t", any_text=True) == len(values)
    assert len(spark.read.text(f"{folder}/t").collect()) == len(values)
    assert rows(read_metrics_tsv(spark, f"{folder}/t", any_text=True)) == rows(long)


def _save(folder, name, *lines):
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_headers_of_a_folder(spark, folder):
    _save(folder, "a.csv", "table_name,num_rows,num_files", '"x,1",1,2', "y,3,4")
    _save(folder, "b.csv", 'num_files,"num_rows",other,table_name', "2,1,?,z", "table_name,num_rows,?,num_files")
    found = read_stats_csv(spark, folder)
    want = [("num_files", "num_rows", "table_name"), ("x,1", "1", "2"), ("y", "3", "4"), ("z", "1", "2")]
    assert rows(found, "table_name", "num_rows", "num_files") == want
    legacy = read_stats_csv(spark, folder, legacy_stats_layout=True)
    assert rows(legacy, "table_name", "num_rows")[1:] == [("x,1", "2"), ("y", "4"), ("z", "2")]
    ordered = read_stats_csv(spark, folder, row_order=True).where("table_name in ('x,1', 'y')").orderBy("row_order")
    assert [r.table_name for r in ordered.collect()] == ["x,1", "y"]


def test_absent_paths_beside_others(spark, folder):
    _save(folder, "a.csv", "table_name,num_rows", "x,1")
    paths = [f"{folder}/a.csv", f"{folder}/none.csv"]
    assert rows(read_stats_csv(spark, paths, missing_ok=True), "table_name", "num_rows") == [("x", "1")]
    assert read_stats_csv(spark, paths[1:], missing_ok=True, row_order=True).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_stats_csv(spark, paths)


def test_first_lines_go_by_their_place(spark, folder):
    _save(folder, "a.tsv", "p\tq", "1\t2", "a\tb")
    _save(folder, "b.tsv", "only one field", "\t", "a\tb")
    found = read_strict_tsv(spark, folder, ["a", "b"], header=True)
    assert rows(found) == [("", ""), ("1", "2"), ("a", "b"), ("a", "b")]


def test_entries_of_many_tables_are_not_written_by_one_task(spark, tmp_path):
    rows = spark.range(60_000).selectExpr(
        "'old' as cluster", "'2026-01-01' as data_dt", "concat('t_', id) as table_name", "timestamp'2026-01-01' as computed_at"
    )
    small = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    for name in small:
        spark.conf.set(name, "64k")
    try:
        record_slices(rows.repartition(6), f"{tmp_path}/summary")
    finally:
        for name in small:
            spark.conf.unset(name)
    entries = read_manifest(spark, f"{tmp_path}/summary")
    assert entries.count() == 60_002 and len(entries.inputFiles()) > 1


def test_a_number_is_matched_once(spark):
    plan = spark.range(1).select(canonical(F.col("id").cast("string")))._jdf.queryExecution().analyzed().toString()
    assert "regexp_extract" not in plan and "RLIKE" not in plan
    texts = ["1,2,3,4", ",,,", "-,1,,", " +1 ", "\n-0.50e+2\t", "1 2", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "a string").select(canonical(F.col("a")).alias("c"))
    assert [r.c for r in df.collect()] == [None, None, None, "1E0", "-5E1", None, None, None]
