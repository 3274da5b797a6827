from __future__ import annotations

import itertools
import random
from datetime import datetime

import pytest
from helpers import plan_of, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymatch.functions import ORIGINAL
from tallymatch.model import METRIC_SCHEMA
from tallymatch.operators import compare_metric_slices, compare_metrics

AT = datetime(2026, 1, 1)
DT = "2026-01-01"


def long(spark, items, cluster="old", part="dt"):
    """Metric rows from {name: value}, or from (name, value, computed_at) tuples."""
    if isinstance(items, dict):
        items = [(k, v, AT) for k, v in items.items()]
    data = [(cluster, "t", part, name, value, at, DT) for name, value, at in items]
    return spark.createDataFrame(data, METRIC_SCHEMA)


VALUES = {"five": "5", "blank": "", "null": None, "word": "NULL", "text": "abc"}


def expected(old, new, normalise):
    """The rules in plain words, independent of Spark."""

    def missing(v):
        return v in ("", None) or (normalise and v == "NULL")

    if missing(old):
        return "MISSING_OLD"
    if missing(new):
        return "MISSING_NEW"
    return "PASS" if old == new == "5" else "FAIL"


@pytest.mark.parametrize("normalise", [True, False])
def test_status_matrix(spark, normalise):
    cells = {f"{a}-{b}": (VALUES[a], VALUES[b]) for a, b in itertools.product(VALUES, VALUES)}
    old = long(spark, {k: v[0] for k, v in cells.items()})
    new = long(spark, {k: v[1] for k, v in cells.items()}, "new")
    got = {r.metric_name: r for r in compare_metrics(old, new, normalise=normalise).collect()}
    assert len(got) == 25
    for name, (a, b) in cells.items():
        row = got[name]
        assert row.status == expected(a, b, normalise), name
        assert row.diff == ("0.0" if a == b == "5" else None), name
        assert (row.reason is None) == (row.status == "PASS"), name
    assert got["text-five"].reason == "values differ: abc vs 5"


def test_columns_and_reason_wording(spark):
    old = long(spark, {"a": "1", "b": "1", "c": None, "d": "12345678"})
    new = long(spark, {"a": "3", "b": None, "c": "1", "d": "12345678"}, "new")
    result = compare_metrics(old, new, wording=ORIGINAL)
    assert result.columns == [
        "table_name", "partition_col", "metric_name", "data_dt", "old_value", "new_value",
        "diff", "status", "reason", "diff_num",
    ]
    assert rows(result, "metric_name", "diff", "status", "reason") == [
        ("a", "2.0", "FAIL", "值不一致: 1 vs 3"),
        ("b", None, "MISSING_NEW", "新集群缺失"),
        ("c", None, "MISSING_OLD", "旧集群缺失"),
        ("d", "0.0", "PASS", None),
    ]


def test_unpartitioned_tables_match_and_keys_survive(spark):
    old = long(spark, {"a": "1", "gone": "2"}, part="")
    new = long(spark, {"a": "1", "fresh": "3"}, "new", part=None)
    assert rows(compare_metrics(old, new), "table_name", "partition_col", "metric_name", "status") == [
        ("t", None, "a", "PASS"), ("t", None, "fresh", "MISSING_OLD"), ("t", None, "gone", "MISSING_NEW"),
    ]


def test_newest_run_wins(spark):
    old = long(spark, {"a": "1"})
    runs = [("a", "1", datetime(2026, 1, 3)), ("a", "9", datetime(2026, 1, 2)), ("a", "8", None)]
    assert rows(compare_metrics(old, long(spark, runs, "new")), "new_value", "status") == [("1", "PASS")]


def test_newest_run_wins_even_if_it_found_nothing(spark):
    runs = [("a", None, datetime(2026, 1, 3)), ("a", "9", datetime(2026, 1, 2))]
    result = compare_metrics(long(spark, {"a": "9"}), long(spark, runs, "new"))
    assert rows(result, "new_value", "status") == [(None, "MISSING_NEW")]


def test_exact_comparison(spark):
    old, new = long(spark, {"a": "90071992547409930.01"}), long(spark, {"a": "90071992547409930.02"}, "new")
    assert rows(compare_metrics(old, new), "status") == [("PASS",)]
    assert rows(compare_metrics(old, new, exact_scale=2), "status", "diff") == [("FAIL", "0.01")]


def test_slices_of_one_frame(spark):
    summary = long(spark, {"a": "1"}).unionByName(long(spark, {"a": "1"}, "new"))
    summary = summary.unionByName(long(spark, {"a": "7"}, "third"))
    summary = summary.unionByName(summary.withColumn("data_dt", F.lit("2020-01-01")))
    assert rows(compare_metric_slices(summary, DT), "data_dt", "status") == [(DT, "PASS")]
    assert compare_metric_slices(summary).count() == 2
    assert rows(compare_metric_slices(summary, DT, old="third"), "status") == [("FAIL",)]


def test_one_shuffle_and_no_join(spark):
    old, new = long(spark, {"a": "1"}), long(spark, {"a": "1"}, "new")
    plan = plan_of(compare_metrics(old, new))
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Python" not in plan


NAMES = st.sampled_from([f"m{i}" for i in range(8)])
NUMBERS = st.integers(-10**12, 10**12).map(lambda n: f"{n / 100:.2f}")
SIDES = st.dictionaries(NAMES, NUMBERS, min_size=1)
RELAXED = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@RELAXED
@given(side=SIDES)
def test_same_against_same_passes(spark, side):
    result = compare_metrics(long(spark, side), long(spark, side, "new"))
    assert rows(result, "metric_name", "status") == sorted((k, "PASS") for k in side)


@RELAXED
@given(a=SIDES, b=SIDES)
def test_swapping_sides_swaps_the_verdict(spark, a, b):
    swap = {"MISSING_OLD": "MISSING_NEW", "MISSING_NEW": "MISSING_OLD", "PASS": "PASS", "FAIL": "FAIL"}

    def verdicts(x, y):
        result = compare_metrics(long(spark, x), long(spark, y, "new"))
        return {r.metric_name: (r.status, r.diff_num) for r in result.collect()}

    there, back = verdicts(a, b), verdicts(b, a)
    assert set(there) == set(a) | set(b)
    for name, (status, diff) in there.items():
        assert back[name][0] == swap[status]
        assert diff is None or back[name][1] == -diff


@RELAXED
@given(side=SIDES, data=st.data())
def test_dropped_keys_are_reported_missing(spark, side, data):
    lost = data.draw(st.sets(st.sampled_from(sorted(side))))
    kept = {k: v for k, v in side.items() if k not in lost}
    result = compare_metrics(long(spark, side), long(spark, kept, "new"))
    found = {r.metric_name for r in result.where("status = 'MISSING_NEW'").collect()}
    assert found == lost and result.count() == len(side)


def test_result_does_not_depend_on_row_order(spark):
    items = [("a", str(i % 7), datetime(2026, 1, 1 + i % 3)) for i in range(60)]
    seen = set()
    for seed in range(3):
        random.Random(seed).shuffle(items)
        side = long(spark, items).repartition(5)
        seen.add(rows(compare_metrics(side, long(spark, {"a": "0"}, "new")), "old_value")[0])
    assert len(seen) == 1


def test_exact_scale_does_not_round(spark):
    from tallymatch.functions.verdict import metric_status

    pairs = [("1.0001", "1.0002"), ("1.00", "1.000"), ("1.10", "1.1"), ("1.005", "1.005"), ("7", "7.0")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = {r[0]: r[1] for r in df.select("a", metric_status(F.col("a"), F.col("b"), 2)).collect()}
    assert got == {"1.0001": "FAIL", "1.00": "PASS", "1.10": "PASS", "1.005": "FAIL", "7": "PASS"}
