"""Comparisons: long metrics, row counts, and all four table statistics side by side."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import model as M
from ..functions import (
    ENGLISH,
    ReasonText,
    blank_to_null,
    metric_diff,
    metric_reason,
    metric_status,
    row_count_diff,
    stats_status,
    to_long,
)
from .metrics import partition_kind, partition_totals
from .pairing import IS_OLD, pair_sides, pair_tagged, tag_sides
from .reshape import normalise_metrics, union_all

_METRIC_KEYS = ("table_name", "partition_col", "metric_name", "data_dt")
STATS_KEY = ("database_name", "table_name", "partition_name")
TABLE_KEY = ("database_name", "table_name")


def _judge(
    pairs: DataFrame, exact_scale: int | str | None, wording: ReasonText, measured: Column | None = None
) -> DataFrame:
    """Verdict on pairs of values: keys, ``old_value`` and ``new_value`` come in.

    Where ``measured`` is given and false, nothing is judged.
    """
    old, new = F.col("old_value"), F.col("new_value")
    diff = metric_diff(old, new, exact_scale)
    status = metric_status(old, new, exact_scale)
    if measured is not None:
        status = F.when(~measured, M.NOT_MEASURED).otherwise(status)
        diff = F.when(measured, diff)
    return pairs.withColumn("status", status).select(
        *_METRIC_KEYS,
        "old_value",
        "new_value",
        diff.cast("string").alias("diff"),
        "status",
        metric_reason(F.col("status"), old, new, wording).alias("reason"),
        diff.cast("double").alias("diff_num"),
    )


def _compare(
    rows: DataFrame,
    is_old: Column,
    normalise: bool,
    exact_scale: int | str | None,
    wording: ReasonText,
    expected: DataFrame | None = None,
) -> DataFrame:
    """Match tagged rows and judge the pairs.

    ``expected`` keys belong to neither side.  They pass through the same grouping, so that what
    no side measured is a row too, at no further shuffle.
    """
    if expected is not None:
        rows = rows.unionByName(expected.select(*_METRIC_KEYS), allowMissingColumns=True)
    if normalise:
        rows = normalise_metrics(rows)
    pairs = pair_tagged(rows, is_old, _METRIC_KEYS, ("value",), ("computed_at",))
    measured = None if expected is None else F.col("measured")
    values = pairs.selectExpr(
        *_METRIC_KEYS, "old.value as old_value", "new.value as new_value", "old is not null or new is not null as measured"
    )
    return _judge(values, exact_scale, wording, measured)


def expected_metrics(spark: SparkSession, specs: Sequence[M.TableSpec], data_dt: str) -> DataFrame:
    """The grid of what is to be measured for a date: a row per table and metric of the specs."""
    grid = [(s.name, s.partition_col, metric, data_dt) for s in specs for metric in s.metrics]
    return spark.createDataFrame(grid, "table_name string, partition_col string, metric_name string, data_dt string")


def with_notes(compared: DataFrame, notes: Mapping[tuple[str, str], str], unmeasured: Iterable[tuple[str, str]] = ()) -> DataFrame:
    """Say why a side has no metrics of a table.

    ``notes`` hold reasons by (cluster, table), as many as there are specs at most.  Where the pair is also
    in ``unmeasured``, the table is there but could not be measured, so a missing value is no verdict on it.
    """
    if not notes:
        return compared
    failed = set(unmeasured)
    listed: dict[str, list] = {}
    for (cluster, name), text in notes.items():
        row = listed.setdefault(name, [name, None, None, False, False])
        at = 1 if cluster == M.OLD else 2
        row[at], row[at + 2] = text, (cluster, name) in failed
    spark = compared.sparkSession
    columns = "table_name string, _old string, _new string, _old_failed boolean, _new_failed boolean"
    joined = compared.join(F.broadcast(spark.createDataFrame(list(listed.values()), columns)), "table_name", "left")
    lost = (F.col("old_value").isNull() & F.col("_old_failed")) | (F.col("new_value").isNull() & F.col("_new_failed"))
    status = F.when(lost, M.NOT_MEASURED).otherwise(F.col("status"))
    said = [
        F.when(F.col(f"{side}_value").isNull(), F.concat(F.lit(f"{side}: "), F.col(f"_{side}"))) for side in (M.OLD, M.NEW)
    ]
    reason = F.when(
        (F.col("status") != M.PASS) & F.coalesce(*said).isNotNull(), F.concat_ws("; ", *said)
    ).otherwise(F.col("reason"))
    return joined.withColumns({"status": status, "reason": reason}).select(*compared.columns)


def not_judged(compared: DataFrame, slices: Iterable[tuple[str, str]]) -> DataFrame:
    """Take back the verdict on dates of which a cluster's (cluster, date) slice is not of a finished run."""
    by_date: dict[str, list[str]] = {}
    for cluster, data_dt in slices:
        by_date.setdefault(data_dt, []).append(cluster)
    if not by_date:
        return compared
    stale = F.col("data_dt").isin(*by_date)
    which = F.lit(None).cast("string")
    for data_dt, clusters in by_date.items():
        text = f"run not finished: {', '.join(sorted(clusters))}"
        which = F.when(F.col("data_dt") == data_dt, text).otherwise(which)
    return compared.withColumns(
        {
            "status": F.when(stale, M.NOT_MEASURED).otherwise(F.col("status")),
            "reason": F.when(stale, which).otherwise(F.col("reason")),
            "diff": F.when(~stale, F.col("diff")),
            "diff_num": F.when(~stale, F.col("diff_num")),
        }
    )


def _pair_dates(
    old: DataFrame, new: DataFrame, spec: M.TableSpec, dates: Sequence[str] | None
) -> DataFrame:
    """Values of every date and metric of one table on both sides.

    Totals are matched while still wide and typed: both sides are already
    distributed by date, so matching needs no shuffle of its own, and one row
    per date is sorted instead of one per date and metric.
    """
    kinds = partition_kind(old, spec), partition_kind(new, spec)
    if kinds[0] == kinds[1]:
        kind = kinds[0]
    elif T.DateType() in kinds and T.StringType() in kinds:
        kind = T.DateType()  # text is read as a date, in either spelling
    else:
        kind = T.StringType()
    sides = [partition_totals(df, spec, kind=kind, dates=dates) for df in (old, new)]
    pairs = pair_sides(*sides, ("data_dt",), spec.metrics)
    values = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric_name"),
                F.col(M.OLD)[m].cast("string").alias("old_value"),
                F.col(M.NEW)[m].cast("string").alias("new_value"),
            )
            for m in spec.metrics
        ]
    )
    return pairs.select(
        F.lit(spec.name).alias("table_name"),
        F.lit(spec.partition_col).alias("partition_col"),
        F.col("data_dt").cast("string").alias("data_dt"),
        F.inline(values),
    )


def compare_partitions(
    specs: Sequence[M.TableSpec],
    old: Mapping[str, DataFrame],
    new: Mapping[str, DataFrame],
    *,
    dates: Sequence[str] | None = None,
    exact_scale: int | str | None = None,
    wording: ReasonText = ENGLISH,
) -> DataFrame:
    """Measure partitioned tables on both sides and compare every (given) date.

    The same rows as comparing both sides' long metrics, with one shuffle per side.
    """
    pairs = union_all([_pair_dates(old[s.name], new[s.name], s, dates) for s in specs])
    return _judge(pairs, exact_scale, wording)


def compare_metrics(
    old: DataFrame,
    new: DataFrame,
    *,
    normalise: bool = True,
    exact_scale: int | str | None = None,
    wording: ReasonText = ENGLISH,
    expected: DataFrame | None = None,
) -> DataFrame:
    """Compare two long metric frames.

    Each side keeps the newest ``computed_at`` of a metric.  ``normalise`` folds
    the spellings of missing on both sides first; without it the word ``NULL``
    is a (non-numeric) value and a blank partition column is not a NULL one.
    With ``expected`` keys (see ``expected_metrics``) what neither side has is a row
    of status NOT_MEASURED.
    """
    rows = tag_sides(old, new, (*_METRIC_KEYS, "value", "computed_at"))
    return _compare(rows, F.col(IS_OLD), normalise, exact_scale, wording, expected)


def compare_metric_slices(
    summary: DataFrame,
    data_dt: str | None = None,
    *,
    old: str = M.OLD,
    new: str = M.NEW,
    normalise: bool = True,
    exact_scale: int | str | None = None,
    wording: ReasonText = ENGLISH,
    expected: DataFrame | None = None,
) -> DataFrame:
    """Compare two clusters kept in one summary frame, reading it once.

    The slice predicates sit below the match and only touch the partition
    columns of the stored table; without a date every date is compared.
    """
    rows = summary.where(F.col("cluster").isin(old, new))
    if data_dt is not None:
        rows = rows.where(F.col("data_dt") == data_dt)
    return _compare(rows, F.col("cluster") == old, normalise, exact_scale, wording, expected)


def _prefer_old(column: str) -> Column:
    """The old row's value if there is an old row, even when it is blank."""
    old, new = F.col(M.OLD), F.col(M.NEW)
    return F.when(old.isNotNull(), blank_to_null(old[column])).otherwise(
        blank_to_null(new[column])
    )


def compare_row_counts(
    old: DataFrame,
    new: DataFrame,
    *,
    key: Sequence[str] = STATS_KEY,
    order: Sequence[str] = (),
    measure: str = M.NUM_ROWS,
) -> DataFrame:
    """Row counts of two statistics frames with new - old.

    By default a table's partitions are compared one by one.  With
    ``key=TABLE_KEY`` the last row of a table wins, last by ``order`` (for files
    read with ``row_order=True`` that is ``("row_order",)``).
    """
    key = tuple(key)
    payload = [c for c in ("partition_name", "data_dt") if c not in key]

    def side(df: DataFrame) -> DataFrame:
        keyed = [
            (blank_to_null(F.col(k)) if k == "partition_name" else F.col(k)).alias(k) for k in key
        ]
        count = to_long(F.col(measure)).alias("row_count")
        return df.select(*keyed, *payload, *[o for o in order if o not in payload], count)

    pairs = pair_sides(side(old), side(new), key, [*payload, "row_count"], order)
    old_count, new_count = F.col(M.OLD)["row_count"], F.col(M.NEW)["row_count"]
    return pairs.select(
        "database_name",
        "table_name",
        ("partition_name" if "partition_name" in key else _prefer_old("partition_name").alias("partition_name")),
        F.lit(measure).alias("metric_name"),
        old_count.alias("old_value"),
        new_count.alias("new_value"),
        row_count_diff(old_count, new_count).alias("diff_value"),
        _prefer_old("data_dt").alias("data_dt"),
    )


def compare_stats_wide(
    old: DataFrame,
    new: DataFrame,
    *,
    measures: Sequence[str] = M.STAT_MEASURES,
    order: Sequence[str] = (),
    include_equal: bool = False,
    with_diff: bool = True,
    unique_keys: bool = False,
) -> DataFrame:
    """All statistics of a partition side by side.

    Differences are blank when a side is missing.  Agreeing rows are left out
    unless ``include_equal``; ``with_diff=False`` gives the short form.
    ``unique_keys`` says that neither side repeats a partition; then nothing is sorted.
    """

    def side(df: DataFrame) -> DataFrame:
        keyed = [
            (blank_to_null(F.col(k)) if k == "partition_name" else F.col(k)).alias(k)
            for k in STATS_KEY
        ]
        return df.select(*keyed, *order, *[to_long(F.col(m)).alias(m) for m in measures])

    pairs = pair_sides(side(old), side(new), STATS_KEY, measures, order, unique_keys=unique_keys)
    o, n = F.col(M.OLD), F.col(M.NEW)
    status = stats_status(o.isNotNull(), n.isNotNull(), [(o[m], n[m]) for m in measures])
    diffs = [F.try_subtract(n[m], o[m]).alias(f"diff_{m}") for m in measures]
    wide = pairs.select(
        *STATS_KEY,
        status.alias("status"),
        *[o[m].alias(f"old_{m}") for m in measures],
        *[n[m].alias(f"new_{m}") for m in measures],
        *(diffs if with_diff else []),
    )
    return wide if include_equal else wide.where(F.col("status") != M.EQUAL)


def preview(comparison: DataFrame, n: int = 10) -> DataFrame:
    """First rows of a comparison in key order, so two runs show the same rows (L1)."""
    keys = dict.fromkeys((*STATS_KEY, *_METRIC_KEYS))
    return comparison.orderBy(*[k for k in keys if k in comparison.columns]).limit(n)
