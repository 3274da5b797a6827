"""Row-count reconciliation: catalog statistics per cluster, compared and published."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import model as M
from ..operators.catalog import Metastore, catalog_stats
from ..operators.compare import STATS_KEY, compare_row_counts, compare_stats_wide
from ..sinks import export_comparison_csv, export_stats_csv, replace_comparison
from ..sources.files import read_stats_csv
from ..sources.tables import read_slices


def store_catalog_stats(
    store: Metastore, data_dt: str, path: str, *, either_spelling: bool = False
) -> int:
    """Collect the statistics of one cluster into a CSV folder (E7).  Returns rows written."""
    return export_stats_csv(catalog_stats(store, data_dt, either_spelling=either_spelling, stage=True), path)


def compare_stats_files(
    spark: SparkSession,
    old_csv: str,
    new_csv: str,
    *,
    key: Sequence[str] = STATS_KEY,
    legacy_stats_layout: bool = False,
    wide: bool = False,
    missing_ok: bool = False,
) -> DataFrame:
    """Compare two statistics files (E8), or all statistics side by side.

    Where a key repeats, the row last in its file wins.  With ``missing_ok`` an
    absent file has no rows, so all of the other's keys are missing there.
    """
    sides = [
        read_stats_csv(
            spark, p, legacy_stats_layout=legacy_stats_layout, row_order=True, missing_ok=missing_ok
        )
        for p in (old_csv, new_csv)
    ]
    if wide and tuple(key) != tuple(STATS_KEY):
        raise ValueError("the wide comparison has a key of its own")
    if wide:
        return compare_stats_wide(*sides, order=("row_order",))
    return compare_row_counts(*sides, key=key, order=("row_order",))


def reconcile_catalogs(
    old: Metastore, new: Metastore, data_dt: str, *, wide: bool = False, stage: bool = True, **how
) -> DataFrame:
    """Collect both catalogs and compare them.

    The date's partitions of either side are staged first (see ``partition_stats``); with
    ``stage=False`` everything is one lazy plan, which reads PARTITIONS twice a side.
    """
    sides = [catalog_stats(store, data_dt, stage=stage) for store in (old, new)]
    if wide:
        return compare_stats_wide(*sides, **{"unique_keys": not how.get("order"), **how})
    return compare_row_counts(*sides, **how)


def publish_comparison(
    comparison: DataFrame,
    target: str,
    data_dt: str,
    *,
    etl_tm: Column | None = None,
    csv_path: str | None = None,
) -> DataFrame:
    """Replace the date in the result table and return its stored rows.

    A CSV is exported from the stored rows, so the comparison runs once.
    """
    replace_comparison(comparison, target, data_dt, etl_tm=etl_tm)
    stored = read_slices(comparison.sparkSession, target, M.COMPARISON_TABLE_SCHEMA).where(
        F.col("data_dt") == data_dt
    )
    if csv_path is not None:
        export_comparison_csv(stored, csv_path)
    return stored
