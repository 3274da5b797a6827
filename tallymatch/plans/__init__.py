"""The composite jobs: numeric reconciliation and row-count reconciliation."""

from .numsum import (
    MetricRun,
    collect_metrics,
    collect_metrics_by_partition,
    collect_metrics_sql,
    compare_stored,
    ingest_old,
    measure_to_tsv,
    reconcile_metrics,
    reconcile_partitions,
    run_all,
    run_new,
    store_metrics,
)
from .rowcount import (
    compare_stats_files,
    publish_comparison,
    reconcile_catalogs,
    store_catalog_stats,
)

__all__ = [
    "MetricRun",
    "collect_metrics",
    "collect_metrics_by_partition",
    "collect_metrics_sql",
    "compare_stats_files",
    "compare_stored",
    "ingest_old",
    "measure_to_tsv",
    "publish_comparison",
    "reconcile_catalogs",
    "reconcile_metrics",
    "reconcile_partitions",
    "run_all",
    "run_new",
    "store_catalog_stats",
    "store_metrics",
]
