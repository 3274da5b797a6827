"""DataFrame-to-DataFrame operators."""

from .catalog import Metastore, catalog_stats, params_wide, partition_stats, table_level_stats
from .compare import (
    STATS_KEY,
    TABLE_KEY,
    compare_metric_slices,
    compare_metrics,
    compare_partitions,
    compare_row_counts,
    compare_stats_wide,
    preview,
)
from .metrics import (
    metric_columns,
    metric_frame,
    metrics_by_partition,
    on_date,
    spec_from_frame,
)
from .pairing import latest_by_key, latest_run, pair_sides, pair_tagged
from .reshape import (
    as_metric_rows,
    empty_metrics,
    metric_names,
    normalise_metrics,
    union_all,
    unpivot_metrics,
)
from .table_stats import table_stats

__all__ = [
    "Metastore",
    "STATS_KEY",
    "TABLE_KEY",
    "as_metric_rows",
    "catalog_stats",
    "compare_metric_slices",
    "compare_metrics",
    "compare_partitions",
    "compare_row_counts",
    "compare_stats_wide",
    "empty_metrics",
    "latest_by_key",
    "latest_run",
    "metric_columns",
    "metric_frame",
    "metric_names",
    "metrics_by_partition",
    "normalise_metrics",
    "on_date",
    "pair_sides",
    "pair_tagged",
    "params_wide",
    "partition_stats",
    "preview",
    "spec_from_frame",
    "table_level_stats",
    "table_stats",
    "union_all",
    "unpivot_metrics",
]
