"""Readers.  Every one returns a DataFrame; nothing is pulled to the driver."""

from .files import read_metrics_tsv, read_stats_csv, read_strict_tsv
from .metastore import read_metastore_jdbc
from .metric_sql import bind_date, metric_sql_frame
from .tables import file_metastore, open_table, read_slices

__all__ = [
    "bind_date",
    "file_metastore",
    "metric_sql_frame",
    "open_table",
    "read_metastore_jdbc",
    "read_metrics_tsv",
    "read_slices",
    "read_stats_csv",
    "read_strict_tsv",
]
