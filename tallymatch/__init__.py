"""tallymatch: prove that two snapshots of a warehouse agree, with Spark.

Count rows and sum decimals of many tables in one scan each, put the results in
long form, and reconcile two snapshots with exact rules for missing, equal and
different.
"""

from .functions import ENGLISH, ORIGINAL, ReasonText
from .model import Field, TableSpec, load_specs, specs_from_json
from .operators import *  # noqa: F403
from .operators import __all__ as _operators
from .plans import *  # noqa: F403
from .plans import __all__ as _plans
from .session import recommended_conf, shared_folder
from .sinks import create_tables, export_metrics_tsv, replace_comparison, write_metrics
from .sources import *  # noqa: F403
from .sources import __all__ as _sources

__all__ = [
    "ENGLISH",
    "Field",
    "ORIGINAL",
    "ReasonText",
    "TableSpec",
    "create_tables",
    "export_metrics_tsv",
    "load_specs",
    "recommended_conf",
    "replace_comparison",
    "shared_folder",
    "specs_from_json",
    "write_metrics",
    *_operators,
    *_plans,
    *_sources,
]
