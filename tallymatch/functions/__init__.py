"""Row-level rules as column expressions; all of them run inside codegen."""

from .decimals import canonical, exact_difference, fraction_digits, plain
from .numbers import or_zero, row_count_diff, to_long
from .text import (
    as_missing,
    blank_to_null,
    dashed_date,
    dashed_date_text,
    escaped,
    name_col,
    quoted,
    unescaped,
)
from .verdict import (
    ANY_SCALE,
    ENGLISH,
    ORIGINAL,
    ReasonText,
    metric_diff,
    metric_reason,
    metric_status,
    numeric,
    same_number,
    stats_status,
)

__all__ = [
    "ANY_SCALE",
    "ENGLISH",
    "ORIGINAL",
    "ReasonText",
    "as_missing",
    "blank_to_null",
    "canonical",
    "dashed_date",
    "dashed_date_text",
    "escaped",
    "exact_difference",
    "fraction_digits",
    "metric_diff",
    "metric_reason",
    "metric_status",
    "name_col",
    "numeric",
    "or_zero",
    "plain",
    "quoted",
    "row_count_diff",
    "same_number",
    "stats_status",
    "to_long",
    "unescaped",
]
