"""Number rules for row counts.  User data never raises: bad text becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_long(c: Column) -> Column:
    """Whole number or NULL: blank, ``abc`` and ``1.5`` are all NULL (F1)."""
    return c.try_cast("bigint")


def or_zero(c: Column) -> Column:
    """A missing count counts as zero in arithmetic (F2)."""
    return F.coalesce(c, F.lit(0).cast("bigint"))


def row_count_diff(old: Column, new: Column) -> Column:
    """new - old with a missing side as zero (F3); NULL rather than an error on overflow."""
    return F.try_subtract(or_zero(new), or_zero(old))
