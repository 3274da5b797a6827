"""Verdicts: status, difference and reason of a compared pair."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import model as M
from .decimals import canonical, exact_difference, fraction_digits
from .text import blank_to_null

#: As ``exact_scale``: numbers of any length are compared digit by digit.
ANY_SCALE = "any"


@dataclass(frozen=True)
class ReasonText:
    """Wording of the reason column."""

    old_missing: str
    new_missing: str
    mismatch: str  # put before "<old> vs <new>"
    not_measured: str = "not measured"


ENGLISH = ReasonText("missing in old cluster", "missing in new cluster", "values differ: ")

# The wording that existing consumers of the result may match on.
ORIGINAL = ReasonText("旧集群缺失", "新集群缺失", "值不一致: ")


def _missing(c: Column) -> Column:
    return blank_to_null(c).isNull()


def numeric(c: Column, exact_scale: int | None = None) -> Column:
    """Text to number, NULL when it is not one.

    By default a DOUBLE, which hides differences beyond 2^53.  With
    ``exact_scale`` a DECIMAL(38, exact_scale), which does not; text that needs more
    digits behind the point is no such number, so it never equals another by rounding.
    """
    if exact_scale is None:
        return c.try_cast("double")
    return F.when(fraction_digits(c) <= exact_scale, c.try_cast(f"decimal(38,{exact_scale})"))


def same_number(old: Column, new: Column, exact_scale: int | str | None = None) -> Column:
    """Whether two texts are equal numbers; NULL if one is no number."""
    if exact_scale == ANY_SCALE:
        return canonical(old) == canonical(new)
    return numeric(old, exact_scale) == numeric(new, exact_scale)


def metric_status(old: Column, new: Column, exact_scale: int | str | None = None) -> Column:
    """First match wins: MISSING_OLD, MISSING_NEW, PASS if equal as numbers, else FAIL."""
    return (
        F.when(_missing(old), M.MISSING_OLD)
        .when(_missing(new), M.MISSING_NEW)
        .when(same_number(old, new, exact_scale), M.PASS)
        .otherwise(M.FAIL)
    )


def metric_diff(old: Column, new: Column, exact_scale: int | str | None = None) -> Column:
    """new - old; NULL if a side is missing or not numeric, or if no DECIMAL holds it.

    A number, but plain text with ``ANY_SCALE``, as numbers of that mode have no common type.
    """
    if exact_scale == ANY_SCALE:
        return exact_difference(new, old)
    return F.try_subtract(numeric(new, exact_scale), numeric(old, exact_scale))


def metric_reason(status: Column, old: Column, new: Column, wording: ReasonText = ENGLISH) -> Column:
    """Text for people; NULL on PASS."""
    return (
        F.when(status == M.MISSING_OLD, wording.old_missing)
        .when(status == M.MISSING_NEW, wording.new_missing)
        .when(status == M.FAIL, F.concat(F.lit(wording.mismatch), old, F.lit(" vs "), new))
        .when(status == M.NOT_MEASURED, wording.not_measured)
    )


def stats_status(
    in_old: Column, in_new: Column, measures: Iterable[tuple[Column, Column]]
) -> Column:
    """Wide status from presence first, then from any differing measure."""
    differs = reduce(Column.__or__, (~o.eqNullSafe(n) for o, n in measures))
    return (
        F.when(~in_new, M.ONLY_IN_OLD)
        .when(~in_old, M.ONLY_IN_NEW)
        .when(differs, M.DIFFERENCE)
        .otherwise(M.EQUAL)
    )
