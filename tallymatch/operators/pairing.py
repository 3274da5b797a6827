"""Matching two sides by key, and keeping the last row of a key.

A full outer match of two sides is written as one aggregation over their tagged
union rather than as a join, for three reasons that matter on big inputs:

* one shuffle; de-duplicating both sides and then joining them takes two,
* partial aggregation shrinks a key that holds a third of all rows to one row
  per task before the shuffle, whereas the skew-join rule cannot split a full
  outer join,
* grouping treats NULL keys as equal, so unpartitioned tables match.

A side's struct is NULL exactly when the key is absent there.  A NULL *inside*
the struct is a NULL value of a row that exists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import name_col, quoted
from ..model import NEW, OLD

IS_OLD = "_is_old"


def _version(order: Sequence[str], payload: Sequence[str]) -> Column:
    """Ordering columns first: the greatest version of a key is its last one."""
    names = [*order, *[p for p in payload if p not in order]]
    return F.struct(*[name_col(n).alias(n) for n in names])


def pair_tagged(
    rows: DataFrame,
    is_old: Column,
    keys: Sequence[str],
    payload: Sequence[str],
    order: Sequence[str] = (),
) -> DataFrame:
    """Full outer match inside one frame: keys plus the structs ``old`` and ``new``.

    If a side has a key more than once, the row greatest by ``order`` wins and
    ties go to the greatest payload, so the result never depends on row order.
    """
    version = _version(order, payload)
    return rows.groupBy(*keys).agg(
        F.max(F.when(is_old, version)).alias(OLD),
        F.max(F.when(~is_old, version)).alias(NEW),
    )


def pair_tagged_unique(
    rows: DataFrame, is_old: Column, keys: Sequence[str], payload: Sequence[str]
) -> DataFrame:
    """``pair_tagged`` for keys that a side has at most once and a payload of numbers.

    One maximum per side and number beside a presence flag: buffers of fixed width, so the
    aggregate hashes where the struct form sorts.  A key that a side repeats would mix
    its rows, so the caller must know that there is none.
    """
    sides = {OLD: is_old, NEW: ~is_old}
    values = {(s, p): f"_{s}_{k}" for s in sides for k, p in enumerate(payload)}
    found = rows.groupBy(*keys).agg(
        *[F.max(F.when(mine, True)).alias(f"_{s}") for s, mine in sides.items()],
        *[F.max(F.when(sides[s], name_col(p))).alias(flat) for (s, p), flat in values.items()],
    )
    structs = [
        F.when(F.col(f"_{s}"), F.struct(*[F.col(values[s, p]).alias(p) for p in payload])).alias(s)
        for s in sides
    ]
    return found.select(*[name_col(k) for k in keys], *structs)


def tag_sides(old: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both sides in one frame, told apart by ``IS_OLD``."""
    names = [quoted(c) for c in columns]
    return old.selectExpr(*names, f"true as {IS_OLD}").unionByName(
        new.selectExpr(*names, f"false as {IS_OLD}")
    )


def pair_sides(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    payload: Sequence[str],
    order: Sequence[str] = (),
    *,
    unique_keys: bool = False,
) -> DataFrame:
    """Full outer match of two frames."""
    columns = list(dict.fromkeys([*keys, *order, *payload]))
    if unique_keys:
        if order:
            raise ValueError("keys that occur once need no order")
        return pair_tagged_unique(tag_sides(old, new, columns), F.col(IS_OLD), keys, payload)
    return pair_tagged(tag_sides(old, new, columns), F.col(IS_OLD), keys, payload, order)


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key, in the order the caller names (A4)."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max(_version(order, rest)).alias("_last")
    return (
        df.groupBy(*keys)
        .agg(last)
        .select(*[name_col(c) if c in keys else F.col("_last")[c].alias(c) for c in df.columns])
    )


def latest_run(long: DataFrame) -> DataFrame:
    """Newest computation of every metric: re-runs that appended do not multiply rows."""
    keys = ("cluster", "table_name", "partition_col", "metric_name", "data_dt")
    return latest_by_key(long, keys, ("computed_at",))
