"""Helpers that tests import by name."""

from __future__ import annotations

import os

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns):
    """Rows as a sorted list of tuples, NULLs first."""
    picked = df.select(*columns) if columns else df
    found = [tuple(r) for r in picked.collect()]
    return sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))
