"""Compare a Spark result with DuckDB on the same Parquet tables."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        return str(v) if isinstance(v, Decimal) else v

    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def assert_matches(df, con, sql: str) -> int:
    """Same columns, same types of value, same bag of rows.  Returns the row count."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    want = _bag(result.fetchall(), columns)
    got = _bag([tuple(r) for r in df.collect()], df.columns)
    missing, extra = want - got, got - want
    assert not missing and not extra, (
        f"{sum(missing.values())} rows missing, e.g. {list(missing)[:3]}; "
        f"{sum(extra.values())} rows extra, e.g. {list(extra)[:3]}"
    )
    return sum(got.values())
