"""Registered queries: each one a Spark callable and, where SQL can say it, the SQL."""

from . import catalog, compare, coverage, files, metrics, proof, safety, stats

MODULES = (metrics, compare, catalog, stats, files, safety, proof, coverage)


def all_queries():
    return {name: check for module in MODULES for name, check in module.QUERIES.items()}


def all_sql():
    return {name: sql.strip() for module in MODULES for name, sql in module.SQL.items()}
