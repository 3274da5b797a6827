"""Tables under test, stored result slices, and metastore relations kept as files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkValueError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.catalog import Metastore
from .metastore import RELATIONS


def open_table(
    spark: SparkSession, name: str, tables: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """The frame given for a name; without a mapping the catalog table ``db.table``.

    A mapping is complete: a name that it lacks is an absent table, not one of the catalog.
    """
    if tables is None:
        return spark.table(name)
    if name not in tables:
        raise PySparkValueError(f"table {name} is not among the tables given")
    return tables[name]


def full_name(name: str, namespace: str | None) -> str:
    """``db.table`` in a namespace is ``namespace.table``."""
    return name if namespace is None else f"{namespace}.{name.rpartition('.')[2]}"


def side_tables(
    spark: SparkSession,
    names: Iterable[str],
    tables: Mapping[str, DataFrame] | None = None,
    namespace: str | None = None,
) -> dict[str, DataFrame]:
    """The tables that one side has: those of a mapping, or those that exist in a namespace of the catalog.

    With a namespace, ``db.table`` is read as ``namespace.table``.
    """
    if tables is not None:
        return {name: tables[name] for name in names if name in tables}
    full = {n: full_name(n, namespace) for n in names}
    return {n: spark.table(f) for n, f in full.items() if spark.catalog.tableExists(f)}


@dataclass(frozen=True)
class TableIdentity:
    """A table as Spark resolves its name, and where its files are (None for a view)."""

    catalog: str | None
    namespace: tuple[str, ...]
    table: str
    location: str | None


def table_identity(spark: SparkSession, name: str) -> TableIdentity:
    """What a table name stands for in this session: current catalog and database, case as Spark compares it."""
    found = spark.catalog.getTable(name)
    facts = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:t)", args={"t": name})
    place = facts.where(F.col("col_name") == "Location").select("data_type").first()
    same = str if spark.conf.get("spark.sql.caseSensitive").lower() == "true" else str.lower
    return TableIdentity(
        found.catalog,
        tuple(same(part) for part in found.namespace or ()),
        same(found.name),
        place[0].rstrip("/") if place is not None and place[0] else None,
    )


def refuse_same_tables(
    spark: SparkSession,
    names: Iterable[str],
    sides: Sequence[Mapping[str, DataFrame]],
    namespaces: Sequence[str | None],
) -> None:
    """Raise if a name is the same table on both sides: one identity, one location or one and the same scan.

    ``namespaces`` has for each side its namespace, blank for names as they are, None for a mapping.
    """
    for name in names:
        both = [
            None if n is None else table_identity(spark, full_name(name, n or None)) for n in namespaces
        ]
        if None not in both:
            old, new = both
            same = (old.catalog, old.namespace, old.table) == (new.catalog, new.namespace, new.table)
            same = same or (old.location is not None and old.location == new.location)
        else:
            same = sides[0][name].sameSemantics(sides[1][name])
        if same:
            raise ValueError(f"both sides are the same table: {name}")


def is_path(target: str) -> bool:
    """Targets with a slash are paths, all others are table names."""
    return "/" in target


def read_slices(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """Stored results.  The schema is given, so ``2024-01-01`` in a path stays text."""
    if is_path(target):
        return spark.read.schema(schema).parquet(target)
    return spark.table(target).select(*schema.fieldNames())


def file_metastore(spark: SparkSession, folder: str) -> Metastore:
    """Metastore relations exported as one Parquet folder each."""
    return Metastore(**{name: spark.read.parquet(f"{folder}/{name}") for name in RELATIONS})
