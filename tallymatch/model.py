"""Data model: table specs, frame schemas and the values that make up the contract.

Specs are driver-side configuration.  Everything else is a DataFrame; the
schemas below are passed to readers of stored results; columns of CSV files are taken by
their header, and tables under test have the types of their catalog or files.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Column names, labels and defaults other tools read; they must stay as they are.

DEFAULT_FIELD_TYPE = "decimal(38,2)"
BASE_COLUMNS = ("table_name", "partition_col", "computed_at", "data_dt")
ROW_COUNT = "row_count"
SUM_SUFFIX = "_sum"

OLD = "old"
NEW = "new"

PASS = "PASS"
FAIL = "FAIL"
MISSING_OLD = "MISSING_OLD"
MISSING_NEW = "MISSING_NEW"
# Not one of the original states: nothing is known, so nothing is judged.
NOT_MEASURED = "NOT_MEASURED"

ONLY_IN_OLD = "only_in_old"
ONLY_IN_NEW = "only_in_new"
DIFFERENCE = "difference"
EQUAL = "equal"

NUM_ROWS = "num_rows"
STAT_MEASURES = ("num_rows", "total_size", "num_files", "raw_data_size")
# measure -> key under which the metastore keeps it
STAT_PARAM_KEYS = {
    "num_rows": "numRows",
    "total_size": "totalSize",
    "num_files": "numFiles",
    "raw_data_size": "rawDataSize",
}

# States of manifest entries.
STARTED = "started"
PLANNED = "planned"
MEASURED = "measured"
SKIPPED = "skipped"
DONE = "done"

METRICS_TABLE = "metrics_summary"
COMPARISON_TABLE = "table_comparison"

COMPUTED_AT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
# ----------------------------------------------------------------------------


def _text(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def _longs(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.LongType()) for n in names]


METRIC_SCHEMA = T.StructType(
    _text("cluster", "table_name", "partition_col", "metric_name", "value")
    + [T.StructField("computed_at", T.TimestampType())]
    + _text("data_dt")
)

MANIFEST_SCHEMA = T.StructType(
    _text("run_id", "table_name", "state", "partition_col")
    + [T.StructField("expected", T.ArrayType(T.StringType()))]
    + _longs("rows_written")
    + _text("reason")
    + [T.StructField(n, T.TimestampType()) for n in ("first_at", "last_at", "recorded_at")]
    + _text("cluster", "data_dt")
)

STATS_SCHEMA = T.StructType(
    _text("database_name", "table_name", "table_type", "partition_name")
    + _longs(*STAT_MEASURES, "last_access_time")
    + _text("data_dt")
)

ROW_COUNT_COMPARISON_SCHEMA = T.StructType(
    _text("database_name", "table_name", "partition_name", "metric_name")
    + _longs("old_value", "new_value", "diff_value")
    + _text("data_dt")
)

COMPARISON_TABLE_SCHEMA = T.StructType(
    ROW_COUNT_COMPARISON_SCHEMA.fields[:-1]
    + [T.StructField("etl_tm", T.TimestampType())]
    + _text("data_dt")
)


@dataclass(frozen=True)
class Field:
    """A column of a table under test; summed when its declared type is decimal."""

    name: str
    type: str = DEFAULT_FIELD_TYPE

    @property
    def summable(self) -> bool:
        return "decimal" in self.type.lower()

    @property
    def metric(self) -> str:
        return f"{self.name}{SUM_SUFFIX}"


@dataclass(frozen=True)
class TableSpec:
    """What to measure on one table.  Only the first partition column is used."""

    name: str
    partition_cols: tuple[str, ...] = ()
    fields: tuple[Field, ...] = ()
    count_rows: bool = True

    @property
    def partition_col(self) -> str:
        """Name of the partition column, blank for an unpartitioned table."""
        return self.partition_cols[0] if self.partition_cols else ""

    @property
    def summed(self) -> tuple[Field, ...]:
        return tuple(f for f in self.fields if f.summable)

    @property
    def metrics(self) -> tuple[str, ...]:
        return (*((ROW_COUNT,) if self.count_rows else ()), *(f.metric for f in self.summed))

    def narrow(self, sums: int = 20) -> list[TableSpec]:
        """The same metrics as several specs of at most that many sums each.

        With many sums the cost of each rises, probably as the generated code
        outgrows the JIT.  For wide columnar tables several narrow scans, each
        reading its own columns only, can then be faster: measured up to 3.5
        times for whole tables, 1.6 times per date.  They also multiply scan
        tasks, and row-oriented sources should keep one scan.
        """
        if len(self.summed) <= sums:
            return [self]
        groups = [self.summed[i : i + sums] for i in range(0, len(self.summed), sums)]
        return [
            TableSpec(self.name, self.partition_cols, group, self.count_rows and i == 0)
            for i, group in enumerate(groups)
        ]

    @classmethod
    def of(
        cls,
        name: str,
        partition_cols: Iterable[str] = (),
        fields: Mapping[str, str] | Iterable[str] = (),
    ) -> TableSpec:
        """Short form: ``TableSpec.of("db.t", ["dt"], {"amount": "decimal(16,2)"})``."""
        if isinstance(fields, Mapping):
            typed = tuple(Field(n, t) for n, t in fields.items())
        else:
            typed = tuple(Field(n) for n in fields)
        return cls(name, tuple(partition_cols), typed)


def specs_from_json(text: str) -> list[TableSpec]:
    """Parse ``{"tables": [{"name", "partition_cols", "fields": [{"name", "type"}]}]}``."""
    return [
        TableSpec(
            name=t["name"],
            partition_cols=tuple(t.get("partition_cols") or ()),
            fields=tuple(
                Field(f["name"], f.get("type") or DEFAULT_FIELD_TYPE) for f in t.get("fields") or ()
            ),
        )
        for t in json.loads(text).get("tables", [])
    ]


def load_specs(path: str) -> list[TableSpec]:
    """Read a table-spec file.  It is small configuration and stays on the driver."""
    with open(path, encoding="utf-8") as handle:
        return specs_from_json(handle.read())
