"""Run manifest: which run a slice of metrics is from, what it was to measure and what it wrote.

A run writes its plan before it measures and its results after the slice is in place.  So a
slice whose newest run never finished can be told, and rows that an earlier run left behind
are not taken for this one's.  The manifest lies beside the summary: one row per run and one
or two per table, in slices like the summary's own.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import model as M
from .sources.tables import is_path

SLICE = ("cluster", "data_dt")


def manifest_of(target: str) -> str:
    """Where the manifest of a summary is: a folder or table of that name with a suffix."""
    return f"{target.rstrip('/')}_manifest"


def _append(entries: DataFrame, target: str) -> None:
    place, spark = manifest_of(target), entries.sparkSession
    rows = entries.withColumn("recorded_at", F.current_timestamp()).select(*M.MANIFEST_SCHEMA.fieldNames())
    rows = rows.hint("rebalance", *SLICE)  # few files, and many tables are still counted by many tasks
    if is_path(target):
        rows.write.mode("append").partitionBy(*SLICE).parquet(place)
    else:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in M.MANIFEST_SCHEMA.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:t) ({columns}) USING parquet PARTITIONED BY ({', '.join(SLICE)})",
            args={"t": place},
        )
        rows.write.insertInto(place)


def read_manifest(spark: SparkSession, target: str) -> DataFrame | None:
    """All entries, or None if no run has written any."""
    place = manifest_of(target)
    if not is_path(target):
        return spark.table(place) if spark.catalog.tableExists(place) else None
    try:
        return spark.read.schema(M.MANIFEST_SCHEMA).parquet(place)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


@dataclass(frozen=True)
class Run:
    """A run that writes one slice."""

    spark: SparkSession
    target: str
    cluster: str
    data_dt: str
    run_id: str

    @classmethod
    def begin(
        cls, spark: SparkSession, target: str, cluster: str, data_dt: str, specs: Sequence[M.TableSpec] = ()
    ) -> Run:
        """Write down what is to be measured, before anything is."""
        run = cls(spark, target, cluster, data_dt, uuid.uuid4().hex)
        planned = [(s.name, M.PLANNED, s.partition_col, list(s.metrics), None) for s in specs]
        _append(run._tagged([(None, M.STARTED, None, None, None), *planned]), target)
        return run

    def _tagged(self, rows: list[tuple]) -> DataFrame:
        names = "table_name string, state string, partition_col string, expected array<string>, reason string"
        entries = self.spark.createDataFrame(rows, names)
        return entries.withColumns(
            {
                "run_id": F.lit(self.run_id),
                "cluster": F.lit(self.cluster),
                "data_dt": F.lit(self.data_dt),
                "rows_written": F.lit(None).cast("bigint"),
                "first_at": F.lit(None).cast("timestamp"),
                "last_at": F.lit(None).cast("timestamp"),
            }
        )

    def finish(self, written: DataFrame, skipped: Mapping[str, str] = {}) -> None:
        """Write down what the slice holds now: rows and times of each table, and what was skipped."""
        lost = [(name, M.SKIPPED, None, None, reason) for name, reason in skipped.items()]
        ends = self._tagged([(None, M.DONE, None, None, None), *lost])
        measured = _measured(written, self.run_id).where(
            (F.col("cluster") == self.cluster) & (F.col("data_dt") == self.data_dt)
        )
        _append(ends.unionByName(measured), self.target)


def _measured(written: DataFrame, run_id: str) -> DataFrame:
    counted = written.groupBy("cluster", "data_dt", "table_name").agg(
        F.count(F.lit(1)).alias("rows_written"), F.min("computed_at").alias("first_at"), F.max("computed_at").alias("last_at")
    )
    return counted.withColumns(
        {
            "run_id": F.lit(run_id),
            "state": F.lit(M.MEASURED),
            "partition_col": F.lit(None).cast("string"),
            "expected": F.lit(None).cast("array<string>"),
            "reason": F.lit(None).cast("string"),
        }
    )


def record_slices(written: DataFrame, target: str) -> None:
    """Entries of a finished run for all slices that ``written`` holds, where they are not known before."""
    measured = _measured(written, uuid.uuid4().hex)
    ends = measured.groupBy("cluster", "data_dt", "run_id").agg(
        *[F.lit(None).cast(M.MANIFEST_SCHEMA[c].dataType).alias(c) for c in ("table_name", "partition_col", "expected")],
        *[F.lit(None).cast(M.MANIFEST_SCHEMA[c].dataType).alias(c) for c in ("rows_written", "reason", "first_at", "last_at")],
    )
    states = F.explode(F.array(F.lit(M.STARTED), F.lit(M.DONE))).alias("state")
    _append(measured.unionByName(ends.select("*", states)), target)


def newest_entries(manifest: DataFrame) -> DataFrame:
    """The entries of the newest run of every slice."""
    started = manifest.where(F.col("state") == M.STARTED)
    newest = started.groupBy(*SLICE).agg(F.max_by("run_id", F.struct("recorded_at", "run_id")).alias("run_id"))
    return manifest.join(newest, [*SLICE, "run_id"])


def unfinished_slices(
    spark: SparkSession, target: str, clusters: Sequence[str], data_dt: str | None = None
) -> list[tuple[str, str]]:
    """(cluster, date) of the slices whose newest run did not finish: few, as a rule none."""
    manifest = read_manifest(spark, target)
    if manifest is None:
        return []
    runs = manifest.where(F.col("cluster").isin(*clusters) & F.col("state").isin(M.STARTED, M.DONE))
    if data_dt is not None:
        runs = runs.where(F.col("data_dt") == data_dt)
    each = runs.groupBy(*SLICE, "run_id").agg(
        F.min("recorded_at").alias("at"), F.bool_or(F.col("state") == M.DONE).alias("done")
    )
    last = each.groupBy(*SLICE).agg(F.max_by("done", F.struct("at", "run_id")).alias("done"))
    return [(r.cluster, r.data_dt) for r in last.where("NOT done").collect()]
