"""Numeric reconciliation: metrics of many tables, stored by slice, compared."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import model as M
from ..manifest import Run, newest_entries, read_manifest, record_slices, unfinished_slices
from ..operators.compare import (
    compare_metric_slices,
    compare_metrics,
    compare_partitions,
    expected_metrics,
    not_judged,
    with_notes,
)
from ..operators.metrics import metric_frame, metrics_by_partition
from ..operators.reshape import as_metric_rows, empty_metrics, union_all, unpivot_metrics
from ..session import shared_folder
from ..sinks import clear_slice, export_metrics_tsv, only_value, write_metrics
from ..sources.files import read_metrics_tsv
from ..sources.metric_sql import metric_sql_frame
from ..sources.tables import open_table, read_slices, refuse_same_tables, side_tables

Instant = datetime | Column | None

# What a failing analysis or job raises.
FAILURES = (PySparkException, Py4JJavaError)


@dataclass(frozen=True)
class MetricRun:
    """Long metrics of the tables that could be read, and why the others could not."""

    metrics: DataFrame
    skipped: dict[str, str] = field(default_factory=dict)


def _gather(
    spark: SparkSession, parts: Iterable[tuple[str, Callable[[], DataFrame]]], on_error: str
) -> MetricRun:
    """Union lazily built parts into one plan; a part that fails to analyse may be skipped."""
    if on_error not in ("raise", "skip"):
        raise ValueError("on_error is 'raise' or 'skip'")
    frames, skipped = [], {}
    for name, build in parts:
        try:
            frames.append(build())
        except FAILURES as error:
            if on_error == "raise":
                raise
            skipped[name] = str(error)
    return MetricRun(union_all(frames) if frames else empty_metrics(spark), skipped)


def collect_metrics(
    spark: SparkSession,
    specs: Sequence[M.TableSpec],
    data_dt: str,
    cluster: str,
    *,
    tables: Mapping[str, DataFrame] | None = None,
    computed_at: Instant = None,
    cast_override: str | None = None,
    on_error: str = "raise",
) -> MetricRun:
    """Long metrics of many tables for one date as one lazy plan.

    All tables run in one job, each scanned once.  Use ``store_metrics`` for
    hundreds of tables.
    """

    def build(spec: M.TableSpec) -> DataFrame:
        df = open_table(spark, spec.name, tables)
        wide = metric_frame(
            df, spec, data_dt, computed_at=computed_at, cast_override=cast_override
        )
        return unpivot_metrics(wide, cluster)

    return _gather(spark, [(s.name, lambda s=s: build(s)) for s in specs], on_error)


def collect_metrics_by_partition(
    spark: SparkSession,
    specs: Sequence[M.TableSpec],
    cluster: str,
    *,
    dates: Sequence[str] | None = None,
    tables: Mapping[str, DataFrame] | None = None,
    computed_at: Instant = None,
    cast_override: str | None = None,
    on_error: str = "raise",
) -> MetricRun:
    """Long metrics of many partitioned tables for many dates, one scan per table."""

    def build(spec: M.TableSpec) -> DataFrame:
        wide = metrics_by_partition(
            open_table(spark, spec.name, tables),
            spec,
            dates=dates,
            computed_at=computed_at,
            cast_override=cast_override,
        )
        return unpivot_metrics(wide, cluster)

    return _gather(spark, [(s.name, lambda s=s: build(s)) for s in specs], on_error)


def collect_metrics_sql(
    spark: SparkSession,
    statements: Sequence[str],
    data_dt: str,
    cluster: str,
    *,
    on_error: str = "raise",
) -> MetricRun:
    """Long metrics of user-written statements as one lazy plan."""
    return _gather(spark, _sql_parts(spark, statements, data_dt, cluster), on_error)


def _sql_parts(
    spark: SparkSession, statements: Sequence[str], data_dt: str, cluster: str
) -> list[tuple[str, Callable[[], DataFrame]]]:
    return [
        (f"statement {i}", lambda s=s: metric_sql_frame(spark, s, data_dt, cluster))
        for i, s in enumerate(statements, 1)
    ]


def _now(spark: SparkSession) -> datetime:
    return spark.range(1).select(F.current_timestamp()).first()[0]


def _stage_parts(
    spark: SparkSession,
    parts: Sequence[tuple[str, Callable[[], DataFrame]]],
    folder: str,
    on_error: str,
    parts_per_job: int,
) -> dict[str, str]:
    """Run parts in jobs of some each, their long metrics going to ``folder``; returns the skipped ones.

    With ``on_error="skip"`` a job that fails while running is repeated part by
    part, and only the parts at fault are lost.  Raises if all of them are.
    """
    skipped: dict[str, str] = {}

    def store(group: Sequence[tuple[str, Callable[[], DataFrame]]]) -> None:
        run = _gather(spark, group, on_error)
        skipped.update(run.skipped)
        if len(run.skipped) < len(group):
            as_metric_rows(run.metrics).write.mode("append").parquet(folder)

    for start in range(0, len(parts), parts_per_job):
        group = parts[start : start + parts_per_job]
        try:
            store(group)
        except FAILURES:
            if on_error == "raise":
                raise
            for part in group:
                try:
                    store([part])
                except FAILURES as error:
                    skipped[part[0]] = str(error)
    if len(skipped) == len(parts):
        raise RuntimeError(f"nothing was measured: {skipped}")
    return skipped


def _store_run(
    spark: SparkSession,
    parts: Sequence[tuple[str, Callable[[], DataFrame]]],
    run: Run,
    on_error: str,
    parts_per_job: int,
    overwrite: bool,
) -> dict[str, str]:
    """Measure, then append to the slice or replace it in one step; no rows empty it.

    A row of another date or cluster fails the job before anything is replaced.  The manifest
    then shows a run that did not finish, so the slice that is still there is not judged.
    """
    folder = f"{shared_folder(spark)}/metrics"
    skipped = _stage_parts(spark, parts, folder, on_error, parts_per_job)
    staged = spark.read.schema(M.METRIC_SCHEMA).parquet(folder)
    held = staged.withColumns(
        {
            "data_dt": only_value(F.coalesce("data_dt", F.lit(run.data_dt)), run.data_dt, "date"),
            "cluster": only_value(F.col("cluster"), run.cluster, "cluster"),
        }
    )
    if write_metrics(held, run.target, overwrite=overwrite) == 0 and overwrite:
        clear_slice(spark, run.target, M.METRIC_SCHEMA, {"cluster": run.cluster, "data_dt": run.data_dt})
    run.finish(held, skipped)
    return skipped


def store_metrics(
    spark: SparkSession,
    specs: Sequence[M.TableSpec],
    data_dt: str,
    cluster: str,
    target: str,
    *,
    tables: Mapping[str, DataFrame] | None = None,
    computed_at: Instant = None,
    cast_override: str | None = None,
    on_error: str = "raise",
    overwrite: bool = False,
    tables_per_job: int = 50,
) -> dict[str, str]:
    """Compute and store metrics in jobs of some tables each; returns the skipped ones.

    The jobs write to a folder of their own; the slice is appended to or
    replaced once, at the end, with one ``computed_at``.  So a failure leaves
    the slice as it was, whatever the number of tables.
    """
    at = computed_at if computed_at is not None else _now(spark)
    parts = [
        (
            s.name,
            lambda s=s: unpivot_metrics(
                metric_frame(
                    open_table(spark, s.name, tables),
                    s,
                    data_dt,
                    computed_at=at,
                    cast_override=cast_override,
                ),
                cluster,
            ),
        )
        for s in specs
    ]
    run = Run.begin(spark, target, cluster, data_dt, specs)
    return _store_run(spark, parts, run, on_error, tables_per_job, overwrite)


def store_metrics_sql(
    spark: SparkSession,
    statements: Sequence[str],
    data_dt: str,
    cluster: str,
    target: str,
    *,
    on_error: str = "raise",
    overwrite: bool = False,
    statements_per_job: int = 50,
) -> dict[str, str]:
    """The same for user-written statements (S8): a statement that fails costs only itself."""
    parts = _sql_parts(spark, statements, data_dt, cluster)
    run = Run.begin(spark, target, cluster, data_dt)
    return _store_run(spark, parts, run, on_error, statements_per_job, overwrite)


def ingest_old(
    spark: SparkSession,
    tsv: str,
    target: str,
    *,
    header: bool = False,
    overwrite: bool = False,
    data_dt: str | None = None,
    cluster: str = M.OLD,
    any_text: bool = False,
) -> int:
    """Load exported metrics of the old cluster into the summary (E3).  Returns rows stored.

    A row of another cluster, or of another date than ``data_dt`` if that is given, fails before
    anything is replaced.  Raises if there are no rows: a file that came empty is no measurement.
    """
    rows = read_metrics_tsv(spark, tsv, header=header, any_text=any_text)
    held = rows.withColumn("cluster", only_value(F.col("cluster"), cluster, "cluster"))
    run = None
    if data_dt is not None:
        held = held.withColumn("data_dt", only_value(F.col("data_dt"), data_dt, "date"))
        run = Run.begin(spark, target, cluster, data_dt)
    stored = write_metrics(held, target, overwrite=overwrite)
    if stored == 0:
        raise RuntimeError(f"no metrics in {tsv}")
    if run is None:
        record_slices(held, target)
    else:
        run.finish(held)
    return stored


def _by_sql(measures: Sequence[M.TableSpec] | Sequence[str]) -> bool:
    return bool(measures) and isinstance(measures[0], str)


def measure_to_tsv(
    spark: SparkSession,
    measures: Sequence[M.TableSpec] | Sequence[str],
    data_dt: str,
    cluster: str,
    path: str,
    *,
    tables: Mapping[str, DataFrame] | None = None,
    computed_at: Instant = None,
    on_error: str = "raise",
    any_text: bool = False,
) -> dict[str, str]:
    """Measure one cluster into a TSV folder for another cluster to ingest."""
    staged = f"{shared_folder(spark)}/summary"
    skipped = run_new(
        spark,
        measures,
        data_dt,
        staged,
        cluster=cluster,
        tables=tables,
        computed_at=computed_at,
        on_error=on_error,
    )
    export_metrics_tsv(read_slices(spark, staged, M.METRIC_SCHEMA), path, any_text=any_text)
    return skipped


def run_new(
    spark: SparkSession,
    measures: Sequence[M.TableSpec] | Sequence[str],
    data_dt: str,
    target: str,
    *,
    cluster: str = M.NEW,
    tables: Mapping[str, DataFrame] | None = None,
    computed_at: Instant = None,
    on_error: str = "raise",
    overwrite: bool = False,
    tsv_path: str | None = None,
) -> dict[str, str]:
    """Measure the new cluster by specs or by SQL statements and store it.

    A TSV is exported from the stored slice, so tables are read once.
    """
    if _by_sql(measures):
        skipped = store_metrics_sql(
            spark, measures, data_dt, cluster, target, on_error=on_error, overwrite=overwrite
        )
    else:
        skipped = store_metrics(
            spark,
            measures,
            data_dt,
            cluster,
            target,
            tables=tables,
            computed_at=computed_at,
            on_error=on_error,
            overwrite=overwrite,
        )
    if tsv_path is not None:
        stored = read_slices(spark, target, M.METRIC_SCHEMA)
        export_metrics_tsv(
            stored.where((F.col("cluster") == cluster) & (F.col("data_dt") == data_dt)), tsv_path
        )
    return skipped


def compare_stored(
    spark: SparkSession, target: str, data_dt: str | None = None, *, proven: bool = False, **how
) -> DataFrame:
    """Compare the stored slices of both clusters.

    A date whose newest run of either cluster began and did not finish is NOT_MEASURED: what is
    stored there is of an earlier run.  With ``proven`` only rows that the newest runs
    wrote take part, both clusters must have a finished run, and every metric that they were to measure
    is a row; slices written without a manifest then count as not measured.
    """
    clusters = (how.get("old", M.OLD), how.get("new", M.NEW))
    summary = read_slices(spark, target, M.METRIC_SCHEMA)
    if proven:
        return _compare_proven(spark, summary, target, data_dt, clusters, how)
    stale = unfinished_slices(spark, target, clusters, data_dt)
    return not_judged(compare_metric_slices(summary, data_dt, **how), stale)


def _compare_proven(
    spark: SparkSession, summary: DataFrame, target: str, data_dt: str | None, clusters: tuple[str, str], how: dict
) -> DataFrame:
    manifest = read_manifest(spark, target)
    if manifest is None:
        manifest = spark.createDataFrame([], M.MANIFEST_SCHEMA)
    entries = newest_entries(manifest.where(F.col("cluster").isin(*clusters)))
    if data_dt is not None:
        entries = entries.where(F.col("data_dt") == data_dt)
        summary = summary.where(F.col("data_dt") == data_dt)
    written = entries.where(F.col("state") == M.MEASURED).select(
        "cluster", "data_dt", "table_name", "first_at", "last_at"
    )
    keys = ["cluster", "data_dt", "table_name"]
    within = F.col("computed_at").between(F.col("first_at"), F.col("last_at"))
    own = summary.join(written, keys).where(F.coalesce(within, F.col("first_at").isNull()))
    planned = entries.where(F.col("state") == M.PLANNED)
    grid = planned.select("table_name", "partition_col", "data_dt", F.explode("expected").alias("metric_name"))
    # Keys of rows that are no run's own are rows too, so that nothing stored goes unmentioned.
    left = summary.select("table_name", "partition_col", "data_dt", "metric_name")
    compared = compare_metric_slices(own, None, **how, expected=grid.unionByName(left).distinct())

    def of(cluster: str, state: str, value: Column, name: str) -> Column:
        return F.max(F.when((F.col("cluster") == cluster) & (F.col("state") == state), value)).alias(name)

    ends = entries.groupBy("data_dt").agg(
        *[of(c, M.DONE, F.lit(True), f"_{side}_done") for side, c in zip((M.OLD, M.NEW), clusters, strict=True)]
    )
    lost = (
        entries.where(F.col("state") == M.SKIPPED)
        .groupBy("data_dt", "table_name")
        .agg(*[of(c, M.SKIPPED, F.col("reason"), f"_{side}_lost") for side, c in zip((M.OLD, M.NEW), clusters, strict=True)])
    )
    joined = compared.join(ends, "data_dt", "left").join(lost, ["data_dt", "table_name"], "left")
    why = []
    for side, cluster in zip((M.OLD, M.NEW), clusters, strict=True):
        why.append(F.when(F.col(f"_{side}_done").isNull(), f"run not finished: {cluster}"))
        gone = F.col(f"{side}_value").isNull() & F.col(f"_{side}_lost").isNotNull()
        why.append(F.when(gone, F.concat(F.lit(f"{cluster}: "), F.col(f"_{side}_lost"))))
    open_ = F.coalesce(*why).isNotNull()
    return joined.withColumns(
        {
            "status": F.when(open_, M.NOT_MEASURED).otherwise(F.col("status")),
            "reason": F.when(open_, F.concat_ws("; ", *why)).otherwise(F.col("reason")),
            "diff": F.when(~open_, F.col("diff")),
            "diff_num": F.when(~open_, F.col("diff_num")),
        }
    ).select(*compared.columns)


def run_all(
    spark: SparkSession,
    old_tsv: str,
    measures: Sequence[M.TableSpec] | Sequence[str],
    data_dt: str,
    target: str,
    *,
    header: bool = False,
    overwrite: bool = False,
    tables: Mapping[str, DataFrame] | None = None,
    computed_at: Instant = None,
    on_error: str = "raise",
) -> DataFrame:
    """Ingest the old side, measure the new side, compare what is stored (E5).

    Overwriting replaces the two slices written here and nothing else.  Text of another cluster or date
    raises, and only rows that these two runs wrote are judged.
    """
    ingest_old(spark, old_tsv, target, header=header, overwrite=overwrite, data_dt=data_dt)
    run_new(
        spark,
        measures,
        data_dt,
        target,
        tables=tables,
        computed_at=computed_at,
        on_error=on_error,
        overwrite=overwrite,
    )
    return compare_stored(spark, target, data_dt, proven=True)


def _two_sides(
    spark: SparkSession,
    specs: Sequence[M.TableSpec],
    old_tables: Mapping[str, DataFrame] | None,
    new_tables: Mapping[str, DataFrame] | None,
    old_namespace: str | None,
    new_namespace: str | None,
) -> list[dict[str, DataFrame]]:
    """The tables each side has.  Raises where both sides would be the same tables.

    Two mappings are the caller's own choice.  Where a side comes from the catalog, the identities
    of its tables are resolved, and the other side must have other tables at other places.
    """
    if old_tables is None and new_tables is None and old_namespace == new_namespace:
        raise ValueError("both sides are the same tables: give mappings or two namespaces")
    names = [s.name for s in specs]
    sides = [
        side_tables(spark, names, old_tables, old_namespace),
        side_tables(spark, names, new_tables, new_namespace),
    ]
    if old_tables is None or new_tables is None:
        named = [None if t is not None else n or "" for t, n in ((old_tables, old_namespace), (new_tables, new_namespace))]
        refuse_same_tables(spark, [n for n in names if n in sides[0] and n in sides[1]], sides, named)
    return sides


def reconcile_metrics(
    spark: SparkSession,
    specs: Sequence[M.TableSpec],
    data_dt: str,
    old_tables: Mapping[str, DataFrame] | None = None,
    new_tables: Mapping[str, DataFrame] | None = None,
    *,
    old_namespace: str | None = None,
    new_namespace: str | None = None,
    computed_at: Instant = None,
    on_error: str = "raise",
    **how,
) -> DataFrame:
    """Measure both sides for one date and compare, as a single lazy plan (E5).

    A side is a mapping or the tables of a catalog namespace.  A table that one
    side lacks has no metrics there, so all of the other's are missing.  Every metric of
    the specs is a row: what no side measured is NOT_MEASURED.  With ``on_error="skip"`` a table
    that cannot be read is NOT_MEASURED too, with the reason, on whichever side it failed.
    """
    found = _two_sides(spark, specs, old_tables, new_tables, old_namespace, new_namespace)
    runs, notes, failed = [], {}, []
    for cluster, tables in zip((M.OLD, M.NEW), found, strict=True):
        run = collect_metrics(
            spark,
            [s for s in specs if s.name in tables],
            data_dt,
            cluster,
            tables=tables,
            computed_at=computed_at,
            on_error=on_error,
        )
        runs.append(run.metrics)
        notes.update({(cluster, s.name): "no such table" for s in specs if s.name not in tables})
        notes.update({(cluster, name): error.partition("\n")[0] for name, error in run.skipped.items()})
        failed += [(cluster, name) for name in run.skipped]
    compared = compare_metrics(*runs, expected=expected_metrics(spark, specs, data_dt), **how)
    return with_notes(compared, notes, failed)


def reconcile_partitions(
    spark: SparkSession,
    specs: Sequence[M.TableSpec],
    old_tables: Mapping[str, DataFrame] | None = None,
    new_tables: Mapping[str, DataFrame] | None = None,
    *,
    old_namespace: str | None = None,
    new_namespace: str | None = None,
    **how,
) -> DataFrame:
    """Measure both sides for all (or the given) dates, one scan per table, and compare.

    A table that one side lacks has no dates there; one that both lack raises.
    """
    old, new = _two_sides(spark, specs, old_tables, new_tables, old_namespace, new_namespace)
    for spec in specs:
        if spec.name not in old and spec.name not in new:
            raise ValueError(f"neither side has {spec.name}")
        for side, other in ((old, new), (new, old)):
            if spec.name not in side:
                side[spec.name] = other[spec.name].where(F.lit(False))
    return compare_partitions(specs, old, new, **how)
