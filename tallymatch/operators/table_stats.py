"""Table statistics measured on the data itself, for catalogs that hold none."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import name_col
from ..model import STATS_SCHEMA


def table_stats(
    df: DataFrame,
    database: str,
    table: str,
    *,
    partition_cols: Sequence[str] = (),
    data_dt: str | None = None,
    table_type: str = "EXTERNAL_TABLE",
    estimate_raw_size: bool = False,
    path: str | None = None,
) -> DataFrame:
    """Rows, bytes and files of a file-based frame, whole or per partition.

    ``df`` must be a plain file scan, since the file facts come from its hidden
    metadata column.  Without ``estimate_raw_size`` no data column is read.  The
    estimate is the size of the rows as JSON text, not a warehouse's own figure,
    and reads everything.  A file without rows is seen only if ``path`` names the
    table's folder: then files and bytes come from its listing.

    Only one small row per scan task and file is shuffled.
    """
    parts = [name_col(p) for p in partition_cols]
    per_file = [
        F.count(F.lit(1)).alias("rows"),
        F.max("_metadata.file_size").alias("bytes"),
    ]
    raw = F.lit(None).cast("bigint")
    if estimate_raw_size:
        row_text = F.to_json(F.struct(*[name_col(c) for c in df.columns]))
        per_file.append(F.sum(F.octet_length(row_text)).alias("raw"))
        raw = F.coalesce(F.sum("raw"), F.lit(0).cast("bigint"))
    files = df.groupBy(*parts, F.col("_metadata.file_path").alias("file")).agg(*per_file)
    zero = F.lit(0).cast("bigint")
    files = files.withColumn("files", F.lit(1))
    if path is not None:
        listed = df.sparkSession.read.format("binaryFile").load(path)
        columns = [F.lit(0).alias("rows"), F.col("length").alias("bytes"), F.lit(1).alias("files")]
        files = files.withColumns({"bytes": zero, "files": F.lit(0)}).unionByName(
            listed.select(*parts, *columns), allowMissingColumns=True
        )
    totals = files.groupBy(*parts).agg(
        F.coalesce(F.sum("rows"), zero).alias("num_rows"),
        F.coalesce(F.sum("bytes"), zero).alias("total_size"),
        F.coalesce(F.sum("files"), zero).alias("num_files"),
        raw.alias("raw_data_size"),
    )
    levels = [F.concat(F.lit(f"{p}="), name_col(p).cast("string")) for p in partition_cols]
    tagged = totals.select(
        F.lit(database).alias("database_name"),
        F.lit(table).alias("table_name"),
        F.lit(table_type).alias("table_type"),
        (F.concat_ws("/", *levels) if levels else F.lit("")).alias("partition_name"),
        "num_rows",
        "total_size",
        "num_files",
        "raw_data_size",
        F.lit(None).alias("last_access_time"),
        F.lit(data_dt).alias("data_dt"),
    )
    return tagged.select(*[F.col(f.name).cast(f.dataType) for f in STATS_SCHEMA.fields])
