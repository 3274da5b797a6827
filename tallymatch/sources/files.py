"""Delimited text: statistics CSV, metric TSV, and TSV with ragged rows."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import name_col, unescaped
from ..model import METRIC_SCHEMA, STATS_SCHEMA

# In statistics files of the old layout these columns hold something
# else than their header says (header -> content).
LEGACY_STATS_CONTENT = {
    "num_files": "num_rows",
    "total_size": "total_size",
    "raw_data_size": "num_files",
    "num_rows": "raw_data_size",
}


def _strings(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _row_order():
    """Position of a row in its files: file, split within the file, row within the split."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ).alias("row_order")


_FIELD = r'("(?:[^"]|"")*"|[^,]*)(?:,|$)'


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of text with their file, the block they are in, and numbers that rise within a block."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )


def _first_rows(lines: DataFrame) -> DataFrame:
    """(file, row, line): the first line of every file.  A task reads a file's first block in
    order, so its first row there is the file's first line; one row a task and file is shuffled."""
    first = lines.where("block = 0").groupBy("file").agg(F.min(F.struct("row", "value")).alias("first"))
    return first.select("file", "first.row", F.col("first.value").alias("line"))


def _headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, header): the column names of every file, from its first line by its place in the file."""
    first = _first_rows(_lines(spark, paths))
    named = F.transform(
        F.regexp_extract_all("line", F.lit(_FIELD), 1), lambda f: F.replace(F.trim(f, F.lit('"')), F.lit('""'), F.lit('"'))
    )
    # The expression also matches the empty text at the end of a line that has no comma there.
    return first.select("file", F.slice(named, 1, F.size(F.split("line", ",", -1))).alias("header"))


def _present(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths that exist."""
    found = []
    for path in paths:
        try:
            spark.read.schema("value string").text(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            found.append(path)
    return found


def _by_header(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, dict[str, Column]]:
    """Rows of CSV files, and where their columns are by the headers of their files.

    Two scans whatever the number of files: one for the first lines, one for the rows.
    """
    headers = _headers(spark, paths)
    layouts = headers.select(F.to_json("header").alias("header")).distinct().limit(2).collect()
    widest = headers.agg(F.max(F.size("header"))).first()[0] or 1
    fields = _strings([f"c{k}" for k in range(widest)])
    rows = spark.read.schema(fields).option("header", True).option("escape", '"').csv(paths).select("*", _row_order())
    if len(layouts) == 1:
        names = json.loads(layouts[0].header)
        places = {n: F.col(f"c{k}") for k, n in reversed(list(enumerate(names)))}
    else:
        rows = rows.withColumn("file", F.col("row_order.file")).join(headers, "file")
        values = F.array(*[F.col(f.name) for f in fields])
        where = lambda n: F.array_position("header", n).cast("int")
        known = (*STATS_SCHEMA.fieldNames(),)
        places = {n: F.when(where(n) > 0, F.get(values, where(n) - 1)) for n in known}
    return rows, places


def read_stats_csv(
    spark: SparkSession,
    path: str | list[str],
    *,
    legacy_stats_layout: bool = False,
    header: bool = True,
    row_order: bool = False,
    missing_ok: bool = False,
) -> DataFrame:
    """Statistics CSV, every column as text, columns taken by header name (S3).

    Every file has its own header, also in a folder: files may hold their columns in any order.
    ``legacy_stats_layout`` puts right files whose header does not match their
    content.  ``header=False`` reads columns by position; a file without
    ``data_dt`` leaves it NULL.  ``row_order`` adds the position in the file,
    for rules of the "last row wins" kind.  ``missing_ok`` reads an absent path
    as no rows, and others beside it as they are.
    """
    names = STATS_SCHEMA.fieldNames()
    paths = [path] if isinstance(path, str) else list(path)
    if missing_ok:
        paths = _present(spark, paths)
        if not paths:
            empty = spark.createDataFrame([], _strings(names))
            position = "struct<file:string,block:bigint,row:bigint>"
            return empty.withColumn("row_order", F.lit(None).cast(position)) if row_order else empty
    if header:
        rows, places = _by_header(spark, paths)
    else:
        rows = spark.read.schema(_strings(names)).option("escape", '"').csv(paths).select("*", _row_order())
        places = {n: name_col(n) for n in names}
    content = LEGACY_STATS_CONTENT if legacy_stats_layout and header else {}
    source = {content.get(c, c): places[c] for c in places}
    columns = [source.get(n, F.lit(None).cast("string")).alias(n) for n in names]
    return rows.select(*columns, *(["row_order"] if row_order else []))


def read_metrics_tsv(
    spark: SparkSession, path: str | list[str], *, header: bool = False, any_text: bool = False
) -> DataFrame:
    """Exported long metrics (S4).  The word NULL is a missing value.

    Times are cast rather than parsed by one pattern, so any number of
    fractional digits is read.  ``any_text`` reads what was exported so: every line is a
    row, and escapes become the characters they stand for.
    """
    if any_text:
        lines = spark.read.option("lineSep", "\n").text(path).select(F.split("value", "\t", -1).alias("f"))
        field = lambda k: F.when(F.get("f", k) != "NULL", unescaped(F.get("f", k)))
        rows = lines.select(*[field(k).alias(n) for k, n in enumerate(METRIC_SCHEMA.fieldNames())])
        return rows.withColumn("computed_at", F.col("computed_at").try_cast("timestamp"))
    rows = (
        spark.read.schema(_strings(METRIC_SCHEMA.fieldNames()))
        .option("sep", "\t")
        .option("header", header)
        .option("nullValue", "NULL")
        .option("escape", '"')
        .csv(path)
    )
    return rows.withColumn("computed_at", F.col("computed_at").try_cast("timestamp"))


def read_strict_tsv(
    spark: SparkSession, path: str | list[str], columns: Sequence[str], *, header: bool = False
) -> DataFrame:
    """Tab-separated lines that have exactly as many fields as there are columns.

    Works on whole lines: the CSV reader parses only the columns a query needs,
    and so would let a short or long line through as soon as a query asks for
    fewer columns.  With ``header`` the first line of each file goes because of its place,
    whatever it says, and a later line that looks like it stays.
    """
    lines = spark.read.text(path)
    if header:
        lines = _lines(spark, path)
        lines = lines.join(_first_rows(lines), ["file", "row"], "left_anti")
    fields = lines.select(F.split("value", "\t", -1).alias("f"))
    whole = fields.where(F.size("f") == len(columns))
    return whole.select(*[F.col("f")[i].alias(c) for i, c in enumerate(columns)])
