"""What the operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

#: White space as the contracts of this subpackage define it, and the words between.
WHITE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: Characters of text that a Python worker handles at once.
SLICE_CHARS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, folder: str) -> DataFrame:
    """``df`` written to ``folder`` and read again: lineage ends at files all executors reach."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def fresh_folder(spark: SparkSession) -> str:
    return shared_folder(spark)


def ship(spark: SparkSession) -> None:
    """Give Python workers this package, as ``--py-files`` would (once a session)."""
    context = spark.sparkContext
    if getattr(context, "_tallymatch_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="tallymatch-"), "tallymatch_files.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._tallymatch_shipped = True


def slices(batches: Iterable[pa.RecordBatch], chars: int = SLICE_CHARS) -> Iterator[tuple[list, list]]:
    """(ids, texts) of record batches with columns id and text, a bounded number of characters at once.

    A null text is an empty one.  A text above the bound is a slice of its own.
    """
    ids, texts, held = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py() or ""
            ids.append(key)
            texts.append(text)
            held += len(text)
            if held >= chars:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def white_to_space(text):
    """Each run of white space becomes one space; a null text is an empty one."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE + "+", " ")


def count_of(text, characters: str):
    """How many characters of ``text`` are among ``characters``."""
    return F.length(text) - F.length(F.translate(text, characters, ""))
