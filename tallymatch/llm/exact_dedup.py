"""Exact deduplication against a persistent index of digests.

The index is a table bucketed and sorted by digest.  A batch of documents is reduced to
(document, digest), grouped by digest, matched against the index by a sort-merge
anti-join, and the digests that were not there are appended.  Texts never enter a
shuffle, only digests do.

Defined cases: a null text counts as empty; empty texts are copies of each other; a null
``doc_id`` sorts last, so it stays only where no row of its group has an id; of repeated
rows (same id, same text) exactly one stays; an empty batch changes nothing; further
columns are carried where ``columns`` asks for them.  Working columns start with ``_``.

A batch may be given again, after a failure too and in other partitions: the index keeps
the name of the batch that brought a text, and no row numbers.  Rows of a batch that bear
the id the index holds for their text, under the same name, stay as they did before.
Without a name, all batches share the empty one: then a row whose id and text are both
known is taken for the same row given again.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_folder, stored, table, white_to_space


#: Digests (about 100 bytes each) that one bucket of a new index should hold.
BUCKET_ROWS = 2_000_000


def buckets_for(rows: int, least: int) -> int:
    """Buckets for an index of so many texts: they grow with the input."""
    return max(least, math.ceil(rows / BUCKET_ROWS))


@dataclass(frozen=True)
class DigestIndex:
    """A table (digest, keep_id, batch) with one row for each known text.

    ``buckets`` is fixed for the life of an index; choose it so that a bucket of digests
    (about 100 bytes each) fits a task, e.g. 8192 for 10 billion documents.
    """

    name: str
    folder: str
    buckets: int

    @classmethod
    def create(cls, spark: SparkSession, folder: str | None = None, buckets: int | None = None) -> DigestIndex:
        name = f"digest_index_{uuid.uuid4().hex}"
        index = cls(
            name,
            folder or f"{fresh_folder(spark)}/index",
            buckets or int(spark.conf.get("spark.sql.shuffle.partitions")),
        )
        index.append(spark.createDataFrame([], "digest string, keep_id long, batch string"))
        return index

    def append(self, entries: DataFrame) -> None:
        """Add entries: one sorted file for each bucket that gets any."""
        (
            entries.repartition(self.buckets, "digest")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.folder)
            .saveAsTable(self.name)
        )

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)

    def drop(self, spark: SparkSession) -> None:
        """Take the table out of the catalog; its files stay."""
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": self.name})


def with_digest(docs: DataFrame) -> DataFrame:
    """Add the digest of the normalised text, a hash of the text as written, and a number for each row."""
    return docs.withColumns(
        {
            "_digest": F.sha2(white_to_space(F.col("text")), 256),
            "_written": F.xxhash64("text"),
            "_row": F.monotonically_increasing_id(),
        }
    )


def deduplicate(
    docs: DataFrame, index: DigestIndex, columns: tuple[str, ...] = ("doc_id",), batch: str = ""
) -> DataFrame:
    """Every row of ``docs`` with keep_id, group_size, kept and text_sha256.

    ``group_size`` counts the rows of this batch; ``keep_id`` may belong to an earlier one.
    A batch that is given again under its name gets the same answer.  The numbered rows are
    written first, so that later jobs, or tasks run again, see the same numbers; they tell
    equal rows apart within this call only.
    """
    spark, folder = docs.sparkSession, fresh_folder(docs.sparkSession)
    rows = stored(with_digest(docs).select(*columns, "_digest", "_written", "_row"), f"{folder}/rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_written", "_row"))
    groups = stored(
        rows.groupBy(F.col("_digest").alias("digest"))
        .agg(first.alias("first"), F.count(F.lit(1)).alias("group_size"))
        .select("digest", F.col("first.doc_id").alias("new_id"), F.col("first._row").alias("new_row"), "group_size"),
        f"{folder}/groups",
    )
    known = index.read(spark).select("digest")
    unknown = groups.hint("merge").join(known, "digest", "left_anti")
    index.append(unknown.select("digest", F.col("new_id").alias("keep_id"), F.lit(batch).alias("batch")))

    # Read back from files, so that both sides of the last join are plain exchanges and
    # adaptive execution can split the rows of a digest that a third of all rows share.
    ours = (F.col("batch") == batch) & F.col("new_id").eqNullSafe(F.col("keep_id"))
    settled = stored(
        groups.hint("merge")
        .join(index.read(spark), "digest")
        .select(
            F.col("digest").alias("_digest"),
            "keep_id",
            F.when(ours, F.col("new_row")).alias("_stays"),
            "group_size",
        ),
        f"{folder}/settled",
    )
    return rows.join(settled, "_digest").select(
        *columns,
        "keep_id",
        "group_size",
        F.col("_row").eqNullSafe(F.col("_stays")).alias("kept"),
        F.col("_digest").alias("text_sha256"),
    )


def _alone(docs: DataFrame, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Deduplicate against a new index, which leaves the catalog again."""
    spark = docs.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = DigestIndex.create(spark, buckets=buckets_for(docs.count(), least))
    try:
        return deduplicate(docs, index, columns)
    finally:
        index.drop(spark)


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: all documents against a new index."""
    return _alone(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: the documents that stay, with their own columns."""
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_doc"))
    return _alone(rows, ("doc_id", "_doc")).where("kept").select("_doc.*")


QUERIES = {"op8_exact_dedup": exact_dedup}

SQL = {
    "op8_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
""",
}
