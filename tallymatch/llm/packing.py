"""Pack documents into fixed-size token sequences by minimum bin slack.

Documents become pieces of at most ``capacity`` tokens.  Which pieces share a sequence
depends on their lengths alone, and there are at most ``capacity`` lengths, so the search
runs over the histogram of lengths (at most ``capacity`` rows at any input size):

* per bin, the longest piece left opens it, and a bitset subset-sum over the lengths still
  available (bit r of an integer: r tokens can be filled) finds the fullest combination;
* the combination is taken out as often as the histogram holds it, in one step, since the
  same search would find it again.

Every step uses up at least one length (to below its number in the combination), so the
number of patterns is bounded by the capacity, not by the documents.  The pieces then take
their places in parallel: the k-th piece of a length, counted with a prefix sum over
parts of the table, goes to the k-th slot of that length.

Defined cases: a null text is empty, and a document without tokens still has its end
token; repeated rows are packed each for itself; an empty table has no pieces; a null
``doc_id`` is kept; only ``doc_id`` and ``text`` are read, so further columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh_folder, ship, slices, stored, table
from .library_tokens import library_encoder

CAPACITY = 2048
END = 0

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, shard int"
PLACED = "sequence_id long, offset long"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cut_into_pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, keep_ids: bool = False
) -> DataFrame:
    """Token pieces of every document: ids of the text and the end id, cut where longer than ``capacity``.

    The first piece takes what is over, the others are full.  ``ids`` (little-endian
    unsigned 32-bit) is null unless ``keep_ids``.  ``shard`` names the task that made a row.
    """
    ship(docs.sparkSession)
    step = 4 * capacity
    tail = np.array([end], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = library_encoder(path)
        for keys, texts in slices(batches):
            rows = []
            for key, ids in zip(keys, encode(texts), strict=True):
                ids += tail
                at, size, n = 0, len(ids) % step or step, 0
                while at < len(ids):
                    part = ids[at : at + size]
                    kept = part if keep_ids else None
                    rows.append((key, n, at // 4, len(part) // 4, zlib.crc32(part), kept))
                    at, size, n = at + len(part), step, n + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(column, type=kind)
                    for column, kind in zip(
                        zip(*rows, strict=True),
                        (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()),
                        strict=True,
                    )
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
            )

    schema = PIECE.rpartition(",")[0]
    return docs.select("doc_id", "text").mapInArrow(run, schema).withColumn("shard", F.spark_partition_id())


def fullest(room: int, lengths: list[int], counts: dict[int, int]) -> list[tuple[int, int]]:
    """(length, times) of the fullest combination of at most ``room`` tokens, long pieces first.

    ``reach`` has bit r set if some combination of the lengths seen so far has r tokens.
    """
    reach, steps, within = 1, [], (1 << (room + 1)) - 1
    for length in lengths:
        if length > room or not counts[length]:
            continue
        left, part = min(counts[length], room // length), 1
        while left and not reach >> room & 1:  # 1, 2, 4, ... at a time
            times = min(part, left)
            steps.append((length, times, reach))
            reach |= reach << (length * times) & within
            left, part = left - times, part * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, times, before in reversed(steps):
        if not before >> total & 1:
            total -= length * times
            chosen[length] = chosen.get(length, 0) + times
    return sorted(chosen.items(), reverse=True)


def minimum_slack(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (how many sequences, [(length, times in each)]) that hold the whole histogram."""
    counts = {length: n for length, n in histogram.items() if n}
    lengths = sorted(counts, reverse=True)
    patterns = []
    while lengths:
        longest = lengths[0]
        counts[longest] -= 1
        pattern = dict(fullest(capacity - longest, lengths, counts))
        counts[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(counts[length] // n for length, n in pattern.items())
        for length, n in pattern.items():
            counts[length] -= n * times
        patterns.append((times, sorted(pattern.items(), reverse=True)))
        lengths = [length for length in lengths if counts[length]]
    return patterns


def slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, first sequence, pieces in each sequence, offset of the first)."""
    found: dict[int, list] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for times, pattern in patterns:
        offset = 0
        for length, n in pattern:
            found.setdefault(length, []).append((taken.get(length, 0), sequence, n, offset))
            taken[length] = taken.get(length, 0) + times * n
            offset += length * n
        sequence += times
    return {length: np.array(rows, dtype=np.int64) for length, rows in found.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every piece its sequence and its offset there.

    ``pieces`` must be a stored table: it is read twice, and must not change in between.
    """
    spark = pieces.sparkSession
    ship(spark)
    by_shard = pieces.groupBy("length", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    firsts = stored(
        by_shard.withColumn("first", F.coalesce(before, F.lit(0))), f"{fresh_folder(spark)}/firsts"
    )
    # At most `capacity` rows, whatever the input: one for each length.
    histogram = {r.length: r.n for r in firsts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if any(length > capacity or length < 1 for length in histogram):
        raise ValueError("a piece is empty or longer than a sequence")
    # Bounded by the capacity as well: some rows for each pattern.
    places = slots(minimum_slack(histogram, capacity))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, edges) if len(order) else ():
                runs = places[int(length[rows[0]])]
                run_of = runs[np.searchsorted(runs[:, 0], rank[rows], side="right") - 1]
                nth = rank[rows] - run_of[:, 0]
                sequence[rows] = run_of[:, 1] + nth // run_of[:, 2]
                offset[rows] = run_of[:, 3] + nth % run_of[:, 2] * length[rows]
            kept = batch.drop_columns(["rank"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sequence), pa.array(offset)],
                names=[*kept.schema.names, "sequence_id", "offset"],
            )

    within = Window.partitionBy("length", "shard").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        pieces.withColumn("_nth", F.row_number().over(within) - 1)
        .join(firsts.select("length", "shard", "first"), ["length", "shard"])
        .select(*pieces.columns, (F.col("first") + F.col("_nth")).alias("rank"))
    )
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(run, f"{kinds}, {PLACED}")


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence (at most ``capacity`` of them), from pieces cut with ``keep_ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate("parts", F.expr("cast('' as binary)"), lambda done, part: F.concat(done, part.ids))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", joined.alias("ids"))


def packed_documents(spark: SparkSession, docs: DataFrame, path: str | None = None) -> DataFrame:
    pieces = cut_into_pieces(docs, path or tokenizer_path()).drop("ids")
    return pack(stored(pieces, f"{fresh_folder(spark)}/pieces")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: pieces of all documents with their places."""
    return packed_documents(spark, table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline, last stage: pieces of what is left with their places."""
    return packed_documents(spark, docs)


QUERIES = {"op9_best_fit_packing": best_fit_packing}
SQL: dict[str, str] = {}
