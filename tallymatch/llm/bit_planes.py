"""Token ids in files of byte planes.

The ids of all documents, in ascending order of ``doc_id``, form one long row of numbers.
It is stored in shards (ranges of documents) of chunks with a fixed number of ids each; the
last chunk of a shard may be shorter.  A chunk is transposed into byte planes (all lowest
bytes, then all second bytes, ...), and each plane is compressed with zstandard on its own:
high bytes take few values and shrink to little.  The chunk index is columns beside
the planes (shard, chunk, n_ids, the documents that begin in the chunk and where), so counting or
locating reads no plane.  Files are Parquet, written by Spark, so tasks that are run
again or twice leave each chunk once, on any store.

Defined cases: a null text is empty (its document is the end id alone); documents with the
same id follow each other in the order of their texts; a null ``doc_id`` comes first; an
empty table gives no chunk; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh_folder, ship, slices, table
from .library_tokens import library_encoder

CHUNK_IDS = 1 << 16
END = 1
LEVEL = 3

CHUNK = (
    "shard int, chunk int, n_ids int, planes array<binary>, doc_ids array<long>, doc_at array<int>"
)
READ = "shard int, doc_id long, at long, n_tokens long, ids_crc32 long, ids binary"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def to_planes(ids: bytes, level: int = LEVEL) -> list[bytes]:
    """The compressed byte planes of little-endian 32-bit ids; planes of zeros only at the top are left out."""
    import zstandard

    planes = np.ascontiguousarray(np.frombuffer(ids, dtype=np.uint8).reshape(-1, 4).T)
    used = max((k + 1 for k in range(4) if planes[k].any()), default=1)
    packer = zstandard.ZstdCompressor(level=level)
    return [packer.compress(planes[k].tobytes()) for k in range(used)]


def from_planes(planes: list[bytes], n_ids: int) -> bytes:
    import zstandard

    out = np.zeros((n_ids, 4), dtype=np.uint8)
    for k, plane in enumerate(planes):
        out[:, k] = np.frombuffer(zstandard.ZstdDecompressor().decompress(plane), dtype=np.uint8)
    return out.tobytes()


def write_ids(
    docs: DataFrame, folder: str, path: str, end: int = END, chunk_ids: int = CHUNK_IDS, shards: int | None = None
) -> None:
    """Encode every document, append the end id, and write shards of chunks."""
    spark = docs.sparkSession
    ship(spark)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tail, size = np.array([end], dtype="<u4").tobytes(), 4 * chunk_ids
    kinds = (pa.int32(), pa.int32(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = library_encoder(path)
        held, done = bytearray(), 0  # ids of the open chunk, chunks written
        begun: list[tuple] = []  # documents that begin in it

        def chunk(ids: bytes) -> pa.RecordBatch:
            row = (done, len(ids) // 4, to_planes(ids), [d for d, _ in begun], [at for _, at in begun])
            return pa.RecordBatch.from_arrays(
                [pa.array([x], type=t) for x, t in zip(row, kinds, strict=True)],
                names=["chunk", "n_ids", "planes", "doc_ids", "doc_at"],
            )

        for keys, texts in slices(batches):
            for key, ids in zip(keys, encode(texts), strict=True):
                begun.append((key, len(held) // 4))
                held += ids
                held += tail
                while len(held) >= size:
                    yield chunk(bytes(held[:size]))
                    del held[:size]
                    done, begun = done + 1, []
        if held:
            yield chunk(bytes(held))

    (
        docs.select("doc_id", "text")
        .repartitionByRange(shards, "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(run, CHUNK.partition(", ")[2])
        .select(F.spark_partition_id().alias("shard"), "*")
        .write.option("compression", "none")
        .parquet(folder)
    )


def read_ids(spark: SparkSession, folder: str, keep_ids: bool = True) -> DataFrame:
    """Every document of the files: doc_id, start (ids before it), n_tokens, ids_crc32, ids.

    ``ids`` (little-endian unsigned 32-bit) is null unless ``keep_ids``.
    """
    ship(spark)
    chunks = spark.read.schema(CHUNK).parquet(folder)
    # One row a shard: the ids of all shards before it.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        chunks.groupBy("shard")
        .agg(F.sum(F.col("n_ids").cast("long")).alias("n"))
        .select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        shard, at = None, 0  # of the chunk at hand: its shard, and the ids of the shard before it
        doc: list | None = None  # open document: id, place, n, crc, parts

        def close() -> None:
            if doc is not None:
                rows.append((shard, *doc[:4], b"".join(doc[4]) if keep_ids else None))

        def flush() -> pa.RecordBatch:
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = list(zip(*rows, strict=True)) or [()] * 6
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(x, type=t) for x, t in zip(columns, kinds, strict=True)],
                names=["shard", "doc_id", "at", "n_tokens", "ids_crc32", "ids"],
            )

        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if row["shard"] != shard:
                    close()
                    doc, shard, at = None, row["shard"], 0
                ids = from_planes(row["planes"], row["n_ids"])
                edges = [*row["doc_at"], row["n_ids"]]
                pieces = [(None, 0, edges[0])] + [
                    (key, edges[k], edges[k + 1]) for k, key in enumerate(row["doc_ids"])
                ]
                for k, (key, low, high) in enumerate(pieces):
                    if k:
                        close()
                        doc = [key, at + low, 0, 0, []]
                    if high > low:
                        part = ids[4 * low : 4 * high]
                        doc[2] += high - low
                        doc[3] = zlib.crc32(part, doc[3])
                        if keep_ids:
                            doc[4].append(part)
                at += row["n_ids"]
                yield flush()
        close()
        yield flush()

    return (
        chunks.repartition("shard")
        .sortWithinPartitions("shard", "chunk")
        .mapInArrow(run, READ)
        .join(firsts, "shard")
        .select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "ids")
    )


def bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: write the ids of all documents, read them back."""
    folder = f"{fresh_folder(spark)}/ids"
    write_ids(table(spark, sf_dir, "documents"), folder, tokenizer_path())
    return read_ids(spark, folder, keep_ids=False).drop("ids")


QUERIES = {"op7_bit_planes": bit_planes}
SQL: dict[str, str] = {}
