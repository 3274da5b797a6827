"""A bitmap of 64-bit hashes, small enough to be in every task: what it lacks is not in the set."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

#: At least 2^16 and at most 2^27 bits (16 MB), in between 32 or more for each hash.
LEAST_BITS, MOST_BITS = 16, 27


@dataclass(frozen=True)
class Bitmap:
    """Two bits of every hash, from its low and from its high half.

    Beyond the size bound more strangers pass, and none that belongs is ever refused.
    """

    words: np.ndarray

    @classmethod
    def of(cls, hashes: DataFrame, rows: int) -> Bitmap:
        """From a frame with one column of longs; the driver gets at most 2^21 words."""
        bits = min(max((32 * rows).bit_length(), LEAST_BITS), MOST_BITS)
        marks = hashes.toDF("mark")
        low = F.expr(f"mark & {(1 << bits) - 1}L")
        high = F.expr(f"shiftrightunsigned(mark, 32) & {(1 << bits) - 1}L")
        words = (
            marks.select(F.explode(F.array(low, high)).alias("bit"))
            .groupBy(F.expr("shiftright(bit, 6)").alias("word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("ones"))
            .toArrow()
        )
        found = np.zeros((1 << bits) // 64, dtype=np.int64)
        found[words["word"].to_numpy()] = words["ones"].to_numpy()
        return cls(found.view(np.uint64))

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Which of the (unsigned) hashes may belong."""
        mask, words = len(self.words) * 64 - 1, self.words.view(np.int64)
        found = np.zeros(len(hashes), dtype=bool)
        signed = hashes.view(np.int64)
        bit = signed & mask
        first = np.flatnonzero(words[bit >> 6] >> (bit & 63) & 1)
        bit = signed[first] >> 32 & mask
        found[first] = (words[bit >> 6] >> (bit & 63) & 1).astype(bool)
        return found


def sieve(keys: DataFrame, within: bool = True) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lets rows pass whose last column, the ``xxhash64`` of a key, may be of the keys, or surely is not; drops that column.

    ``keys`` is a stored frame of one column.  A bitmap of them is in every task.
    """
    spark = keys.sparkSession
    ship(spark)
    bitmap = spark.sparkContext.broadcast(Bitmap.of(keys.select(F.xxhash64(keys.columns[0])), keys.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mark = batch.num_columns - 1
            found = bitmap.value.holds(batch.column(mark).to_numpy().view(np.uint64))
            yield batch.filter(pa.array(found == within)).select(list(range(mark)))

    return run


def sifted(df: DataFrame, key: str, keys: DataFrame, within: bool = True) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be among ``keys``, or is surely not.

    Nothing is shuffled.  Some strangers are among the first, and none of the keys is lost; both
    kinds together are all rows, each once.
    """
    return df.select("*", F.xxhash64(key).alias("_mark")).mapInArrow(sieve(keys, within), df.schema)
