"""Quality by compression.

One zstandard dictionary is trained on good and one on bad labelled text.  A text is compressed
under both in blocks of ``BLOCK`` bytes (so that the dictionaries, not the text's own past, decide);
the normalised difference of the sizes, (good - bad) / (good + bad), beside the ratio of size
to text, which tells text that repeats itself, becomes a calibrated score.

What is learned: at most ``Settings.rows`` labelled rows of each label, of texts up to
``Settings.chars`` characters.  Every whole text is scored.

Defined cases: a null text is an empty one; an empty text is measured as one empty block;
without rows of both labels all scores are the share of label 1 (0 without labels); a null
``doc_id`` is scored and not held out; repeated rows get equal scores; an empty table gives
an empty one; only ``doc_id`` and ``text`` are read, further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .calibration import Logistic, fit_logistic, held_out, labelled_sample
from .common import fresh_folder, ship, slices, table

MODULUS, REMAINDER = 3, 1
SCORED = "doc_id long, score double"
BLOCK = 512
LEVEL = 3


@dataclass(frozen=True)
class Settings:
    rows: int = 4000
    chars: int = 32_000
    dictionary_bytes: int = 32_768


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    score: Logistic | None
    share: float


def _dictionary(texts: list[str], size: int) -> bytes:
    import zstandard

    samples = [data[at : at + BLOCK] for data in (t.encode() for t in texts) for at in range(0, len(data), BLOCK)]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: the samples are the dictionary
        return b"".join(samples)[-size:]


class Sizes:
    """Compressed sizes of a text under both dictionaries, as measurements."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard

        self.pack = []
        for data in (good, bad):
            dictionary = zstandard.ZstdCompressionDict(data)
            dictionary.precompute_compress(level=LEVEL)
            self.pack.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=dictionary, write_content_size=False, write_dict_id=False
                ).compress
            )

    def measure(self, text: str) -> list[float]:
        data = text.encode()
        blocks = [data[at : at + BLOCK] for at in range(0, len(data), BLOCK)] or [b""]
        good, bad = (sum(len(pack(block)) for block in blocks) for pack in self.pack)
        difference = (good - bad) / (good + bad)
        ratio = np.log((good + bad + 1) / (2 * len(data) + 1))
        short = 1 / (1 + len(data) / 100)
        return [difference, ratio, difference * ratio, ratio * ratio, difference * short, ratio * short, short]


@lru_cache(maxsize=2)
def _sizes(good: bytes, bad: bytes) -> Sizes:
    return Sizes(good, bad)


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:  # noqa: B008
    """Dictionaries from the sample; the score from each half under the dictionaries of the other."""
    folder = f"{fresh_folder(docs.sparkSession)}/sample"
    sample, share = labelled_sample(
        docs, labels, "quality", MODULUS, REMAINDER, settings.rows, settings.chars, folder
    )
    halves = sample[::2], sample[1::2]
    if any(len({y for _, y in half}) < 2 for half in halves):
        return Model(b"", b"", None, share)

    def dictionaries(rows: list[tuple[str, int]]) -> tuple[bytes, ...]:
        return tuple(_dictionary([t for t, y in rows if y == k], settings.dictionary_bytes) for k in (1, 0))

    x = []
    for learn, check in (halves, halves[::-1]):
        sizes = Sizes(*dictionaries(learn))
        x += [sizes.measure(t) for t, _ in check]
    y = [y for half in halves[::-1] for _, y in half]
    return Model(*dictionaries(sample), fit_logistic(np.array(x), np.array(y), share), share)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every document; the model is some 70 kB."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in slices(batches):
            if model.score is None:
                found = np.full(len(texts), model.share)
            else:
                sizes = _sizes(model.good, model.bad)
                found = model.score(np.array([sizes.measure(t) for t in texts]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, type=pa.int64()), pa.array(found, type=pa.float64())],
                names=["doc_id", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCORED)


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: all documents scored by a model of the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels"))).select(
        "doc_id",
        held_out(F.col("doc_id"), MODULUS, REMAINDER).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


QUERIES = {"op4_quality_classifier": quality_classifier}
SQL: dict[str, str] = {}
