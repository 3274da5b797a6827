"""Toxicity by compression distance.

There are two zstandard dictionaries.  Both hold the same dictionary, trained on ordinary text; where
one goes on with words typical of ordinary texts, the other has words typical of toxic ones, picked
by counting.  A text is compressed window by window (a window is a word) under both:
where the toxic dictionary saves bytes, the window is written in toxic language.  How many
windows save at least 4, 5, 6, ... bytes, beside the length of the text, gives a calibrated score.

zstandard finds no match in the last bytes of a block, and stores a block raw that hardly
shrinks, so every window is followed by the same carrier, which both dictionaries end with.

What is learned: at most ``Settings.rows`` labelled rows of each label, of texts up to
``Settings.chars`` characters.  Every whole text is scored.

Defined cases: a null text is an empty one; an empty text gets the score of a text without
windows; without rows of both labels all scores are the share of label 1 (0 without labels);
a null ``doc_id`` is scored and not held out; repeated rows get equal scores; an empty table
gives an empty one; only ``doc_id`` and ``text`` are read, further columns cannot clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations
from sys import intern

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .calibration import Logistic, fit_logistic, held_out, labelled_sample
from .common import fresh_folder, ship, slices, table

MODULUS, REMAINDER = 5, 0
SCORED = "doc_id long, score double"
CARRIER = b" 0123456789 abcdefghijklmnopqrstuvwxyz 9876543210 "
SAVES = (2, 3, 4, 5, 6, 7, 8)
LETTERS = re.compile(r"[^\W\d_]+")
MEMO = 400_000
PARTS = (4, 5, 6)
#: Stands between words, in dictionaries and windows.
EDGE = " "


@dataclass(frozen=True)
class Settings:
    rows: int = 3000
    chars: int = 32_000
    common_bytes: int = 16_384
    typical_bytes: int = 4096
    #: A part of a word is typical of a class if it is in so many unrelated texts of it, in such a
    #: share of them, and in so many times the share that the other class has.
    least_texts: int = 5
    least_share: float = 0.01
    lift: float = 20


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    score: Logistic | None
    share: float


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def parts_of(word: str) -> set[str]:
    """The word, and how it begins."""
    return {word, *(" " + word[:n] for n in PARTS if n < len(word))}


def unrelated(texts: list[tuple[str, ...]]) -> list[int]:
    """A group for each text, given by its distinct words: copies and near copies share one.

    Two texts are related if they share two of their eight smallest hashes of long words,
    or all their words.
    """
    parent = list(range(len(texts)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    first: dict = {}
    for i, words in enumerate(texts):
        least = sorted(zlib.crc32(w.encode()) for w in words if len(w) >= 10)[:8]
        for key in [words, *combinations(least, 2)]:
            parent[root(i)] = root(first.setdefault(key, i))
    return [root(i) for i in range(len(texts))]


class Holders:
    """How many unrelated texts have a word part; counted only as far as asked, to save memory."""

    def __init__(self, texts: list[tuple[str, ...]]):
        self.groups: dict[int, set[str]] = {}
        for words, group in zip(texts, unrelated(texts), strict=True):
            self.groups.setdefault(group, set()).update(words)
        self.n = max(1, len(self.groups))

    def count(self, among: set[str] | None = None) -> Counter[str]:
        found: Counter[str] = Counter()
        for words in self.groups.values():
            parts = set().union(*map(parts_of, words))
            found.update(parts if among is None else parts & among)
        return found


def _typical(own: Holders, other: Holders, settings: Settings) -> bytes:
    """Words of ``own`` that have a typical part, the most typical at the end, where offsets are short."""
    least = max(settings.least_texts, settings.least_share * own.n)
    here = Counter({part: k for part, k in own.count().items() if k >= least})
    there = other.count(set(here))
    share = settings.lift / other.n
    weight = {part: k for part, k in here.items() if k / own.n >= share * (there[part] + 0.5)}
    words = set().union(*own.groups.values())
    chosen = {w: max(weight.get(part, 0) for part in parts_of(w)) for w in words if len(w) > 3}
    ranked = sorted((w for w in chosen if chosen[w]), key=lambda w: (chosen[w], here[w], w))
    return (EDGE + EDGE.join(ranked) + EDGE).encode()[-settings.typical_bytes :]


def train_dictionaries(texts: list[str], labels: list[int], settings: Settings) -> tuple[bytes, bytes]:
    import zstandard

    samples, distinct = [], ([], [])
    for text, label in zip(texts, labels, strict=True):
        words = words_of(text)
        distinct[label].append(tuple(sorted(map(intern, set(words)))))
        if words and not label:
            samples.append((EDGE + EDGE.join(words) + EDGE).encode())
    try:
        common = zstandard.train_dictionary(settings.common_bytes, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: the samples are the dictionary
        common = b" ".join(samples)[-settings.common_bytes :]
    del samples
    ordinary, toxic = map(Holders, distinct)
    seen, usual = _typical(toxic, ordinary, settings), _typical(ordinary, toxic, settings)
    room = max(len(seen), len(usual))  # so that both reach the common part over one distance
    return (
        common + usual.rjust(room) + CARRIER,
        common + seen.rjust(room) + CARRIER,
    )


class Windows:
    """Bytes that the toxic dictionary saves on each window, remembered by window."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        import zstandard

        parameters = zstandard.ZstdCompressionParameters(
            compression_level=4,
            window_log=16,
            hash_log=14,
            chain_log=14,
            search_log=1,
            min_match=4,
            target_length=0,
            strategy=zstandard.STRATEGY_DFAST,
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        )
        self.pack = [
            zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                compression_params=parameters,
            ).compress
            for d in (ordinary, toxic)
        ]
        self.memo: dict[str, int] = {}

    def measure(self, text: str) -> list[float]:
        """log1p of the windows that save at least so many bytes, the most a window saves, log of their number."""
        memo, (ordinary, toxic) = self.memo, self.pack
        words = words_of(text)
        if len(memo) > MEMO:
            memo.clear()
        for word in set(words).difference(memo):
            window = (EDGE + word + EDGE).encode() + CARRIER
            memo[word] = len(ordinary(window)) - len(toxic(window))
        saved = np.fromiter(map(memo.__getitem__, words), dtype=np.int64, count=len(words))
        most = float(np.clip(saved.max(), 0, 10)) if len(saved) else 0.0
        return [*(float(np.log1p((saved >= s).sum())) for s in SAVES), most, float(np.log1p(len(words)))]


@lru_cache(maxsize=2)
def _windows(ordinary: bytes, toxic: bytes) -> Windows:
    return Windows(ordinary, toxic)


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:  # noqa: B008
    """Dictionaries from the sample; the score from each half under the dictionaries of the other."""
    folder = f"{fresh_folder(docs.sparkSession)}/sample"
    sample, share = labelled_sample(
        docs, labels, "toxic", MODULUS, REMAINDER, settings.rows, settings.chars, folder
    )
    halves = sample[::2], sample[1::2]
    if any(len({y for _, y in half}) < 2 for half in halves):
        return Model(b"", b"", None, share)

    def dictionaries(rows: list[tuple[str, int]]) -> tuple[bytes, bytes]:
        return train_dictionaries([t for t, _ in rows], [y for _, y in rows], settings)

    x = []
    for learn, check in (halves, halves[::-1]):
        windows = Windows(*dictionaries(learn))
        x += [windows.measure(t) for t, _ in check]
    y = [y for half in halves[::-1] for _, y in half]
    return Model(*dictionaries(sample), fit_logistic(np.array(x), np.array(y), share), share)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every document; the model is some 40 kB."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in slices(batches):
            if model.score is None:
                found = np.full(len(texts), model.share)
            else:
                windows = _windows(model.ordinary, model.toxic)
                found = model.score(np.array([windows.measure(t) for t in texts]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, type=pa.int64()), pa.array(found, type=pa.float64())],
                names=["doc_id", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCORED)


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: all documents scored by a model of the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels"))).select(
        "doc_id",
        held_out(F.col("doc_id"), MODULUS, REMAINDER).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: the documents that are not predicted toxic, with their own columns.

    Rows stay beside their scores in one pass: no join, so repeated or null ids need no care.
    """
    model = train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    ship(spark)
    names = docs.columns
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 200):
                part = batch.slice(low, 200)
                texts = [t or "" for t in part.column("text").to_pylist()]
                if model.score is None:
                    found = np.full(len(texts), model.share)
                else:
                    windows = _windows(model.ordinary, model.toxic)
                    found = model.score(np.array([windows.measure(t) for t in texts]))
                yield part.filter(pa.array(found < 0.5))

    return docs.mapInArrow(run, schema).select(*names)


QUERIES = {"op5_toxicity": toxicity}
SQL: dict[str, str] = {}
