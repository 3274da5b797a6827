"""Byte-level BPE by replaying the merges over a corpus of distinct pieces.

Texts are cut into pieces by the split pattern.  The distinct pieces of a slice of the
corpus are laid out as one row of byte tokens, and an inverted index maps each merge rank to
the positions where its pair stands.  Merges are applied in rank order: a merge visits only
its own positions and touches only their two neighbours, whose new pairs enter the index.
Pieces do not affect each other, so slices of bounded size give the ids that one index over
the whole corpus would give, and nothing has to be shuffled or broadcast.

A piece that is a token as a whole takes its id at once, as the format demands.

Defined cases: a null or empty text has no ids; a null ``doc_id`` is kept; repeated rows are
encoded each; an empty table gives an empty one; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import ChunkEncoder, forget, packed, splitter
from .common import ship, slices, table

MEMO = 150_000
ENCODED = "doc_id long, ids binary"
DECODED = "doc_id long, ids binary, decoded binary"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Merges:
    """A rank file, with the ranks of token pairs as they are looked up.

    A pair is one integer, the left id above ``SHIFT`` bits and the right id below.
    """

    SHIFT = 21
    PAIRS = 500_000

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        self.values = [b""] * (max(self.ranks.values()) + 1)
        for piece, rank in self.ranks.items():
            self.values[rank] = piece
        single = [bytes([b]) for b in range(256)]
        self.byte_ids = np.array([self.ranks[b] for b in single], dtype=np.int64)
        self.byte_pairs = np.array([self.ranks.get(x + y, -1) for x in single for y in single], dtype=np.int64)
        self.pairs: dict[int, int] = {}

    def start(self) -> dict[int, int]:
        """Known pairs, those of two bytes among them; emptied when they are too many."""
        if not self.pairs or len(self.pairs) > self.PAIRS:
            left, right = np.divmod(np.flatnonzero(self.byte_pairs >= 0), 256)
            keys = self.byte_ids[left] << self.SHIFT | self.byte_ids[right]
            self.pairs = dict(zip(keys.tolist(), self.byte_pairs[left * 256 + right].tolist(), strict=True))
        return self.pairs

    def look_up(self, pair: int) -> int:
        left, right = pair >> self.SHIFT, pair & (1 << self.SHIFT) - 1
        self.pairs[pair] = rank = self.ranks.get(self.values[left] + self.values[right], -1)
        return rank


def replay(pieces: list[bytes], merges: Merges) -> list[list[int]]:
    """The ids of each piece (none is empty) after all merges."""
    if not pieces:
        return []
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    ends = np.cumsum(np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)))
    starts = np.concatenate([[0], ends[:-1]])
    following, preceding = np.arange(1, len(data) + 1), np.arange(-1, len(data) - 1)
    following[ends - 1], preceding[starts] = -1, -1
    ranks = np.full(len(data), -1)
    ranks[:-1] = merges.byte_pairs[data[:-1].astype(np.int64) * 256 + data[1:]]
    ranks[ends - 1] = -1  # no pair reaches into the next piece
    at = np.flatnonzero(ranks >= 0)
    at = at[np.argsort(ranks[at], kind="stable")]
    first = np.flatnonzero(np.diff(ranks[at], prepend=-1))
    #: The inverted index: where the pair of a rank stands.
    index = {
        rank: places.tolist()
        for rank, places in zip(ranks[at[first]].tolist(), np.split(at, first[1:]), strict=True)
        if len(places)
    } if len(at) else {}

    token = merges.byte_ids[data].tolist()  # -1 where a token has been merged into the one before
    after, before = following.tolist(), preceding.tolist()
    pairs, shift, look_up = merges.start(), merges.SHIFT, merges.look_up
    waiting = list(index)
    heapq.heapify(waiting)
    while waiting:
        rank = heapq.heappop(waiting)
        places = index.pop(rank, None)
        if places is None:
            continue
        places.sort()
        for n, i in enumerate(places):
            left, j = token[i], after[i]
            # The place may have changed since it was indexed.
            if left < 0 or j < 0 or pairs.get(left << shift | token[j]) != rank:
                continue
            token[i], token[j] = rank, -1
            after[i] = k = after[j]
            h, lower = before[i], False
            if k >= 0:
                before[k] = i
                pair = rank << shift | token[k]
                new = pairs.get(pair)
                if new is None:
                    new = look_up(pair)
                if new >= 0:
                    lower = new < rank
                    if new in index:
                        index[new].append(i)
                    else:
                        index[new] = [i]
                        heapq.heappush(waiting, new)
            if h >= 0:
                pair = token[h] << shift | rank
                new = pairs.get(pair)
                if new is None:
                    new = look_up(pair)
                if new >= 0:
                    lower |= new < rank
                    if new in index:
                        index[new].append(h)
                    else:
                        index[new] = [h]
                        heapq.heappush(waiting, new)
            if lower and n + 1 < len(places):  # an earlier merge has become possible: it goes first
                index.setdefault(rank, []).extend(places[n + 1 :])
                heapq.heappush(waiting, rank)
                break
    return [[t for t in token[low:high] if t >= 0] for low, high in zip(starts.tolist(), ends.tolist(), strict=True)]


class Replayer:
    """Gives the bytes (little-endian unsigned 32-bit ids) of chunks of text."""

    def __init__(self, path: str, pattern: str):
        self.merges, self.find = Merges(path), splitter(pattern)
        self.known: dict[str, bytes] = {}

    def __call__(self, chunks: list[str]) -> list[bytes]:
        known, found = self.known, [self.find(chunk) for chunk in chunks]
        new = list({piece for pieces in found for piece in pieces}.difference(known))
        merged, raw = [], []
        for piece in new:
            data = piece.encode()
            rank = self.merges.ranks.get(data)
            if rank is None:
                merged.append(piece)
                raw.append(data)
            else:
                known[piece] = packed([rank])
        known.update(zip(merged, map(packed, replay(raw, self.merges)), strict=True))
        out = [
            known[pieces[0]] if len(pieces) == 1 else b"".join(map(known.__getitem__, pieces)) for pieces in found
        ]
        if len(known) > MEMO:
            forget(known, new)
        return out


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> ChunkEncoder:
    return ChunkEncoder(Replayer(path, pattern), MEMO)


@lru_cache(maxsize=2)
def _decoder(path: str) -> list[bytes]:
    return Merges(path).values


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of every document; ids are little-endian unsigned 32-bit integers."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for keys, texts in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, type=pa.int64()), pa.array(encoder(texts), type=pa.binary())],
                names=["doc_id", "ids"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Add the bytes that the ids stand for."""
    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = _decoder(path).__getitem__
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                texts = [
                    b"".join(map(value, np.frombuffer(ids.as_buffer(), dtype="<u4").tolist()))
                    for ids in part.column("ids")
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, type=pa.binary())], names=["doc_id", "ids", "decoded"]
                )

    return encoded.select("doc_id", "ids").mapInArrow(run, DECODED)


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: encode and decode all documents."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    done = decode(encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN), path)
    return done.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {"op1_byte_bpe": byte_bpe}
SQL: dict[str, str] = {}
