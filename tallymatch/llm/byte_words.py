"""Words of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

import numpy as np

from .minhash import mixed

#: A word is followed by one of these: a space, or an end where the separators say so.
SPACE, END = 32, 10

#: Kinds of bytes: of a word, between words, and between words that do not follow each other.
OF_WORD, BETWEEN, PARTING = range(3)

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))  # A-Z only

#: Bytes of a word that are hashed at once, and what to keep of them where only the first few are the word's.
LOADED = 8
ONES = np.array([(1 << 8 * k) - 1 for k in range(LOADED + 1)], dtype="<u8")

#: Longer words are hashed one by one.
CHAINED_BYTES = 64


def byte_kinds(between: bytes, parting: bytes = b"") -> np.ndarray:
    kinds = np.full(256, OF_WORD, dtype=np.uint8)
    kinds[list(between)] = BETWEEN
    kinds[list(parting)] = PARTING
    return kinds


class ByteWords:
    """Lower-cased words of several texts in one array, each followed by one separating byte.

    ``starts`` and ``ends`` are places in ``bytes``; ``document`` says which text a word is of, ``counts``
    how many words each text has, and ``last`` whether an end follows a word.  No word crosses texts.
    """

    def __init__(self, texts: list[str], kinds: np.ndarray):
        encoded = [t.encode("utf-8", "surrogatepass").translate(LOWER) for t in texts]
        whole = b"\n".join(encoded) + b"\n"  # a line break separates in all uses
        raw = np.frombuffer(whole, dtype=np.uint8)
        found = np.frombuffer(whole.translate(kinds.tobytes()), dtype=np.uint8)
        kept = found == OF_WORD
        edges = np.flatnonzero(kept[1:] != kept[:-1]) + 1
        if kept[0]:
            edges = np.concatenate([[0], edges])
        first, run = edges[::2], edges[1::2]  # a separator is last, so every word has an end
        lengths = run - first
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths
        kept[run] = True
        self.padded = np.concatenate([raw[kept], np.zeros(LOADED, dtype=np.uint8)])
        self.bytes = self.padded[:-LOADED]
        self.last = np.zeros(len(run), dtype=bool)
        ending = np.searchsorted(run, np.flatnonzero(found == PARTING), side="right") - 1
        self.last[ending[ending >= 0]] = True
        self.bytes[self.ends] = np.where(self.last, np.uint8(END), np.uint8(SPACE))
        size = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded)) + 1
        self.counts = np.diff(np.searchsorted(first, np.cumsum(size)), prepend=0)
        self.document = np.repeat(np.arange(len(texts)), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of the bytes of every word, eight at a time; a digest of a long one."""
        import xxhash

        lengths = self.ends - self.starts
        hashes = mixed(lengths.astype(np.uint64))
        loads = np.ndarray(len(self.bytes) + 1, dtype="<u8", buffer=self.padded, strides=(1,))
        part = loads[self.starts] & ONES[np.minimum(lengths, LOADED)]
        hashes = mixed(hashes + part)
        more = np.flatnonzero((lengths > LOADED) & (lengths <= CHAINED_BYTES))
        at = LOADED
        while len(more):
            part = loads[self.starts[more] + at] & ONES[np.minimum(lengths[more] - at, LOADED)]
            hashes[more] = mixed(hashes[more] + part)
            at += LOADED
            more = more[lengths[more] > at]
        for k in np.flatnonzero(lengths > CHAINED_BYTES):
            hashes[k] = mixed(np.uint64([xxhash.xxh3_64_intdigest(self.bytes[self.starts[k] : self.ends[k]].tobytes())]))[0]
        return hashes
