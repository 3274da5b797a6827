"""Encode texts chunk by chunk, so that what repeats is encoded once per worker.

A text is cut only where every tokenizer used here has a border anyway: before a single
space that stands between two characters that are not white space.  Then the ids of a
text are the ids of its chunks, one after the other, and chunks that were met before come
from a memo.  The memo is bounded and only saves time: when it is full, it keeps what it has
(the frequent chunks come early) and forgets what a slice adds once the slice is done.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable

import regex

MEMO_CHUNKS = 300_000


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """``findall`` of a split pattern; a chunk of ASCII letters alone needs no search.

    Where the pattern takes letters in a row as one piece, such a chunk is one piece, with the space
    before it or without, as the pattern has it for any letter.
    """
    find = regex.compile(pattern).findall
    if not regex.search(r"\\p\{L\}\]?\+", pattern):
        return find
    spaced = find(" a") == [" a"]

    def split(chunk: str) -> list[str]:
        if chunk.isascii():
            word = chunk[1:] if chunk[:1] == " " else chunk
            if word.isalpha():
                return [chunk if spaced else word]
        return find(chunk)

    return split


def _open(part: str) -> bool:
    """Empty, or with white space (in the widest sense) at an end."""
    return not part or part.strip() is not part


def cut(text: str) -> list[str]:
    """Chunks of ``text``: all but the first lack the space they begin with."""
    parts = text.split(" ")
    chunks, open_parts = [], [parts[0]]
    for before, part in zip(parts, parts[1:], strict=False):
        if before and part and not before[-1].isspace() and not part[0].isspace():
            chunks.append(" ".join(open_parts))
            open_parts = [part]
        else:
            open_parts.append(part)
    chunks.append(" ".join(open_parts))
    return chunks


def forget(memo: dict, keys: Iterable) -> None:
    for key in keys:
        del memo[key]


class ChunkEncoder:
    """``encode`` takes distinct chunks, spaces included, and gives the bytes of the ids of each."""

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]], memo: int = MEMO_CHUNKS):
        self.encode, self.limit = encode, memo
        self.heads: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def _learn(self, memo: dict[str, bytes], chunks: list[str], before: str) -> None:
        memo.update(zip(chunks, self.encode([before + c for c in chunks]), strict=True))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The bytes of the ids of each text."""
        split, heads, tails = [], set(), set()
        for text in texts:
            parts = text.split(" ")
            unknown = set(parts[1:]).difference(self.tails)
            if _open(parts[0]) or any(map(_open, unknown)):
                parts = cut(text)
                unknown = set(parts[1:]).difference(self.tails)
            heads.add(parts[0])
            tails |= unknown
            split.append(parts)
        self._learn(self.heads, list(heads), "")
        self._learn(self.tails, list(tails), " ")
        known = self.tails.__getitem__
        found = [self.heads[parts[0]] + b"".join(map(known, parts[1:])) for parts in split]
        self.heads.clear()
        if len(self.tails) > self.limit:
            forget(self.tails, tails)
        return found
