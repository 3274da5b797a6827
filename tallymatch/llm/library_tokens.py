"""Token ids of the ``tokenizers`` library, with pieces that repeat encoded once per worker.

The library's model encodes each piece (a match of the file's own split pattern).  Chunks of
letters below U+0250 are normalised and split here, where NFC changes nothing and letter classes
agree between libraries; any other chunk goes through the whole library.  Where white space is in
no piece, Arrow splits whole texts; Python sees their distinct pieces, and words with other letters.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .chunks import ChunkEncoder, forget, packed, splitter

#: How byte-level vocabularies write a byte: printable ones as they are, the others from
#: U+0100 on, in order (fixed by the vocabulary files).
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_TEXT = {b: chr(b) for b in _SHOWN} | {
    b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in set(_SHOWN))
}

#: The split that a ByteLevel pre-tokenizer makes when its file gives no pattern (fixed value).
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: The pattern of a word vocabulary (fixed by its file): white space is in no piece.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: For Arrow: white space below U+0250; the pieces that are no run of letters, which need a space on both sides; and
#: what is not plain, from U+0250 on and the one letter below whose lower case has two.
SPACE = r"\t-\r \x{85}\x{a0}"
APART = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"
NOT_PLAIN = r"[^\x{0}-\x{12f}\x{131}-\x{24f}]"

PIECES = 200_000
WORDS = 400_000
PLAIN_END = "ɐ"


class LibraryChunks:
    """Gives the bytes (little-endian unsigned 32-bit ids) of chunks of text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks use the cores
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec["pre_tokenizer"]
        patterns = [
            p["pattern"]["Regex"] for p in split.get("pretokenizers", ()) if p["type"] == "Split"
        ]
        self.find = splitter(patterns[0] if patterns else BYTE_LEVEL_PATTERN)
        self.lower = "Lowercase" in json.dumps(spec.get("normalizer"))
        self.words = self.lower and patterns == [WORD_PATTERN]
        self.tokenize = self.whole.model.tokenize
        self.bytes_of = [packed([k]) for k in range(self.whole.get_vocab_size())]
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isalpha() and piece.isascii() else piece.encode().decode("latin-1").translate(BYTE_TEXT)
        bytes_of = self.bytes_of
        return b"".join([bytes_of[t.id] for t in self.tokenize(shown)])

    def __call__(self, chunks: list[str]) -> list[bytes]:
        pieces = self.pieces
        out, added = [], []
        for chunk in chunks:
            if chunk.isascii() or max(chunk) < PLAIN_END:
                found = self.find(chunk.lower() if self.lower else chunk)
                for piece in found:
                    if piece not in pieces:
                        pieces[piece] = self._piece(piece)
                        added.append(piece)
                out.append(pieces[found[0]] if len(found) == 1 else b"".join(map(pieces.__getitem__, found)))
            else:
                out.append(packed(self.whole.encode(chunk, add_special_tokens=False).ids))
        if len(pieces) > PIECES:
            forget(pieces, added)
        return out


class WordEncoder:
    """Gives the bytes of the ids of texts under ``WORD_PATTERN``."""

    def __init__(self, library: LibraryChunks, memo: int = WORDS):
        self.piece, self.whole, self.limit = library._piece, library.whole, memo
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        return packed(self.whole.encode(word, add_special_tokens=False).ids)

    def _known(self, memo: dict[str, bytes], keys: list[str], encode: Callable[[str], bytes]) -> list[bytes]:
        """The bytes of distinct pieces or words."""
        values, added = list(map(memo.get, keys)), {}
        for k, value in enumerate(values):
            if value is None:
                values[k] = added[keys[k]] = encode(keys[k])
        if len(memo) + len(added) <= self.limit:
            memo.update(added)
        return values

    def _plain(self, texts: pa.Array) -> list[bytes]:
        spaced = pc.utf8_lower(pc.replace_substring_regex(texts, pattern=f"[{SPACE}]", replacement=" "))
        lists = pc.split_pattern(pc.replace_substring_regex(spaced, pattern=APART, replacement=r" \0 "), " ")
        coded = lists.flatten().dictionary_encode()
        # The empty piece between two spaces has no ids.
        values = self._known(self.pieces, _strings(coded.dictionary), self.piece)
        return _joined(values, coded.indices, lists)

    def _mixed(self, texts: pa.Array) -> list[bytes]:
        """Cut at white space, where every piece ends; only words that are not plain go through the whole library."""
        spaced = pc.replace_substring_regex(texts, pattern=r"[\t-\r]", replacement=" ")
        lists = pc.split_pattern(spaced, " ")
        coded = lists.flatten().dictionary_encode()
        other = pc.match_substring_regex(coded.dictionary, NOT_PLAIN)
        words = _strings(coded.dictionary.filter(other))
        plain = self._plain(coded.dictionary.filter(pc.invert(other)))
        return _joined(_merged(other, self._known(self.words, words, self._word), plain), coded.indices, lists)

    def __call__(self, texts: list[str]) -> list[bytes]:
        column = pa.array(texts, pa.large_string())
        other = pc.match_substring_regex(column, NOT_PLAIN)
        return _merged(other, self._mixed(column.filter(other)), self._plain(column.filter(pc.invert(other))))


def _strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


def _merged(which: pa.Array, where_true: list[bytes], where_false: list[bytes]) -> list[bytes]:
    true, false = iter(where_true), iter(where_false)
    return [next(true if w else false) for w in which.to_numpy(zero_copy_only=False).tolist()]


def _joined(values: list[bytes], indices: pa.Array, lists: pa.ListArray) -> list[bytes]:
    """For each list, the values at the indices of its elements, one after the other."""
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
    found = pa.array(values, pa.large_binary()).take(indices)
    places = np.concatenate([[0], np.cumsum(pc.binary_length(found).to_numpy())])[ends].tolist()
    data = memoryview(found.buffers()[2] or b"")
    return [bytes(data[low:high]) for low, high in zip(places, places[1:], strict=False)]


@lru_cache(maxsize=4)
def library_encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """One encoder for each worker and vocabulary file."""
    library = LibraryChunks(path)
    return WordEncoder(library) if library.words else ChunkEncoder(library)
