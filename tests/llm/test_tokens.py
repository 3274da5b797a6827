"""Encoding, id files and packing against the tokenizer libraries."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallymatch.llm import bit_planes, byte_bpe, packing
from tallymatch.llm.chunks import ChunkEncoder, cut
from tallymatch.llm.library_tokens import LibraryChunks, WordEncoder, library_encoder

SF = "/root/testdata/sf0.001"


def as_bytes(ids):
    return np.array(ids, dtype="<u4").tobytes()


@pytest.fixture(scope="module")
def tik():
    path = P.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def library(name):
    t = Tokenizer.from_file(P.path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


PARTS = [*"ab-= \n\té\x1c\x85'sT1日ſİΣ", "  ", "the", "\U0001f600", "\u3000", "a\u0301", "aaaa", "<|endoftext|>"]
ODD = st.lists(st.sampled_from(PARTS), max_size=60).map("".join) | st.text(max_size=60)
REPLAY = ChunkEncoder(byte_bpe.Replayer(P.path("byte_bpe_50k.tiktoken"), P.PATTERN), memo=20)
LIBRARY = {n: ChunkEncoder(LibraryChunks(P.path(n)), memo=20) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")}


@given(ODD)
def test_cut_loses_nothing(text):
    assert " ".join(cut(text)) == text


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_replay_is_tiktoken(tik, text):
    assert REPLAY([text])[0] == as_bytes(tik.encode_ordinary(text))


@settings(max_examples=200, deadline=None)
@given(ODD, st.sampled_from(sorted(LIBRARY)))
def test_chunks_are_the_library(text, name):
    assert LIBRARY[name]([text, text + " x"])[0] == as_bytes(library(name)(text))


WORDS = WordEncoder(LibraryChunks(P.path("word_bpe_49k.json")), memo=20)


@settings(max_examples=300, deadline=None)
@given(st.lists(ODD | st.text(st.characters(max_codepoint=0x24F), max_size=40), max_size=4))
def test_words_are_the_library(texts):
    encode = library("word_bpe_49k.json")
    assert WORDS(texts) == [as_bytes(encode(t)) for t in texts]


def test_words_of_every_plain_character():
    """Case, letters, numbers and white space as the library has them, beside letters, digits, quotes, spaces, itself."""
    encode = library("word_bpe_49k.json")
    texts = [f"a{c}b {c} 1{c}2 '{c}s's{c}{c} -{c}'LL'{c}" for c in map(chr, range(0x252))]
    assert WORDS(texts) == [as_bytes(encode(t)) for t in texts]


def test_plain_texts_meet_python_once_a_piece(monkeypatch):
    """Arrow splits whole plain texts: no chunk is searched, and each distinct piece is encoded once."""
    seen, piece = [], LibraryChunks._piece

    def chunk_by_chunk(self, chunks):
        assert not chunks
        return []

    monkeypatch.setattr(LibraryChunks, "__call__", chunk_by_chunk)
    monkeypatch.setattr(LibraryChunks, "_piece", lambda self, p: seen.append(p) or piece(self, p))
    encode = library_encoder.__wrapped__(P.path("word_bpe_49k.json"))
    text = "The fox, the FOX; it's 1 fox\n" * 50
    assert encode([text, "", text]) == [as_bytes(library("word_bpe_49k.json")(t)) for t in (text, "", text)]
    assert sorted(seen) == sorted({"", "the", "fox", ",", ";", "it", "'s", "1"})


def test_a_strange_word_does_not_slow_its_text(monkeypatch):
    """Only words with characters that are not plain go through the whole library, each once."""
    seen, word = [], WordEncoder._word
    monkeypatch.setattr(WordEncoder, "_word", lambda self, w: seen.append(w) or word(self, w))
    encode = library_encoder.__wrapped__(P.path("word_bpe_49k.json"))
    texts = ["Größe “so” the fox\nІ the “so” fox’s", "the fox", "\u0301x the a\u3000b İ"]
    assert encode(texts) == [as_bytes(library("word_bpe_49k.json")(t)) for t in texts]
    assert sorted(seen) == sorted({"“so”", "І", "fox’s", "\u0301x", "a\u3000b", "İ"})


def test_replay_goes_back_to_an_earlier_rank():
    """A merge may make a pair whose rank is lower than its own."""

    class Tiny(byte_bpe.Merges):
        def __init__(self):
            self.ranks = {bytes([b]): b for b in range(256)}
            self.ranks |= {b"abc": 256, b"ab": 257, b"bc": 258}
            self.values = [p for p, _ in sorted(self.ranks.items(), key=lambda x: x[1])]
            single = [bytes([b]) for b in range(256)]
            self.byte_ids = np.arange(256)
            self.byte_pairs = np.array([self.ranks.get(x + y, -1) for x in single for y in single])
            self.pairs = {}

    assert byte_bpe.replay([b"abcab", b"bcbc", b"a", b"zz"], Tiny()) == [[256, 257], [258, 258], [97], [122, 122]]


def test_byte_bpe(spark, texts, tik):
    got = {r.doc_id: r for r in byte_bpe.byte_bpe(spark, SF).collect()}
    assert len(got) == len(texts)
    for key, text in texts.items():
        ids = tik.encode_ordinary(text)
        assert got[key].n_tokens == len(ids)
        assert got[key].ids_sha256 == hashlib.sha256(as_bytes(ids)).hexdigest()
        assert got[key].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_byte_bpe_cases(nasty, empty, tik):
    path = P.path("byte_bpe_50k.tiktoken")
    rows = byte_bpe.decode(byte_bpe.encode(nasty, path, P.PATTERN), path).collect()
    want = sorted((r.doc_id or -1, r.text or "") for r in nasty.collect())
    assert sorted((r.doc_id or -1, bytes(r.decoded).decode()) for r in rows) == want
    by_text = {bytes(r.decoded).decode(): bytes(r.ids) for r in rows}
    assert all(by_text[t] == as_bytes(tik.encode_ordinary(t)) for _, t in want)
    assert byte_bpe.decode(byte_bpe.encode(empty, path, P.PATTERN), path).count() == 0


def id_rows(pairs, encode, end):
    start, rows = 0, []
    for key, text in pairs:
        ids = [*encode(text), end]
        rows.append((key, start, len(ids), zlib.crc32(as_bytes(ids))))
        start += len(ids)
    return rows


def test_bit_planes(spark, texts):
    got = sorted(tuple(r) for r in bit_planes.bit_planes(spark, SF).collect())
    assert got == id_rows(sorted(texts.items()), library("word_bpe_49k.json"), 1)


@pytest.mark.parametrize("chunk_ids", [7, 1 << 16])
def test_bit_planes_cases(spark, nasty, empty, folder, chunk_ids):
    """Chunks far smaller than documents, ties in doc_id, null id first; the ids themselves come back."""
    path, encode = bit_planes.tokenizer_path(), library("word_bpe_49k.json")
    bit_planes.write_ids(nasty, f"{folder}/ids", path, chunk_ids=chunk_ids, shards=3)
    rows = bit_planes.read_ids(spark, f"{folder}/ids").orderBy("start").collect()
    pairs = sorted(((r.doc_id, r.text or "") for r in nasty.collect()), key=lambda p: (p[0] is not None, p[0] or 0, p[1]))
    assert [tuple(r)[:4] for r in rows] == id_rows(pairs, encode, 1)
    assert [bytes(r.ids) for r in rows] == [as_bytes([*encode(t), 1]) for _, t in pairs]
    chunks = spark.read.parquet(f"{folder}/ids").collect()
    assert all(c.n_ids <= chunk_ids for c in chunks)
    bit_planes.write_ids(empty, f"{folder}/none", path)
    assert bit_planes.read_ids(spark, f"{folder}/none").count() == 0


@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_planes_round_trip(ids):
    assert bit_planes.from_planes(bit_planes.to_planes(as_bytes(ids)), len(ids)) == as_bytes(ids)


def check_places(rows, capacity):
    """Rows (length, sequence, offset): gapless from 0, within capacity; gives the number of sequences."""
    found = defaultdict(list)
    for length, sequence, offset in rows:
        found[sequence].append((offset, length))
    for parts in found.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(found)


def test_packing(spark, texts):
    encode = library("byte_bpe_50k.json")
    rows = packing.best_fit_packing(spark, SF).collect()
    want, total = [], 0
    for key, text in sorted(texts.items()):
        ids = [*encode(text), 0]
        total += len(ids)
        cuts = list(range(len(ids) % 2048 or 2048, len(ids) + 1, 2048))
        for n, (low, high) in enumerate(zip([0, *cuts], cuts, strict=False)):
            want.append((key, n, low, high - low, zlib.crc32(as_bytes(ids[low:high]))))
    assert sorted(tuple(r)[:5] for r in rows) == want
    used = check_places([(r.length, r.sequence_id, r.offset) for r in rows], 2048)
    assert used <= -(-total // 2048) + 1


def test_packing_cases(spark, nasty, empty, folder):
    pieces = packing.cut_into_pieces(nasty, packing.tokenizer_path(), capacity=64, keep_ids=True)
    pieces.write.parquet(f"{folder}/pieces")
    packed = packing.pack(spark.read.parquet(f"{folder}/pieces"), capacity=64)
    rows = packed.collect()
    check_places([(r.length, r.sequence_id, r.offset) for r in rows], 64)
    encode = library("byte_bpe_50k.json")
    assert sum(r.length for r in rows) == sum(len(encode(r.text or "")) + 1 for r in nasty.collect())
    assert sum(r.doc_id == 8 for r in rows) == 2 and sum(r.doc_id == 2 and r.length == 1 for r in rows) == 1
    ids = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    for r in rows:
        assert ids[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
    assert packing.packed_documents(spark, empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=15))
def test_minimum_slack_holds_everything(histogram):
    patterns = packing.minimum_slack(histogram, 40)
    held = defaultdict(int)
    for times, pattern in patterns:
        assert times > 0 and sum(length * n for length, n in pattern) <= 40
        for length, n in pattern:
            held[length] += times * n
    assert held == histogram


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 30), st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=6))
def test_fullest_is_fullest(room, counts):
    """Against all combinations."""
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1)}
    found = packing.fullest(room, sorted(counts, reverse=True), counts)
    assert all(n <= counts[length] for length, n in found)
    assert sum(length * n for length, n in found) == max(s for s in sums if s <= room)
