"""Phrase collocations: Apriori candidates in broadcast double-array tries.

1. Words and then phrases, one length after the other, are counted by 64-bit hashes, each
   task sending the distinct hashes of its texts.  A phrase is counted only where both of its parts
   that are one word shorter were frequent, told by a bitmap of bounded size.  Hashes that
   collide add to each other and bitmaps let strangers pass, so nothing frequent is ever lost:
   what comes out is a safe set of candidates.
2. The candidates' words are read off the texts once, and sorted by language and bytes
   into double-array tries of at most ``TRIE_KEYS`` keys, built in tasks.
3. Groups of tries of bounded size are broadcast.  In each task, the states of all word
   starts of a slice of texts advance together, one byte a level; a state with one key left
   compares the rest of it at once.  Accepted keys are counted by bincount, and tasks' counts, sent in
   chunks of keys, are summed.  These counts are exact.  More candidates than one group holds take
   more passes; the first one also counts all words of each language.
4. Scores, containment and ranks are SQL.

All work on texts is numpy over the bytes of a slice; only candidates become strings.

Defined cases: a null text is an empty one; a null ``lang`` is ``und``, together with rows that
say so; words of any length are compared whole; repeated rows count each; phrases of equal score
and frequency are ordered by bytes; an empty table gives no rows; ``doc_id`` may be null
or repeated; only ``text`` and ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bitmaps import Bitmap
from .byte_words import END, LOADED, ONES, SPACE, ByteWords, byte_kinds
from .common import fresh_folder, ship, slices, stored, table
from .minhash import mixed

#: Hashes that a task holds before it sends their distinct ones.
HELD = 4_000_000
#: Keys of a trie, and bytes of tries that one pass broadcasts (a single trie may exceed them).
TRIE_KEYS = 1 << 18
TRIE_BYTES = 8 << 20
PASS_BYTES = 48 << 20

#: Keys of a trie whose counts a task sends together.
CHUNK = 1 << 12
#: The chunk, and the place in it, that stands for all words of a language.
WORDS = -1

KINDS = byte_kinds(between=b" \t", parting=b".,;:!?\n\x0b\x0c\r")


@dataclass(frozen=True)
class Settings:
    """Phrases of 2 to ``words`` words, found ``least`` times; ``contained`` percent of a phrase
    within a longer one drop it; the first ``top`` of each language."""

    words: int = 3
    least: int = 10
    contained: int = 50
    top: int = 2000
    scale: int = 1_000_000


QUERY = Settings()


class Words(ByteWords):
    """The words of several texts; one is followed by a space if the next word is in the same piece, else by an end."""

    def __init__(self, texts: list[str], langs: list[str]):
        import xxhash

        super().__init__(texts, KINDS)
        self.texts = np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) for t in texts], dtype=np.uint64)
        self.langs = sorted(set(langs))
        of_lang = {lang: k for k, lang in enumerate(self.langs)}
        self.lang = np.repeat(np.array([of_lang[lang] for lang in langs], dtype=np.int64), self.counts)
        self.salts = np.array([xxhash.xxh3_64_intdigest(lang.encode()) for lang in self.langs], dtype=np.uint64)
        self.hashed: np.ndarray | None = None

    def hashes(self) -> np.ndarray:
        """A hash of the language and the bytes of every word."""
        if self.hashed is None:
            self.hashed = mixed(super().hashes() ^ self.salts[self.lang])
        return self.hashed

    def marks(self, at: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """A hash of each phrase (first word, hash) together with the text it stands in."""
        return mixed(hashes ^ self.texts[self.document[at]])

    def longer(self, length: int, at: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of all phrases one word longer than the given ones whose both parts are given."""
        both = at[1:] == at[:-1] + 1
        if length == 1:
            both &= ~self.last[at[:-1]]
        both = np.flatnonzero(both)
        at = at[both]
        return at, mixed(hashes[both] * np.uint64(3) + self.hashes()[at + length])

    def may_be_frequent(self, frequent: list[Bitmap]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(first word, hash) of the phrases of each length, from one word on, that may be frequent, as may their parts."""
        at, hashes = np.arange(len(self.starts)), self.hashes()
        for length, bitmap in enumerate(frequent, 1):
            if length > 1:
                at, hashes = self.longer(length - 1, at, hashes)
            fits = np.flatnonzero(bitmap.holds(hashes))
            at, hashes = at[fits], hashes[fits]
            yield at, hashes

    def phrases(self, length: int, frequent: list[Bitmap]) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of all phrases of a length whose shorter parts may be frequent."""
        if length == 1:
            return np.arange(len(self.starts)), self.hashes()
        *_, parts = self.may_be_frequent(frequent[: length - 1])
        return self.longer(length - 1, *parts)

    def text(self, first: int, length: int) -> str:
        return self.bytes[self.starts[first] : self.ends[first + length - 1]].tobytes().decode("utf-8", "surrogatepass")


def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """From batches of (lang, text)."""
    for langs, texts in slices(batches):
        yield Words(texts, langs)


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").alias("text"))


def grouped(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, a place and the number of each.

    Sorted by their high bits alone, with places in the low ones, which is several times as fast as
    sorting places by hashes.  Hashes that agree in all high bits may come in several parts.
    """
    low = np.uint64((1 << len(hashes).bit_length()) - 1)
    order = hashes & ~low | np.arange(len(hashes), dtype=np.uint64)
    order.sort()
    order = (order & low).view(np.int64)
    hashes = hashes[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(len(hashes), 1), dtype=bool), hashes[1:] != hashes[:-1]]))
    return hashes[first], order[first], np.diff(first, append=len(hashes))


def frequent_hashes(docs: DataFrame, length: int, frequent: list[Broadcast], least: int) -> DataFrame:
    """(hash, n, mark) of phrases of that length, at least ``least`` of them, by hash.

    The mark belongs to one text that has the phrase, whichever has the least.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def sent() -> pa.RecordBatch:
            none = np.zeros(0, dtype=np.uint64)
            hashes, marks = (np.concatenate([none, *columns]) for columns in (zip(*held) if held else ((), ())))
            held.clear()
            found, place, n = grouped(hashes)
            columns = {"hash": found.view(np.int64), "n": n, "mark": marks[place].view(np.int64)}
            return pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})

        for words in words_of(batches):
            at, hashes = words.phrases(length, [b.value for b in frequent])
            held.append((hashes, words.marks(at, hashes)))
            if sum(len(h) for h, _ in held) > HELD:
                yield sent()
        yield sent()

    counted = _source(docs).mapInArrow(run, "hash long, n long, mark long")
    summed = counted.groupBy("hash").agg(F.sum("n").alias("n"), F.min("mark").alias("mark"))
    return summed.where(F.col("n") >= least)


def candidate_texts(docs: DataFrame, frequent: list[Broadcast], owned: Broadcast) -> DataFrame:
    """(lang, phrase) of all phrases of two words or more whose hash may be frequent.

    Read off the text whose mark was kept with the hash (``owned``) and its copies, so that not
    every task sends every frequent phrase.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps, sent = [b.value for b in frequent], np.zeros(0, dtype=np.uint64)
        for words in words_of(batches):
            langs, phrases = [], []
            for length, (at, hashes) in enumerate(words.may_be_frequent(bitmaps), 1):
                if length == 1:
                    continue
                fits = owned.value.holds(words.marks(at, hashes))
                hashes, where = np.unique(hashes[fits], return_index=True)
                place = np.minimum(np.searchsorted(sent, hashes), max(0, len(sent) - 1))
                new = sent[place] != hashes if len(sent) else np.ones(len(hashes), dtype=bool)
                at = at[fits][where[new]]
                langs += [words.langs[k] for k in words.lang[at]]
                phrases += [words.text(k, length) for k in at]
                sent = hashes if len(sent) > HELD else np.sort(np.concatenate([sent, hashes[new]]), kind="stable")
            yield pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()), "phrase": pa.array(phrases, pa.string())})

    return _source(docs).mapInArrow(run, "lang string, phrase string").distinct()


def loads(data: np.ndarray) -> np.ndarray:
    """The eight bytes that begin at every place of ``data`` and at its end, with zeros behind it."""
    padded = np.concatenate([data, np.zeros(LOADED, dtype=np.uint8)])
    return np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))


class DoubleArray:
    """A trie of sorted byte strings: child of state s by byte c is base[s] + c if check says so.

    Bytes are coded by how often the keys have them, so that codes of siblings lie close.  Built level by
    level: several children of a state get a span of free slots of their own, and single
    children fill what spans leave open.  A state with one key left ends there: its base is
    -1 - key, and the rest of the key is kept as a tail.
    """

    FIRST = 256  # so that a base is never below 1

    def __init__(self, base, check, key, tails, tail_starts, codes):
        self.base, self.check, self.key, self.tails, self.tail_starts = base, check, key, tails, tail_starts
        self.codes = codes
        self.nodes = np.stack([base, check], axis=1).view(np.int64).ravel()  # both are looked up at once
        self.tail_loads = loads(tails)

    @classmethod
    def build(cls, keys: list[bytes]) -> DoubleArray:
        data = np.frombuffer(b"".join(keys) + b"\0", dtype=np.uint8)
        lengths = np.fromiter(map(len, keys), dtype=np.int64, count=len(keys))
        offsets = np.cumsum(lengths) - lengths
        codes = np.zeros(256, dtype=np.uint8)
        codes[np.argsort(-np.bincount(data, minlength=256), kind="stable")] = np.arange(256)
        states, low, high = np.zeros(1, np.int64), np.zeros(1, np.int64), np.full(1, len(keys), np.int64)
        bases, checks, own = [], [], []
        tail_from = lengths.copy()
        holes, free, depth = np.zeros(0, np.int64), cls.FIRST, 0
        while len(states):
            alone = high - low == 1
            bases.append((states[alone], -1 - low[alone]))
            tail_from[low[alone]] = depth
            states, low, high = states[~alone], low[~alone], high[~alone]
            ended = lengths[low] == depth
            own.append((states[ended], low[ended]))
            low = low + ended
            # All keys below the states, and where a state or its next byte changes.
            count = high - low
            parent = np.repeat(np.arange(len(states)), count)
            index = np.arange(len(parent)) + np.repeat(low - (np.cumsum(count) - count), count)
            byte = codes[data[offsets[index] + depth]].astype(np.int64)
            first = np.ones(len(index), dtype=bool)
            first[1:] = (parent[1:] != parent[:-1]) | (byte[1:] != byte[:-1])
            at = np.flatnonzero(first)
            parent, byte = parent[at], byte[at]
            children = np.bincount(parent, minlength=len(states))
            start = np.cumsum(children) - children
            least, most = (f.reduceat(byte, start) if len(start) else start for f in (np.minimum, np.maximum))
            many = children > 1
            base = np.zeros(len(states), dtype=np.int64)
            spans = np.where(many, most - least + 1, 0)
            base[many] = (free + np.cumsum(spans) - spans - least)[many]
            end = free + int(spans.sum())
            # Single children: open slots first, new ones after them.
            singles = np.flatnonzero(~many)
            slots = np.concatenate([holes[: len(singles)], end + np.arange(max(0, len(singles) - len(holes)))])
            holes = holes[len(singles) :]
            base[singles] = slots - least[singles]
            taken = base[parent] + byte
            open_ = np.ones(end - free, dtype=bool)
            inside = taken[(taken >= free) & (taken < end)]
            open_[inside - free] = False
            holes = np.concatenate([holes, free + np.flatnonzero(open_)])
            free = max(end, int(slots.max()) + 1 if len(slots) else 0)
            bases.append((states, base))
            checks.append((taken, states[parent]))
            high = low.copy() if not len(at) else index[np.append(at[1:], len(index)) - 1] + 1
            states, low, depth = taken, index[at], depth + 1
        size = free + 256
        out = {n: np.full(size, v, dtype=np.int32) for n, v in (("base", 1), ("check", -1), ("key", -1))}
        for name, parts in (("base", bases), ("check", checks), ("key", own)):
            for where, values in parts:
                out[name][where] = values
        tail = lengths - tail_from
        tail_starts = np.concatenate([[0], np.cumsum(tail)]).astype(np.int64)
        picked = np.arange(int(tail.sum())) + np.repeat(offsets + tail_from - tail_starts[:-1], tail)
        return cls(out["base"], out["check"], out["key"], data[picked], tail_starts, codes)

    @property
    def size(self) -> int:
        return len(self.tail_starts) - 1

    def counts(self, text: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """How often each key stands at a start, followed by the end of a word."""
        ends, text_loads = (text == SPACE) | (text == END), loads(text)
        coded = np.frombuffer(text.tobytes().translate(self.codes.tobytes()), dtype=np.uint8)
        hits = [np.zeros(0, dtype=np.int64)]
        at, state = starts, np.zeros(len(starts), dtype=np.int64)
        base = np.full(len(starts), self.base[0], dtype=np.int64)
        while len(at):
            alone = base < 0
            if alone.any():
                hits.append(self._tails(text, text_loads, ends, at[alone], -1 - base[alone]))
                going = np.flatnonzero(~alone)
                at, state, base = at[going], state[going], base[going]
            key = self.key[state[ends[at]]]
            hits.append(key[key >= 0].astype(np.int64))
            child = base + coded[at]
            node = self.nodes[child].view(np.int32)
            on = np.flatnonzero(node[1::2] == state)
            at, state, base = at[on] + 1, child[on], node[::2][on].astype(np.int64)
        return np.bincount(np.concatenate(hits), minlength=self.size)

    def _tails(self, text: np.ndarray, text_loads: np.ndarray, ends: np.ndarray, at: np.ndarray, key: np.ndarray) -> np.ndarray:
        first = self.tail_starts[key]
        length = self.tail_starts[key + 1] - first
        inside = np.flatnonzero((text_loads[at] ^ self.tail_loads[first]) & ONES[np.minimum(length, LOADED)] == 0)
        at, key, length, first = at[inside], key[inside], length[inside], first[inside]
        inside = np.flatnonzero(ends[np.minimum(at + length, len(text) - 1)] & (at + length < len(text)))
        at, key, length, first = at[inside], key[inside], length[inside], first[inside]
        found = np.ones(len(at), dtype=bool)
        some = np.flatnonzero(length > LOADED)
        if len(some):
            at, length, first = at[some], length[some], first[some]
            begin = np.cumsum(length) - length
            step = np.arange(int(length.sum()))
            equal = text[step + np.repeat(at - begin, length)] == self.tails[step + np.repeat(first - begin, length)]
            found[some] = np.logical_and.reduceat(equal, begin)
        return key[found]


TRIE = "trie string, lang string, base binary, checks binary, keys binary, tails binary, starts binary, codes binary, phrases array<string>"


def built_tries(keys: DataFrame, folder: str, trie_keys: int = TRIE_KEYS) -> DataFrame:
    """One row a trie: its arrays, and its phrases in order.  Keys are (lang, phrase), distinct."""
    spark = keys.sparkSession
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        held, bytes_held, of_lang = [], 0, None

        def built() -> pa.RecordBatch:
            encoded = [p.encode("utf-8", "surrogatepass") for p in held]
            t = DoubleArray.build(encoded)
            name = xxhash.xxh3_128_hexdigest(f"{of_lang}\n{held[0]}".encode("utf-8", "surrogatepass"))
            arrays = (t.base, t.check, t.key, t.tails, t.tail_starts, t.codes)
            names = ("base", "checks", "keys", "tails", "starts", "codes")
            return pa.RecordBatch.from_pydict(
                {
                    "trie": [name],
                    "lang": [of_lang],
                    **{n: pa.array([a.tobytes()], pa.binary()) for n, a in zip(names, arrays, strict=True)},
                    "phrases": pa.array([held], pa.list_(pa.string())),
                }
            )

        for batch in batches:
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and (lang != of_lang or len(held) >= trie_keys or bytes_held >= TRIE_BYTES):
                    yield built()
                    held, bytes_held = [], 0
                held.append(phrase)
                of_lang, bytes_held = lang, bytes_held + len(phrase)
        if held:
            yield built()

    parts = max(1, keys.count() // trie_keys)
    ordered = keys.select("lang", "phrase").repartitionByRange(parts, "lang", "phrase").sortWithinPartitions("lang", "phrase")
    return stored(ordered.mapInArrow(run, TRIE), folder)


def counted_phrases(docs: DataFrame, tries: DataFrame, folder: str, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(lang, phrase, f) of all keys."""
    return named(tries, counts_of(docs, tries, folder, pass_bytes))


def named(tries: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, phrase, f) from the ``counts_of`` tries."""
    listed = tries.select(F.col("trie").alias("name"), "lang", F.posexplode("phrases").alias("at", "phrase"))
    return listed.join(counts.hint("merge"), ["name", "at"]).select("lang", "phrase", "f")


def counts_of(docs: DataFrame, tries: DataFrame, folder: str, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(name, at, f): of each trie by its name, how often its keys stand in the texts, and under the name
    of each language, at -1, its number of words; in as many passes over the texts as bounded broadcasts take."""
    sizes = tries.select(
        "trie", sum((F.octet_length(c) for c in ("base", "checks", "keys", "tails", "starts")), F.lit(0)).alias("bytes")
    )
    groups, held = [[]], 0
    for row in sorted(sizes.collect()):  # a row for every half million candidates
        if groups[-1] and held + row.bytes > pass_bytes:
            groups.append([])
            held = 0
        groups[-1].append(row.trie)
        held += row.bytes
    counts = None
    for step, names in enumerate(groups):
        found = stored(_counted(docs, tries.where(F.col("trie").isin(names)), step == 0), f"{folder}/{step}")
        counts = found if counts is None else counts.union(found)
    return counts


def _counted(docs: DataFrame, tries: DataFrame, with_words: bool) -> DataFrame:
    dtypes = {"base": np.int32, "checks": np.int32, "keys": np.int32, "tails": np.uint8, "starts": np.int64, "codes": np.uint8}
    rows = tries.select("trie", "lang", *dtypes).toArrow()  # at most PASS_BYTES, or one trie
    arrays = [[np.frombuffer(c.as_buffer(), dtype=t) for c in rows[n]] for n, t in dtypes.items()]
    loaded = docs.sparkSession.sparkContext.broadcast(
        list(zip(rows["trie"].to_pylist(), rows["lang"].to_pylist(), zip(*arrays, strict=True), strict=True))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = [(name, lang, DoubleArray(*arrays)) for name, lang, arrays in loaded.value]
        totals = [np.zeros(t.size, dtype=np.int64) for _, _, t in tries]
        of_lang: dict[str, int] = {}
        for words in words_of(batches):
            starts = {lang: words.starts[words.lang == k] for k, lang in enumerate(words.langs)}
            for lang, found in starts.items():
                of_lang[lang] = of_lang.get(lang, 0) + len(found)
            for total, (_, lang, trie) in zip(totals, tries, strict=True):
                if lang in starts:
                    total += trie.counts(words.bytes, starts[lang])
        if with_words:
            yield sent([(lang, WORDS, np.zeros(1, np.int64), np.array([n])) for lang, n in of_lang.items()])
        for total, (name, _, _) in zip(totals, tries, strict=True):
            at = np.flatnonzero(total)
            edges = np.searchsorted(at, np.arange(0, len(total) + CHUNK, CHUNK)).tolist()
            parts = [(k, at[low:high]) for k, (low, high) in enumerate(zip(edges, edges[1:])) if high > low]
            yield sent([(name, k, part - k * CHUNK, total[part]) for k, part in parts])

    def sent(rows: list[tuple]) -> pa.RecordBatch:
        names, chunks, at, n = zip(*rows, strict=True) if rows else ((),) * 4
        return pa.RecordBatch.from_pydict(
            {
                "name": pa.array(names, pa.string()),
                "chunk": pa.array(chunks, pa.int32()),
                "at": pa.array([x.astype("<u2").tobytes() for x in at], pa.binary()),
                "n": pa.array([x.astype("<i8").tobytes() for x in n], pa.binary()),
            }
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, total = None, np.zeros(CHUNK, dtype=np.int64)

        def summed() -> pa.RecordBatch:
            name, chunk = of
            at = np.flatnonzero(total)
            place = np.full(len(at), WORDS) if chunk == WORDS else at + chunk * CHUNK
            columns = {"name": pa.array([name] * len(at), pa.string()), "at": pa.array(place.astype(np.int32)), "f": pa.array(total[at])}
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            for name, chunk, at, n in zip(*(batch.column(c) for c in range(4)), strict=True):
                if (name.as_py(), chunk.as_py()) != of:
                    if of is not None:
                        yield summed()
                    of = name.as_py(), chunk.as_py()
                    total[:] = 0
                total[np.frombuffer(at.as_buffer(), dtype="<u2")] += np.frombuffer(n.as_buffer(), dtype="<i8")
        if of is not None:
            yield summed()

    found = _source(docs).mapInArrow(run, "name string, chunk int, at binary, n binary")
    return found.repartition("name", "chunk").sortWithinPartitions("name", "chunk").mapInArrow(add, "name string, at int, f long")


def _part(first: Column, length: Column) -> Column:
    return F.array_join(F.slice("words", first, length), " ")


def scored(counts: DataFrame, totals: DataFrame, settings: Settings) -> DataFrame:
    """The best phrases of each language from exact counts (lang, phrase, f) and totals (lang, n)."""
    listed = counts.withColumn("words", F.split("phrase", " "))
    found = listed.where((F.size("words") >= 2) & (F.col("f") >= settings.least)).withColumnRenamed("f", "a")
    cut = found.withColumn("k", F.explode(F.expr("sequence(1, size(words) - 1)"))).select(
        "lang",
        "phrase",
        "a",
        "k",
        _part(F.lit(1), F.col("k")).alias("first"),
        _part(F.col("k") + 1, F.size("words") - F.col("k")).alias("rest"),
    )
    parts = cut.join(counts.toDF("lang", "first", "l").hint("merge"), ["lang", "first"]).join(
        counts.toDF("lang", "rest", "r").hint("merge"), ["lang", "rest"]
    )
    wide = "decimal(19,0)"
    score = F.expr(
        f"({settings.scale} * (cast(a as {wide}) * cast(a as {wide}))) div (cast(l as {wide}) * cast(r as {wide}))"
    )
    best = (
        parts.groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")
    )
    inner = F.expr(
        "flatten(transform(sequence(2, size(words) - 1), n ->"
        " transform(sequence(1, size(words) - n + 1), i -> array_join(slice(words, i, n), ' '))))"
    )
    longer = found.where(F.size("words") > 2).select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("g"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("g").alias("g"))
    kept = best.join(longer.hint("merge"), ["lang", "phrase"], "left").where(
        F.coalesce(100 * F.col("g") < settings.contained * F.col("a"), F.lit(True))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= settings.top)
    return ranked.join(totals.hint("merge"), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, settings: Settings = QUERY) -> DataFrame:
    """The best phrases of every language of ``docs``."""
    spark, folder = docs.sparkSession, fresh_folder(docs.sparkSession)
    frequent: list[Broadcast] = []
    for length in range(1, settings.words + 1):
        hashes = stored(frequent_hashes(docs, length, frequent, settings.least), f"{folder}/hashes_{length}")
        frequent.append(spark.sparkContext.broadcast(Bitmap.of(hashes.select("hash"), hashes.count())))
    marks = spark.read.parquet(*[f"{folder}/hashes_{k}" for k in range(2, settings.words + 1)]).select("mark")
    owned = spark.sparkContext.broadcast(Bitmap.of(marks, marks.count()))
    phrases = stored(candidate_texts(docs, frequent, owned), f"{folder}/phrases")
    words = phrases.select("lang", F.explode(F.split("phrase", " ")).alias("phrase")).distinct()
    tries = built_tries(stored(phrases.union(words), f"{folder}/keys"), f"{folder}/tries")
    found = counts_of(docs, tries, f"{folder}/counts")
    totals = found.where(F.col("at") == WORDS).select(F.col("name").alias("lang"), F.col("f").alias("n"))
    counts = stored(named(tries, found), f"{folder}/counted")
    return scored(counts, totals, settings)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the first 2000 phrases of each language of the documents."""
    return collocations(table(spark, sf_dir, "documents"), QUERY)


QUERIES = {"op11_collocations": query}

SQL = {
    "op11_collocations": r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), pieces AS (
  SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
), numbered AS (
  SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), words AS (
  SELECT lang, piece, unnest(w) AS x, unnest(range(len(w))) AS i FROM numbered
), ahead AS (
  SELECT lang, x, lead(x) OVER p AS y, lead(x, 2) OVER p AS z FROM words WINDOW p AS (PARTITION BY piece ORDER BY i)
), grams AS (
  SELECT lang, x AS phrase, 1 AS k FROM ahead
  UNION ALL SELECT lang, x || ' ' || y, 2 FROM ahead WHERE y IS NOT NULL
  UNION ALL SELECT lang, x || ' ' || y || ' ' || z, 3 FROM ahead WHERE z IS NOT NULL
), f AS (
  SELECT lang, phrase, k, count(*) AS f FROM grams GROUP BY ALL
), n AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), c AS (
  SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 10
), cuts AS (
  SELECT lang, phrase, k, a, w, unnest(range(1, k)) AS cut FROM c
), sides AS (
  SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS one, array_to_string(w[cut + 1:], ' ') AS two FROM cuts
), parts AS (
  SELECT s.lang, s.phrase, s.a, s.cut, x.f AS l, y.f AS r,
         CAST((1000000::HUGEINT * s.a * s.a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM sides s
  JOIN f x ON x.lang = s.lang AND x.phrase = s.one
  JOIN f y ON y.lang = s.lang AND y.phrase = s.two
), best AS (
  SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), longer AS (
  SELECT lang, phrase, max(a) AS g
  FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM c WHERE k = 3)
  GROUP BY ALL
), kept AS (
  SELECT best.* FROM best LEFT JOIN longer USING (lang, phrase) WHERE g IS NULL OR 100 * g < 50 * a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
""",
}
