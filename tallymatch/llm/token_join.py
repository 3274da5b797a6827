"""Jaccard join of word shingles by prefixes with token combinations.

1. A first pass counts shingles in a sketch of fixed size, one vector a task.  Where a counter
   stands out from what chance puts into it, its shingles are frequent, in classes by
   powers of two; all others are rare.  The sketch only decides the order of shingles and how
   they are indexed, so its errors cost time and never a link.
2. Documents of equal word sequences are one node, their digest; copies cost nothing from here on.
3. A node's shingles are ordered from rare to frequent.  Two sets that are similar enough share
   at least k shingles in the first ``size - overlap + k`` of each, so prefixes are extended by one
   and a shared pair of shingles is asked for: every rare shingle of a prefix is a key of its
   own, and frequent ones are indexed in combinations of two.  The smaller set of a pair
   needs the shorter of two prefixes only.
   Combinations are made of prefixes up to ``PAIRED`` shingles; longer ones hold single
   shingles instead.  Sets around that size have both kinds of keys, so every pair has one in common.
4. Under a key, members are paired with a few centres (stars), and links are contracted.  Where a key
   still has several components, its members are paired with one of the least and one of the greatest
   (merges), so that a dense group becomes one component by as many pairs as it has members.  Then, once,
   all pairs under a key whose components still differ are compared.  Sizes, positions and
   parity bitmaps of the sets, all of them exact bounds, leave out what cannot be a link.
5. Every link is confirmed on full sets of 64-bit hashes, read for the nodes of such pairs only.

Defined cases: a null or empty text has no shingles and is linked with nothing; a text of fewer
words than a shingle is one shingle; repeated rows get equal results; rows that share a
``doc_id`` but not a text are different nodes; a null ``doc_id`` is linked with nothing
and its component is null; an empty table gives an empty one; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bitmaps import sieve
from .byte_words import ByteWords, byte_kinds
from .common import fresh_folder, ship, slices, stored, table
from .minhash import contract, mixed

CHUNK = 1 << 12

#: The shingle sketch has 2^14 to 2^20 counters.
SKETCH_BITS = (14, 20)

#: Longest prefix whose frequent shingles are indexed in pairs: at most 496 of them a document.
PAIRED = 32

#: Centres of a key that its members are compared with before all pairs between components are; they save work only.
STARS = 3

#: Rounds in which candidates are paired; merges save work only.
ROUNDS = ("stars", "merge", "merge again", "rest")

KINDS = byte_kinds(between=b"\x20\x09\x0a\x0b\x0c\x0d")

SIGNED = "doc_id long, digest binary, n_shingles long, keys array<long>, room array<int>, parity array<long>, brief array<long>"


@dataclass(frozen=True)
class Settings:
    """Shingles of ``width`` words; a link from ``percent`` of the union on."""

    width: int
    percent: int

    def probed(self, size: int) -> int:
        """Shingles of a set that one as large or smaller must meet."""
        return size - -(-self.percent * size // 100) + 1

    def indexed(self, size: int) -> int:
        """Shingles of a set that one as large or larger must meet."""
        return size - -(-2 * self.percent * size // (100 + self.percent)) + 1

    @property
    def pairs_to(self) -> int:
        """Largest set that has pairs only."""
        return (PAIRED - 2) * 100 // max(1, 100 - self.percent)

    @property
    def singles_from(self) -> int:
        """Smallest set that no partner of a set with pairs only exceeds."""
        return self.pairs_to * 100 // self.percent + 1


QUERY = Settings(width=3, percent=90)


class Shingler:
    """Shingle hashes of several texts."""

    def __init__(self, texts: list[str], settings: Settings):
        self.words, self.width = ByteWords(texts, KINDS), settings.width
        self.hashes = self.words.hashes()
        self.counts = self.words.counts
        self.firsts = np.cumsum(self.counts) - self.counts
        n = max(0, len(self.hashes) - self.width + 1)
        self.windows = np.full(n, self.width, dtype=np.uint64)
        for k in range(self.width):
            self.windows = mixed(self.windows + self.hashes[k : k + n])

    def all_of(self, text: int) -> np.ndarray:
        """Shingles of one text in order; with fewer words than a shingle, all of them are one."""
        first, count = self.firsts[text], self.counts[text]
        if count >= self.width:
            return self.windows[first : first + count - self.width + 1]
        if not count:
            return self.hashes[:0]
        whole = np.full(1, count, dtype=np.uint64)
        for k in range(count):
            whole = mixed(whole + self.hashes[first + k : first + k + 1])
        return whole

    def set_of(self, text: int) -> np.ndarray:
        return np.unique(self.all_of(text))

    def digest(self, text: int) -> bytes:
        """128 bits of the words, each followed by a space but the last."""
        import xxhash

        first, count = self.firsts[text], self.counts[text]
        if not count:
            return xxhash.xxh3_128_digest(b"")
        words = self.words
        return xxhash.xxh3_128_digest(words.bytes[words.starts[first] : words.ends[first + count - 1]].tobytes())


#: Bits of the bitmap that goes with every key; the whole one is looked up for pairs that pass.
BRIEF_BITS = 256


def parity_of(found: np.ndarray, most: int | None = None) -> np.ndarray:
    """Of every bit, whether an odd number of shingles falls on it.

    Bits that differ between two sets are no more than the shingles that only one of them
    has.  There are as many bits as shingles at least (a power of two, from 64 on); the halves of a
    bitmap combined by XOR are the bitmap of half the size.
    """
    size = max(64, 1 << (len(found) - 1).bit_length())
    size = size if most is None else min(size, most)
    bits = np.bincount((found & np.uint64(size - 1)).view(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def frequency_classes(docs: DataFrame, settings: Settings) -> np.ndarray:
    """Class of each counter of the shingle sketch: 0 is rare, above it powers of two over the limit.

    Each task sends one vector of fixed size, in chunks; those of a chunk are added as they
    pass.  The driver gets one vector of at most 2^20 counts.
    """
    ship(docs.sparkSession)
    low, high = SKETCH_BITS
    bits = min(max(docs.count().bit_length(), low), high)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, dtype=np.int64)
        for _, texts in slices(batches):
            shingler = Shingler(texts, settings)
            found = np.concatenate([shingler.all_of(k) for k in range(len(texts))])
            counts += np.bincount((found >> np.uint64(64 - bits)).view(np.int64), minlength=1 << bits)
        chunks = counts.reshape(-1, CHUNK)
        yield pa.RecordBatch.from_pydict(
            {"chunk": pa.array(range(len(chunks)), type=pa.int32()), "counts": [c.tobytes() for c in chunks]}
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if chunk != at:
                    if at is not None:
                        yield pa.RecordBatch.from_pydict({"chunk": pa.array([at], pa.int32()), "counts": [total.tobytes()]})
                    at, total = chunk, np.zeros(CHUNK, dtype=np.int64)
                total += np.frombuffer(counts.as_py(), dtype=np.int64)
        if at is not None:
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([at], pa.int32()), "counts": [total.tobytes()]})

    sketch = "chunk int, counts binary"
    vectors = docs.select("doc_id", "text").mapInArrow(count, sketch)
    sums = vectors.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(add, sketch)
    counts = np.zeros((1 << bits - 12, CHUNK), dtype=np.int64)
    for row in sums.collect():
        counts[row.chunk] = np.frombuffer(row.counts, dtype=np.int64)
    counts = counts.ravel()
    mean = counts.mean()
    above = counts - (mean + 8 * mean**0.5 + 8)
    return np.where(above > 0, np.ceil(np.log2(np.maximum(above, 1))) + 1, 0).astype(np.uint8)


def keys_of(found: np.ndarray, classes: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of a set, and for each how many shingles can still be shared from its place on.

    That room is negative for keys outside the shorter prefix, which only a set as large or smaller meets.
    """
    size = len(found)
    bits = len(classes).bit_length() - 1
    kinds = classes[(found >> np.uint64(64 - bits)).view(np.int64)]
    paired, single = 1 < size < settings.singles_from, size > settings.pairs_to or size == 1
    probed, indexed = settings.probed(size) + paired, settings.indexed(size) + paired
    order = np.argsort(kinds, kind="stable")[:probed]
    tokens, kinds = found[order], kinds[order]
    at = np.arange(len(order), dtype=np.int32)
    rare = int(np.searchsorted(kinds, 1))
    ends = [slice(0, rare)]
    if single:
        ends.append(slice(rare, settings.probed(size)))
    keys = [tokens[s] for s in ends]
    room = [np.where(at[s] < indexed, size - at[s], at[s] - size) for s in ends]
    if paired and len(order) - rare > 1:
        i, j = np.triu_indices(len(order) - rare, 1)
        i, j = i + rare, (j + rare).astype(np.int32)
        keys.append(mixed(mixed(tokens[i]) + tokens[j]))
        room.append(np.where(j < indexed, size - j + 1, j - size - 1))
    return np.concatenate(keys), np.concatenate(room).astype(np.int32)


def sign(docs: DataFrame, classes: np.ndarray, settings: Settings) -> DataFrame:
    """Digest, set size, index keys and parity bitmap of every document."""
    spark = docs.sparkSession
    ship(spark)
    table_of = spark.sparkContext.broadcast(classes)  # one byte for each counter of the sketch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches):
            shingler = Shingler(texts, settings)
            sizes, keys, rooms, parities, briefs = [], [], [], [], []
            for k in range(len(texts)):
                found = shingler.set_of(k)
                key, room = keys_of(found, table_of.value, settings) if len(found) else (found, found.astype(np.int32))
                sizes.append(len(found))
                keys.append(key.view(np.int64))
                rooms.append(room)
                parities.append(parity_of(found))
                briefs.append(parity_of(found, BRIEF_BITS))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(ids, type=pa.int64()),
                    "digest": pa.array([shingler.digest(k) for k in range(len(texts))], type=pa.binary()),
                    "n_shingles": pa.array(sizes, type=pa.int64()),
                    "keys": pa.array(keys, type=pa.list_(pa.int64())),
                    "room": pa.array(rooms, type=pa.list_(pa.int32())),
                    "parity": pa.array(parities, type=pa.list_(pa.int64())),
                    "brief": pa.array(briefs, type=pa.list_(pa.int64())),
                }
            )

    return docs.select("doc_id", "text").mapInArrow(run, SIGNED)


def sets_of(docs: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """(node, shingles): the full sets of the wanted (node, digest, doc_id).

    A bitmap of their ids in every task leaves out most documents that are not wanted before their words
    are looked for, and no text is shuffled; the few that pass by chance, or share an id with a wanted
    one, find no partner in the join.
    """
    passed = sieve(wanted.select("doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(passed(batches)):
            shingler = Shingler(texts, settings)
            yield pa.RecordBatch.from_pydict(
                {
                    "digest": pa.array([shingler.digest(k) for k in range(len(texts))], type=pa.binary()),
                    "shingles": pa.array(
                        [shingler.set_of(k).view(np.int64) for k in range(len(texts))], type=pa.list_(pa.int64())
                    ),
                }
            )

    marked = docs.select("doc_id", "text", F.xxhash64("doc_id"))
    found = marked.mapInArrow(run, "digest binary, shingles array<long>")
    found = found.groupBy("digest").agg(F.first("shingles").alias("shingles"))
    return found.join(wanted.select("node", "digest").hint("merge"), "digest").select("node", "shingles")


def confirmed(near: DataFrame, sets: DataFrame, settings: Settings, folder: str) -> DataFrame:
    """The (a, b) of ``near`` whose full sets are similar enough.

    All inputs are files, so that adaptive execution can split the pairs of a centre that
    a third of all nodes have as partner.
    """
    both = F.size(F.array_intersect("sa", "sb"))
    found = (
        near.join(sets.toDF("b", "sb").hint("merge"), "b")
        .join(sets.join(near.select(F.col("a").alias("node")).distinct(), "node", "left_semi").toDF("a", "sa").hint("merge"), "a")
        .where(both * 100 >= (F.size("sa") + F.size("sb") - both) * settings.percent)
        .select("a", "b")
    )
    return stored(found, f"{folder}/found")


def room_for_link(settings: Settings, na: str, nb: str, ra: str, rb: str) -> Column:
    """Whether sizes and what is left of both orders from a shared key on allow a link."""
    p = settings.percent
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * p) & (
        F.least(F.abs(ra), F.abs(rb)) * (100 + p) >= (F.col(na) + F.col(nb)) * p
    )


def parity_allows(settings: Settings, na: str, nb: str, pa_: str, pb: str) -> Column:
    """Whether the parity bitmaps allow a link: an exact bound, so none is lost."""
    words = f"least(size({pa_}), size({pb}))"  # sizes that allow a link are less than twice each other

    def folded(p: str) -> str:
        return f"if(size({p}) > {words}, zip_with(slice({p}, 1, {words}), slice({p}, {words} + 1, {words}), (x, y) -> x ^ y), {p})"

    differing = F.expr(
        f"aggregate(zip_with({folded(pa_)}, {folded(pb)}, (x, y) -> bit_count(x ^ y)), 0, (n, x) -> n + x)"
    )
    return differing * (100 + settings.percent) <= (F.col(na) + F.col(nb)) * (100 - settings.percent)


def star_pairs(buckets: DataFrame, nodes: DataFrame, settings: Settings, folder: str) -> DataFrame:
    """Pairs of nodes with centres of their keys: of all centres a node takes the one that it
    shares most keys with, its likeliest link."""
    orders = [F.xxhash64("node", F.lit(k)) for k in range(STARS)]
    centre = [F.min_by(F.struct("node", "size", "room"), o) for o in orders]
    centres = stored(buckets.groupBy("key").agg(F.array_distinct(F.array(*centre)).alias("centres")), f"{folder}/centres")
    met = (
        buckets.join(centres.hint("merge"), "key")
        .select("node", "size", "room", F.inline("centres").alias("a", "na", "ra"))
        .where(F.col("node") != F.col("a"))
        .where(room_for_link(settings, "size", "na", "room", "ra"))
    )
    counted = met.groupBy("a", F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    best = F.max_by("a", F.struct("n", "a")).alias("a")
    pairs = counted.groupBy("b").agg(best)
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return stored(allowed(pairs, nodes, settings), f"{folder}/star_pairs")


def allowed(pairs: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """Pairs whose whole parity bitmaps allow a link."""
    ends = nodes.select("node", "size", "parity")
    return (
        pairs.join(ends.toDF("a", "na", "pa").hint("merge"), "a")
        .join(ends.toDF("b", "nb", "pb").hint("merge"), "b")
        .where(parity_allows(settings, "na", "nb", "pa", "pb"))
        .select("a", "b")
    )


def placed_in(buckets: DataFrame, component: DataFrame, folder: str) -> DataFrame:
    """The members of keys with their component, ``c``."""
    placed = buckets.join(component.toDF("node", "component").hint("merge"), "node", "left")
    return stored(placed.withColumn("c", F.coalesce("component", "node")).drop("component"), f"{folder}/placed")


def merge_pairs(buckets: DataFrame, nodes: DataFrame, component: DataFrame, settings: Settings, folder: str) -> DataFrame:
    """Pairs of nodes with a node of the least and of the greatest component of their keys: of each such
    component the node that they share most keys with."""
    placed = placed_in(buckets, component, folder)
    end = F.struct("c", "node", "size", "room")
    ends = placed.groupBy("key").agg(F.min(end).alias("low"), F.max(end).alias("high")).where("low.c <> high.c")
    ends = stored(ends.select("key", F.array("low", "high").alias("ends")), f"{folder}/ends")
    met = (
        placed.join(ends.hint("merge"), "key")
        .select("node", "size", "room", "c", F.inline("ends").alias("ca", "a", "na", "ra"))
        .where(F.col("c") != F.col("ca"))
        .where(room_for_link(settings, "size", "na", "room", "ra"))
    )
    counted = met.groupBy("ca", "a", F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    pairs = counted.groupBy("b", "ca").agg(F.max_by("a", F.struct("n", "a")).alias("a"))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return stored(allowed(pairs, nodes, settings), f"{folder}/merge_pairs")


def all_pairs(buckets: DataFrame, nodes: DataFrame, component: DataFrame, settings: Settings, folder: str) -> DataFrame:
    """All pairs under a key between different components, as far as sizes, places and parities allow a link."""
    placed = placed_in(buckets, component, folder)
    split = placed.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high")
    still = placed.join(split.select("key").hint("merge"), "key").join(nodes.select("node", "brief").hint("merge"), "node")
    still = stored(still.select("key", "node", "size", "room", "c", "brief"), f"{folder}/still")
    larger = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    fits = (
        (F.col("ca") != F.col("cb"))
        & larger
        & room_for_link(settings, "na", "nb", "ra", "rb")
        & parity_allows(settings, "na", "nb", "pa", "pb")
    )
    # The smaller set is met in its shorter prefix.
    pairs = (
        still.where("room > 0")
        .toDF("key", "a", "na", "ra", "ca", "pa")
        .hint("merge")
        .join(still.toDF("other", "b", "nb", "rb", "cb", "pb"), (F.col("key") == F.col("other")) & fits)
    )
    pairs = stored(pairs.select("a", "b").distinct(), f"{folder}/met")
    return stored(allowed(pairs, nodes, settings), f"{folder}/pairs")


def link(docs: DataFrame, settings: Settings = QUERY) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``."""
    folder = fresh_folder(docs.sparkSession)
    signed = stored(sign(docs, frequency_classes(docs, settings), settings), f"{folder}/signed")
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    nodes = stored(
        usable.groupBy("digest")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.first("n_shingles").cast("int").alias("size"),
            F.first("keys").alias("keys"),
            F.first("room").alias("room"),
            F.first("parity").alias("parity"),
            F.first("brief").alias("brief"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        f"{folder}/nodes",
    )
    buckets = shared_keys(nodes, folder)
    component = components(docs, nodes, buckets, settings, folder)
    members = stored(
        nodes.select("node", "digest", "doc_id")
        .join(component.toDF("node", "component").hint("merge"), "node", "left")
        .select("digest", "doc_id", F.coalesce("component", "node").alias("component")),
        f"{folder}/members",
    )
    least = stored(members.groupBy("component").agg(F.min("doc_id").alias("component_id")), f"{folder}/least")
    settled = members.join(least.hint("merge"), "component").select("digest", "component_id")
    settled = stored(settled, f"{folder}/settled")
    return signed.join(settled.hint("merge"), "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def shared_keys(nodes: DataFrame, folder: str) -> DataFrame:
    """(key, node, size, room) of all keys that two nodes or more have."""
    entries = nodes.select("node", "size", F.inline(F.arrays_zip("keys", "room"))).select(
        F.col("keys").alias("key"), "node", "size", "room"
    )
    counted = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(counted.select("key"), f"{folder}/shared")
    return stored(entries.join(shared.hint("merge"), "key"), f"{folder}/buckets")


def components(docs: DataFrame, nodes: DataFrame, buckets: DataFrame, settings: Settings, folder: str) -> DataFrame:
    """The component of every linked node: by stars, by merges, then by all that is left between components."""
    spark = docs.sparkSession
    none = spark.createDataFrame([], "a long, b long")
    known, sets, links = None, None, none
    component = none.toDF("node", "component")
    for step in ROUNDS:
        here = f"{folder}/{step.replace(' ', '_')}"
        if step == "stars":
            near = star_pairs(buckets, nodes, settings, here)
        else:
            pairs = all_pairs if step == "rest" else merge_pairs
            near = pairs(buckets, nodes, component, settings, here)
        if near.isEmpty():
            continue
        ends = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
        wanted = nodes.select("node", "digest", "doc_id").join(ends.hint("merge"), "node", "left_semi")
        if known is not None:
            wanted = wanted.join(known.hint("merge"), "node", "left_anti")
        wanted = stored(wanted, f"{here}/wanted")
        if not wanted.isEmpty():
            more = stored(sets_of(docs, wanted, settings), f"{here}/sets")
            sets = more if sets is None else sets.union(more)
            known = wanted.select("node") if known is None else known.union(wanted.select("node"))
        found = confirmed(near, sets, settings, here)
        if found.isEmpty():
            continue
        links = links.union(found)
        component = contract(links, f"{here}/contract")
    return component


def token_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the component of every document."""
    return link(table(spark, sf_dir, "documents"), QUERY)


QUERIES = {"op12_ngram_join": token_join}
SQL: dict[str, str] = {}
