"""Near-duplicate groups by b-bit MinHash.

1. One pass over the texts gives each document a digest of its words, the number of its
   distinct shingles, band keys over the minima, and the low two bits of every minimum,
   packed as two bit planes behind ``PARITY_BITS`` parities of the whole set.
2. Documents with equal word sequences form a class with one representative; from here on
   only representatives are compared, so copies cost nothing.
3. Representatives that agree in a band meet in a bucket.  A bucket pairs its members with its
   smallest one (a star), and of its stars' centres a representative takes the one it shares
   the most bands with.  Bit counts of the packed signatures estimate the similarity,
   corrected for chance agreement of low bits; pairs far below the threshold go, so do those
   whose parities differ more often than a link allows, and the rest is settled on full
   shingle sets.
4. What this leaves out matters only in buckets whose members are not in one component yet.
   There, members of different components are compared by their packed bits inside the join,
   and plausible pairs are settled on full sets.  Links found there only merge components, so
   one pass sees every pair.
5. Components of the links come from alternating star contraction over files in the shared
   folder; nothing of it goes through the driver but counts.

A link is missed if no band agrees or if the estimate is ``SIGMAS`` standard deviations too
low: with the settings below under 1 in a million pairs at the threshold.  Parities lose
nothing: two bitmaps differ in no more bits than the shingles that only one set has.  The first
band in which a pair agrees is told by 31 bits of its keys, which fails for 2 in 10^8 pairs.
Shingles are compared by 64-bit hashes.

Defined cases: a null or empty text has no shingles, is linked with nothing and stays; a
text of fewer words than a shingle is one shingle; repeated rows get equal results; a null
``doc_id`` is linked with nothing, its component is null and it stays; rows of one ``doc_id`` with
different texts are one node: all of them give candidates, checked on the set of the id that sorts
first; an empty table gives an empty one; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bitmaps import sieve, sifted
from .common import WORD, fresh_folder, ship, slices, stored, table

SIGMAS = 6
LOW_BITS = 2
PARITY_BITS = 256
#: The bits of a band key that tell in which bands a pair agrees.
BRIEF = (1 << 31) - 1
SIGNED = "doc_id long, digest string, n_shingles long, bands array<long>, planes array<long>"
SETS = "doc_id long, shingles array<long>"

WORDS = re.compile(WORD)
FOLD = {c: c + 32 for c in range(65, 91)}  # A-Z only


@dataclass(frozen=True)
class Settings:
    """Shingles of ``width`` words; a link from ``percent`` on; ``bands`` of ``rows`` minima each."""

    width: int
    percent: int
    bands: int
    rows: int

    @property
    def minima(self) -> int:
        return self.bands * self.rows

    @property
    def least_estimate(self) -> float:
        """The estimate that a pair at the threshold falls below with a chance of about 1 in 10^9."""
        chance = 1 / (1 << LOW_BITS)
        agree = self.percent / 100 * (1 - chance) + chance
        return self.percent / 100 - SIGMAS * (agree * (1 - agree) / self.minima) ** 0.5 / (1 - chance)


#: A pair at the threshold meets in no band with a chance of 3 in 10^7.
QUERY = Settings(width=3, percent=85, bands=32, rows=6)
STAGE = Settings(width=5, percent=80, bands=38, rows=5)


def word_hashes(words: list[str], memo: dict[str, int]) -> np.ndarray:
    import xxhash

    for word in set(words).difference(memo):
        memo[word] = xxhash.xxh3_64_intdigest(word.encode())
    return np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Distinct shingle hashes, sorted; with fewer words than a shingle, all of them are one."""
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    n = len(hashes) - width + 1
    out = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        out = mixed(out + hashes[k : k + n])
    return np.unique(out)


def parities(found: np.ndarray) -> list[int]:
    """Of every bit, whether an odd number of shingles falls on it."""
    odd = np.bincount((found % np.uint64(PARITY_BITS)).view(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


class Signer:
    MEMO = 200_000
    BLOCK = 1024

    def __init__(self, settings: Settings):
        self.settings, self.memo = settings, {}
        draw = np.random.default_rng(20_240_501)  # the same functions in every task
        self.factor = draw.integers(0, 1 << 63, settings.minima, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.shift = draw.integers(0, 1 << 63, settings.minima, dtype=np.uint64)

    def set_of(self, text: str) -> tuple[list[str], np.ndarray]:
        words = WORDS.findall(text.translate(FOLD))
        if len(self.memo) > self.MEMO:
            self.memo.clear()
        return words, shingles(word_hashes(words, self.memo), self.settings.width)

    def minima(self, found: np.ndarray) -> np.ndarray:
        least = np.full(len(self.factor), np.iinfo(np.uint64).max, dtype=np.uint64)
        for low in range(0, len(found), self.BLOCK):
            values = self.factor[:, None] * found[None, low : low + self.BLOCK] + self.shift[:, None]
            np.minimum(least, values.min(axis=1), out=least)
        return mixed(least)

    def sign(self, text: str) -> tuple:
        import xxhash

        words, found = self.set_of(text)
        if not len(found):
            return "", 0, [], []
        least = self.minima(found)
        keys = np.arange(self.settings.bands, dtype=np.uint64)
        for column in least.reshape(self.settings.bands, self.settings.rows).T:
            keys = mixed(keys * np.uint64(3) + column)
        planes = [
            np.packbits(np.pad(((least >> np.uint64(k)) & np.uint64(1)).astype(np.uint8), (0, -len(least) % 64)))
            .view(np.int64)
            .tolist()
            for k in range(LOW_BITS)
        ]
        digest = xxhash.xxh3_128_hexdigest("\n".join(words).encode())
        return digest, len(found), keys.view(np.int64).tolist(), sum(planes, parities(found))


def sign(docs: DataFrame, settings: Settings) -> DataFrame:
    """Digest, set size, band keys and packed low bits of every document."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(settings)
        kinds = (pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        for keys, texts in slices(batches):
            columns = zip(*map(signer.sign, texts), strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, type=pa.int64()), *(pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True))],
                names=["doc_id", "digest", "n_shingles", "bands", "planes"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SIGNED)


def sets(docs: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """The shingle hashes of every document whose id is wanted (a stored frame of ids).

    Texts are not shuffled: a bitmap picks them, so there are a few others as well.
    """
    ship(docs.sparkSession)
    passed = sieve(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(settings)
        for keys, texts in slices(passed(batches)):
            found = [signer.set_of(text)[1].view(np.int64) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, type=pa.int64()), pa.array(found, type=pa.list_(pa.int64()))],
                names=["doc_id", "shingles"],
            )

    return docs.select("doc_id", "text", F.xxhash64("doc_id")).mapInArrow(run, SETS)


def estimate(a: Column, b: Column, settings: Settings) -> Column:
    """Similarity from packed low bits: the share of agreeing ones, less what agrees by chance."""
    per_plane, first = -(-settings.minima // 64), PARITY_BITS // 64
    differing = F.lit(0)
    for word in range(per_plane):
        either = F.lit(0).cast("long")
        for plane in range(LOW_BITS):
            at = first + plane * per_plane + word
            either = either.bitwiseOR(a[at].bitwiseXOR(b[at]))
        differing = differing + F.bit_count(either)
    chance = 1 / (1 << LOW_BITS)
    return (1 - differing / settings.minima - chance) / (1 - chance)


def plausible(settings: Settings) -> Column:
    """Whether set sizes (na, nb) and packed bits (pa, pb) leave a link possible."""
    pa, pb = F.col("pa"), F.col("pb")
    odd = sum((F.bit_count(pa[k].bitwiseXOR(pb[k])) for k in range(PARITY_BITS // 64)), F.lit(0))
    # Shingles that only one set has are at most (100 - percent) / (100 + percent) of both sizes together.
    return (
        (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * settings.percent)
        & (odd * (100 + settings.percent) <= (F.col("na") + F.col("nb")) * (100 - settings.percent))
        & (estimate(pa, pb, settings) >= settings.least_estimate)
    )


def contract(edges: DataFrame, folder: str) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b): alternating large and small stars.

    Each step links nodes to the smallest neighbour they know, until nothing changes; then
    every node hangs at the smallest node of its component.
    """
    edges = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        f"{folder}/edges",
    )
    before, step = None, 0
    while True:
        step += 1
        both = edges.union(edges.select("v", "u"))
        least = stored(
            both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{folder}/large_{step}"
        )
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct(), f"{folder}/linked_{step}")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), f"{folder}/small_{step}")
        small = large.join(least, "u")
        edges = stored(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct(),
            f"{folder}/edges_{step}",
        )
        now = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now


def likely(pairs: DataFrame, reps: DataFrame, settings: Settings) -> DataFrame:
    """The (a, b) of ``pairs`` whose sizes and packed bits leave a link possible."""
    side = reps.select("rep", "n_shingles", "planes")
    return (
        pairs.join(side.toDF("a", "na", "pa"), "a")
        .join(side.toDF("b", "nb", "pb"), "b")
        .where(plausible(settings))
        .select("a", "b")
    )


def verified(near: DataFrame, docs: DataFrame, settings: Settings, folder: str) -> DataFrame:
    """The (a, b) of ``near`` (stored pairs) whose full sets are similar enough."""
    wanted = stored(near.select(F.col("a").alias("doc_id")).union(near.select("b")).distinct(), f"{folder}/wanted")
    found = stored(sets(docs, wanted, settings), f"{folder}/sets")
    pivots = found.join(near.select(F.col("a").alias("doc_id")).distinct(), "doc_id", "left_semi")
    # One set of an id: chosen in the exchange that the join needs anyway.
    one = F.min("shingles").alias("shingles")
    both = F.size(F.array_intersect("sa", "sb"))
    return stored(
        near.join(found.groupBy("doc_id").agg(one).toDF("b", "sb"), "b")
        .join(pivots.groupBy("doc_id").agg(one).toDF("a", "sa"), "a")
        .where(both * 100 >= (F.size("sa") + F.size("sb") - both) * settings.percent)
        .select("a", "b"),
        f"{folder}/links",
    )


def link(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``."""
    spark = docs.sparkSession
    folder = fresh_folder(spark)
    signed = stored(sign(docs, settings), f"{folder}/signed")
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # Equal digests are equal word sequences, so any row's signature is that of the class.
    reps = stored(
        usable.groupBy("digest").agg(
            F.min("doc_id").alias("rep"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
            F.first("planes").alias("planes"),
        ),
        f"{folder}/reps",
    )
    members = reps.select("rep", F.explode("bands").alias("key"))
    shared = (
        members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("a")).where("n > 1")
    )
    buckets = stored(
        members.join(stored(shared, f"{folder}/shared"), "key").select("key", "rep", "n", "a"), f"{folder}/buckets"
    )
    # For every member the smallest representative it shares the most bands with, hence the likeliest link.
    met = buckets.where("rep <> a").groupBy("a", F.col("rep").alias("b")).agg(F.count(F.lit(1)).alias("bands"))
    order = F.struct("bands", (-F.col("a")).alias("less"))
    best = met.groupBy("b").agg(F.max_by("a", order).alias("a")).select("a", "b")
    tested = stored(best, f"{folder}/tested")
    near = stored(likely(tested, reps, settings), f"{folder}/near")
    links = verified(near, docs, settings, f"{folder}/stars")

    # Pairs that have not been compared can matter only between components.
    component = contract(links, f"{folder}/contract")
    grouped = stored(
        buckets.join(component.toDF("rep", "component"), "rep", "left").select(
            "key", "rep", F.coalesce("component", "rep").alias("c")
        ),
        f"{folder}/grouped",
    )
    split = grouped.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high")
    split = stored(split.select("key"), f"{folder}/split")
    brief = F.col("key").bitwiseAND(F.lit(BRIEF)).cast("int")
    signatures = reps.select(
        "rep", "n_shingles", "planes", F.transform("bands", lambda x: x.bitwiseAND(F.lit(BRIEF)).cast("int"))
    ).toDF("rep", "n", "planes", "bands")
    still = stored(
        grouped.join(split, "key").join(signatures, "rep").select("key", "rep", "c", "n", "planes", "bands"),
        f"{folder}/still",
    )
    # Judged inside the join, so that it gives plausible pairs only, and each once: in the
    # first band that a pair agrees in.
    first = F.element_at(F.filter(F.zip_with("ba", "bb", lambda x, y: F.when(x == y, x)), lambda x: x.isNotNull()), 1)
    across = (
        still.toDF("key", "a", "ca", "na", "pa", "ba")
        .join(
            still.toDF("key_b", "b", "cb", "nb", "pb", "bb"),
            (F.col("key") == F.col("key_b"))
            & (F.col("a") < F.col("b"))
            & (F.col("ca") != F.col("cb"))
            & plausible(settings)
            & (first == brief),
        )
        .select("a", "b")
        .join(tested, ["a", "b"], "left_anti")
    )
    across = stored(across, f"{folder}/across")
    if not across.isEmpty():
        more = verified(across, docs, settings, f"{folder}/more")
        component = contract(links.union(more), f"{folder}/contract_all")

    settled = stored(
        reps.select("digest", "rep")
        .join(component.toDF("rep", "component"), "rep", "left")
        .select("digest", F.coalesce("component", "rep").alias("component")),
        f"{folder}/settled",
    )
    return signed.join(settled, "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )


def minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the near-duplicate component of every document."""
    return link(table(spark, sf_dir, "documents"), QUERY).select(
        "*", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: the smallest document of each component, with its own columns; five words, 0.8."""
    gone = link(docs, STAGE).where("doc_id <> component_id").select("doc_id").distinct()
    gone = stored(gone, f"{fresh_folder(spark)}/gone")
    # Only documents that may be gone are shuffled with their texts.
    doubtful = sifted(docs, "doc_id", gone).join(gone, "doc_id", "left_anti").select(*docs.columns)
    return sifted(docs, "doc_id", gone, within=False).unionByName(doubtful)


QUERIES = {"op3_minhash": minhash}
SQL: dict[str, str] = {}
