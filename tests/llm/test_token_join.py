"""The Jaccard join against brute force over all pairs that share a shingle."""

from __future__ import annotations

import os
import random
import struct
import tempfile

import numpy as np
import xxhash
from pyspark.sql import functions as F
from test_rules_and_dedup import brute_links

from tallymatch.llm import token_join
from tallymatch.llm.bitmaps import Bitmap
from tallymatch.llm.token_join import QUERY, Settings

SF = "/root/testdata/sf0.01"


def found_of(spark, texts, settings=QUERY):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {r.doc_id: (r.n_shingles, r.component_id) for r in token_join.link(df, settings).collect()}


def test_all_documents(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = token_join.QUERIES["op12_ngram_join"](spark, SF)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()}
    assert found == brute_links(texts, 3, 90)
    assert any(c != k for k, (_, c) in found.items())


def near_texts(seed, groups=6):
    """Groups of texts on both sides of the threshold, of sizes around the bound of pairs, with shared passages."""
    draw = random.Random(seed)
    passage = [f"p{i}" for i in range(40)]
    texts, key = {}, 0
    for group in range(groups):
        length = draw.choice([4, 12, 40, 150, 290, 305, 320, 340, 500])
        base = [f"g{group}w{draw.randrange(400)}" for _ in range(length)]
        for _ in range(25):
            words = list(base)
            for _ in range(draw.randrange(0, 2 + length // 60)):
                words[draw.randrange(len(words))] = f"n{draw.randrange(50)}"
            if draw.random() < 0.3:
                words += passage[: draw.randrange(3, 40)]
            if draw.random() < 0.2:
                words = words[: int(len(words) * draw.uniform(0.88, 1))]
            texts[key] = " ".join(words)
            key += 1
    return texts


def test_random_groups(spark):
    texts = near_texts(1)
    assert found_of(spark, texts) == brute_links(texts, 3, 90)
    settings = Settings(width=2, percent=70)
    assert found_of(spark, texts, settings) == brute_links(texts, 2, 70)


def test_keys_are_complete():
    """Sets that are similar enough share a key that passes the bounds on size and place, whatever is frequent."""
    draw = np.random.default_rng(5)
    classes = draw.integers(0, 4, 1 << 14).astype(np.uint8) * (draw.random(1 << 14) < 0.7)
    met = 0
    for _ in range(600):
        settings = Settings(3, int(draw.choice([70, 80, 90])))
        size = int(draw.choice([1, 2, 3, 9, 60, 95, 120, 145, 200, 295, 310, 330, 345, 600]))
        base = np.unique(draw.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        keep = int(np.ceil(len(base) * draw.uniform(settings.percent / 100, 1)))
        more = draw.integers(0, 1 << 63, int(draw.integers(0, 1 + size // 12)), dtype=np.uint64)
        other = np.unique(np.concatenate([draw.permutation(base)[:keep], more]))
        both = len(np.intersect1d(base, other))
        if both * 100 < (len(base) + len(other) - both) * settings.percent:
            continue
        met += 1
        small, large = sorted((base, other), key=len)
        ks, rs = token_join.keys_of(small, classes, settings)
        kl, rl = token_join.keys_of(large, classes, settings)
        need = settings.percent * (len(small) + len(large))
        shared = [
            (k, min(abs(a), b))
            for k, a in zip(ks.tolist(), rs.tolist())
            if a > 0
            for j, b in zip(kl.tolist(), np.abs(rl).tolist())
            if j == k
        ]
        assert any(room * (100 + settings.percent) >= need for _, room in shared)
    assert met > 200


def test_frequent_shingles_are_combined():
    found = np.arange(1, 101, dtype=np.uint64) << np.uint64(50)
    rare, frequent = np.zeros(1 << 14, dtype=np.uint8), np.ones(1 << 14, dtype=np.uint8)
    probed = QUERY.probed(100) + 1
    assert set(token_join.keys_of(found, rare, QUERY)[0]) == set(found[:probed])
    keys, _ = token_join.keys_of(found, frequent, QUERY)
    assert len(keys) == probed * (probed - 1) // 2 and not set(keys) & set(found)


def test_cases(spark, nasty, empty):
    rows = token_join.link(nasty).collect()
    assert len(rows) == nasty.count()
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert found[2] == (0, 2) and found[3] == (0, 3) and found[4] == (0, 4)
    assert found[9][1] == 1 and found[5][1] == 1 and found[10][1] == 1
    assert found[None] == (1, None) and found[8] == (1, 8)
    assert token_join.link(empty).count() == 0


def test_one_id_for_two_texts(spark):
    """Rows that share an id are different nodes, and join the components of their own texts."""
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, a), (8, a + " more"), (8, b), (9, b + " more")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id) for r in token_join.link(df).collect())
    assert got == [(1, 1), (8, 1), (8, 8), (9, 8)]


def test_dense_group_below_the_threshold_makes_no_pairs(spark, folder):
    """Copies whose edits are their own meet under no key of the shorter prefix."""
    texts = {
        k: " ".join(w for i in range(200) for w in ([f"w{i}"] if i % 20 else [f"w{i}", f"own{k}_{i}"])) for k in range(80)
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    signed = token_join.sign(df, token_join.frequency_classes(df, QUERY), QUERY)
    nodes = signed.selectExpr("doc_id as node", "cast(n_shingles as int) size", "keys", "room", "parity", "brief")
    nodes.write.parquet(f"{folder}/nodes")
    nodes = spark.read.parquet(f"{folder}/nodes")
    nothing = spark.createDataFrame([], "node long, component long")
    buckets = token_join.shared_keys(nodes, folder)
    assert buckets.count() == 0
    assert token_join.all_pairs(buckets, nodes, nothing, QUERY, folder).count() == 0
    assert found_of(spark, texts) == brute_links(texts, 3, 90)


def test_parity_is_a_bound(spark):
    """Differing bits are never more than shingles of one set only."""
    draw = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(draw.integers(0, 1 << 63, int(draw.integers(1, 900)), dtype=np.uint64))
        b = np.unique(np.concatenate([a[: int(draw.integers(0, len(a) + 1))], draw.integers(0, 1 << 63, 40, dtype=np.uint64)]))
        bits = [token_join.parity_of(a), token_join.parity_of(b)]
        least = min(map(len, bits))
        while max(map(len, bits)) > least:  # halves combined
            bits = [x if len(x) == least else x[: len(x) // 2] ^ x[len(x) // 2 :] for x in bits]
        differing = np.bitwise_count((bits[0] ^ bits[1]).view(np.uint64)).sum()
        assert differing <= len(np.setxor1d(a, b))


def test_filter_agrees_with_the_sql_hash(spark):
    digest, key = b"0123456789abcdef", -5
    df = spark.createDataFrame([(bytearray(digest), key)], "digest binary, doc_id long")
    mark = xxhash.xxh64_intdigest(struct.pack("<q", key), seed=xxhash.xxh64_intdigest(digest, seed=42))
    marked = df.select(F.xxhash64("digest", "doc_id"))
    assert marked.first()[0] % 2**64 == mark
    bitmap = Bitmap.of(marked, 1)
    assert bitmap.holds(np.array([mark, mark + 1], dtype=np.uint64)).tolist() == [True, False]
    assert np.bitwise_count(bitmap.words).sum() <= 2


def test_a_dense_group_needs_no_pairs_in_its_square(spark, monkeypatch):
    """Even where centres lead nowhere, members that are linked are one component before all pairs are compared."""
    words = [f"w{k}" for k in range(240)]
    texts = [" ".join([*words[: 4 * k], f"x{k}", *words[4 * k + 1 :]]) for k in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left, all_pairs = [], token_join.all_pairs
    none = spark.createDataFrame([], "a long, b long")
    monkeypatch.setattr(token_join, "star_pairs", lambda *_: none)
    monkeypatch.setattr(token_join, "all_pairs", lambda *given: left.append(all_pairs(*given)) or left[-1])
    assert {r.component_id for r in token_join.link(df).collect()} == {0}
    assert left[0].isEmpty()


def test_only_wanted_texts_are_cut_into_words(spark, folder, monkeypatch):
    """Full sets are made of wanted ids alone; a text that shares an id gives no set of its own."""
    seen = f"{folder}/seen"
    os.makedirs(seen)

    class Counting(token_join.Shingler):
        def __init__(self, texts, settings):
            super().__init__(texts, settings)
            handle, _ = tempfile.mkstemp(dir=seen, prefix=f"{len(texts)}-")
            os.close(handle)

    texts = {k: " ".join(f"w{k}_{i}" for i in range(30)) for k in range(400)}
    rows = [*texts.items(), (7, "another text of that id"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    whole = token_join.Shingler(list(texts.values()), QUERY)
    marks = [(n, bytearray(whole.digest(k)), k) for n, k in enumerate((7, 300))]
    spark.createDataFrame(marks, "node long, digest binary, doc_id long").write.parquet(f"{folder}/wanted")
    monkeypatch.setattr(token_join, "Shingler", Counting)
    got = token_join.sets_of(df, spark.read.parquet(f"{folder}/wanted"), QUERY).collect()
    assert {r.node: sorted(r.shingles) for r in got} == {n: sorted(whole.set_of(k).view(np.int64).tolist()) for n, _, k in marks}
    assert 3 <= sum(int(name.partition("-")[0]) for name in os.listdir(seen)) <= 6
