"""Rules, exact and near deduplication against SQL and brute force."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from oracle import assert_matches, connect

from tallymatch.llm import exact_dedup, minhash, quality_rules
from tallymatch.llm.bitmaps import sifted
from tallymatch.llm.queries import llm_queries, llm_sql

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(set(llm_sql()) - {"op11_collocations"}))
def test_matches_sql(spark, name):
    assert assert_matches(llm_queries()[name](spark, SF), connect(SF), llm_sql()[name]) == 1000


def test_rules_stay_on_the_jvm(spark):
    for name in ("op2_quality_rules", "op8_exact_dedup"):
        plan = llm_queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)


def measure(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_rules_cases(nasty, empty):
    rows = quality_rules.ledger(nasty.select("doc_id", "text", "source")).collect()
    assert len(rows) == nasty.count()
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == measure(r.text or ""), r.doc_id
        assert bool(r.failed_bits & 1) == (r.n_words < 10)
        assert bool(r.failed_bits & 2) == (100 * r.n_repeat_words > 20 * r.n_words)
    assert quality_rules.ledger(empty.select("doc_id", "text")).count() == 0


def test_rules_stage_keeps_rows_whole(spark, nasty):
    kept = quality_rules.stage(spark, nasty, SF)
    assert kept.columns == nasty.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 5, 10]


def test_ablations(spark, documents):
    entries = quality_rules.ledger(documents.select("doc_id", "text"))
    bits = [r.failed_bits for r in entries.select("failed_bits").collect()]
    policy = quality_rules.STRICT
    got = {r.rule: r for r in quality_rules.ablations(entries, policy).collect()}
    for i, rule in enumerate(quality_rules.RULES):
        rest = policy.mask & ~(1 << i)
        assert got[rule.name].failed == sum(bool(b & 1 << i) for b in bits)
        assert got[rule.name].failed_alone == sum(b == 1 << i for b in bits)
        assert got[rule.name].kept_without == sum(b & rest == 0 for b in bits)


def test_dedup_cases(spark, nasty, empty):
    rows = exact_dedup.deduplicate(nasty, exact_dedup.DigestIndex.create(spark)).collect()
    assert len(rows) == nasty.count()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
    assert by_id[5][0].keep_id == 1 and not by_id[5][0].kept and by_id[1][0].group_size == 2
    assert by_id[3][0].keep_id == 2 and by_id[2][0].group_size == 2  # null and empty text
    assert by_id[4][0].kept and by_id[4][0].text_sha256 == hashlib.sha256(b" ").hexdigest()
    assert sorted(r.kept for r in by_id[8]) == [False, True]
    assert by_id[None][0].kept
    assert exact_dedup.deduplicate(empty, exact_dedup.DigestIndex.create(spark)).count() == 0
    kept = exact_dedup.stage(spark, nasty, SF)
    assert kept.columns == nasty.columns and kept.count() == sum(r.kept for r in rows)


def test_dedup_remembers_earlier_batches(spark):
    index = exact_dedup.DigestIndex.create(spark, buckets=4)
    batch = lambda *rows: spark.createDataFrame(rows, "doc_id long, text string")
    first = batch((5, "a  b"), (6, "c"))
    for _ in range(2):  # the same batch again gets the same answer
        assert {(r.doc_id, r.kept) for r in exact_dedup.deduplicate(first, index).collect()} == {(5, True), (6, True)}
    rows = exact_dedup.deduplicate(batch((1, "a b"), (2, "d"), (3, "d")), index).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in rows} == {(1, 5, False), (2, 2, True), (3, 2, False)}
    assert index.read(spark).count() == 3


def test_dedup_of_a_batch_given_again(spark, monkeypatch):
    """Other partitions, a failure after the append, and the same ids in a batch of another name."""
    texts = [(k % 40, f"text {k % 25}" + " " * (k % 3)) for k in range(200)] + [(None, "text 3"), (None, "x")]
    want = {f"text {k}" + " " for k in range(25)} | {f"text {k}" for k in range(25)} | {"x"}
    groups = {" ".join(t.split(" ")).rstrip(" ") + (" " if t.endswith(" ") else "") for _, t in texts}
    assert groups <= want

    def batch(parts):
        return spark.createDataFrame(texts, "doc_id long, text string").repartition(parts)

    index = exact_dedup.DigestIndex.create(spark, buckets=4)
    append, calls = exact_dedup.DigestIndex.append, []

    def append_and_die(self, entries):
        append(self, entries)
        calls.append(1)
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(exact_dedup.DigestIndex, "append", append_and_die)
        with pytest.raises(RuntimeError):
            exact_dedup.deduplicate(batch(2), index, batch="a")
    assert calls == [1]
    answers = []
    for parts in (7, 2, 1):
        rows = exact_dedup.deduplicate(batch(parts), index, batch="a").collect()
        answers.append(sorted((r.text_sha256, r.doc_id is None, r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in rows))
        assert sum(r.kept for r in rows) == len(groups) == index.read(spark).count()
        assert {r.text_sha256 for r in rows if r.kept} == {r.text_sha256 for r in rows}
    assert answers[0] == answers[1] == answers[2]
    other = exact_dedup.deduplicate(batch(3), index, batch="b").collect()
    assert not any(r.kept for r in other) and len(other) == len(texts)
    index.drop(spark)


def test_dedup_leaves_no_table(spark, nasty):
    def tables():
        return {t.name for t in spark.catalog.listTables() if t.name.startswith("digest_index_")}

    before = tables()
    assert exact_dedup.stage(spark, nasty, SF).count() == 10
    assert tables() == before


def test_buckets_follow_the_rows():
    assert exact_dedup.buckets_for(0, 8) == 8
    assert exact_dedup.buckets_for(10 * exact_dedup.BUCKET_ROWS + 1, 8) == 11


def brute_links(texts, width, percent):
    """(set size, smallest reachable id) of every document, over all pairs that share a shingle."""
    sets = {}
    for key, text in texts.items():
        words = WORD.findall(text.translate(minhash.FOLD))
        windows = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}
        sets[key] = windows or ({tuple(words)} if words else set())
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    holders = defaultdict(list)
    for key in sorted(sets):
        shared = Counter(other for s in sets[key] for other in holders[s])
        for other, n in shared.items():
            if 100 * n >= percent * (len(sets[key]) + len(sets[other]) - n):
                low, high = sorted((root(key), root(other)))
                parent[high] = low
        for s in sets[key]:
            holders[s].append(key)
    return {k: (len(sets[k]), root(k)) for k in sets}


def test_minhash(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = brute_links(texts, 3, 85)
    got = {r.doc_id: r for r in llm_queries()["op3_minhash"](spark, SF).collect()}
    assert {k: (r.n_shingles, r.component_id) for k, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())
    assert any(c != k for k, (_, c) in want.items())


def test_minhash_estimate_misses_few_pairs():
    """A pair at the threshold falls below the estimate with a chance of about 1 in 10^9."""
    for settings in (minhash.QUERY, minhash.STAGE):
        agree = settings.percent / 100 * 0.75 + 0.25
        room = (settings.percent / 100 - settings.least_estimate) * 0.75
        sigmas = room / (agree * (1 - agree) / settings.minima) ** 0.5
        assert math.erfc(sigmas / 2**0.5) / 2 < 2e-9


def test_minhash_cases(spark, nasty, empty):
    rows = minhash.link(nasty, minhash.QUERY).collect()
    assert len(rows) == nasty.count()
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert found[2] == (0, 2) and found[3] == (0, 3) and found[4] == (0, 4)
    assert found[9][1] == 1 and found[5][1] == 1 and found[10][1] == 1
    assert found[None] == (1, None) and found[8] == (1, 8)
    assert minhash.link(empty, minhash.QUERY).count() == 0
    kept = minhash.stage(spark, nasty, SF)
    assert kept.columns == nasty.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows} - {5, 9, 10}


def test_minhash_chain_and_hot_group(spark):
    """A chain whose ends are not similar, and many near copies of one text."""
    base = [f"w{i}" for i in range(200)]
    chain = {k: " ".join(base[4 * k : 4 * k + 120]) for k in range(12)}
    copies = {100 + k: " ".join([*(f"v{i}" for i in range(150)), f"end{k}"]) for k in range(300)}
    texts = chain | copies
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.link(df, minhash.QUERY).collect()}
    assert got == brute_links(texts, 3, 85)


def test_contract(spark, folder):
    edges = [(a, a + 1) for a in range(1, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    found = minhash.contract(spark.createDataFrame(edges, "a long, b long"), folder).collect()
    got = {r.node: r.component for r in found if r.node != r.component}
    assert got == {k: 1 for k in range(2, 61)} | {k: 100 for k in range(101, 140)}


def test_estimate_is_corrected_for_chance(spark):
    """Unrelated texts come out near 0, not at the quarter of bits that agree by chance."""
    rows = [(k, " ".join(f"{k}_{i}" for i in range(400))) for k in (1, 2)]
    signed = minhash.sign(spark.createDataFrame(rows, "doc_id long, text string"), minhash.QUERY)
    a, b = (signed.where(f"doc_id = {k}").select(signed.planes.alias(f"p{k}")) for k in (1, 2))
    from pyspark.sql import functions as F

    value = a.join(b).select(minhash.estimate(F.col("p1"), F.col("p2"), minhash.QUERY)).first()[0]
    assert abs(value) < 0.2


def test_parities_bound_the_difference_of_sets():
    """Bitmaps differ in no more bits than the shingles that only one set has, whatever the sizes."""
    import numpy as np

    draw = np.random.default_rng(7)
    for size, own in ((1, 1), (40, 3), (300, 20), (5000, 400)):
        shared = draw.integers(0, 1 << 63, size, dtype=np.uint64)
        a, b = (
            np.unique(np.concatenate([shared, draw.integers(0, 1 << 63, own, dtype=np.uint64)])) for _ in range(2)
        )
        pairs = zip(minhash.parities(a), minhash.parities(b), strict=True)
        differing = sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in pairs)
        assert differing <= len(np.setxor1d(a, b))
        assert minhash.parities(a) == minhash.parities(a[::-1])


def test_minhash_rows_of_one_id_are_one_node(spark):
    """Other texts under the same id: one node, whose component all of its rows get, on every layout."""
    words = [f"w{k}" for k in range(60)]
    other = [f"v{k}" for k in range(60)]
    rows = [
        (1, " ".join(words)),
        (8, " ".join([*words, "x"])),
        (8, " ".join(other)),
        (20, "nothing like the others at all"),
    ]
    seen = set()
    for parts in (1, 3):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        found = minhash.link(df, minhash.QUERY).collect()
        assert len(found) == 4
        seen.add(tuple(sorted((r.doc_id, r.n_shingles, r.component_id) for r in found)))
    assert len(seen) == 1
    components = {}
    for doc_id, _, component in seen.pop():
        components.setdefault(doc_id, set()).add(component)
    assert all(len(c) == 1 for c in components.values()) and components[20] == {20}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_minhash_shuffles_no_text_to_pick_documents(spark, nasty, documents, monkeypatch):
    picked, sets = [], minhash.sets
    monkeypatch.setattr(minhash, "sets", lambda *given: picked.append(sets(*given)) or picked[-1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert minhash.link(documents, minhash.QUERY).count() == documents.count()
        assert picked and not any(word in _plan(df) for df in picked for word in ("Exchange", "Join"))
        kept = minhash.stage(spark, nasty, SF)
        sure = re.search("MapInArrow.*?Scan", _plan(kept), re.S).group()  # the first branch of the union
        assert "text" in sure and "Exchange" not in sure
        linked = minhash.link(nasty, minhash.STAGE).where("doc_id <> component_id").select("doc_id").collect()
        gone = {r.doc_id for r in linked}
        assert gone
        expected = sorted((r.doc_id or 0, r.text or "") for r in nasty.collect() if r.doc_id not in gone)
        assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == expected
        assert kept.columns == nasty.columns
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sifted_rows_are_all_rows_once(spark):
    df = spark.range(20_000).selectExpr("if(id % 7 = 0, null, id) as k", "cast(id as string) as t")
    keys = spark.range(0, 20_000, 400).toDF("k")
    may, sure = (sifted(df, "k", keys, within) for within in (True, False))
    assert may.schema == sure.schema == df.schema
    assert may.unionByName(sure).exceptAll(df).isEmpty() and may.count() + sure.count() == df.count()
    assert may.join(keys, "k", "left_semi").count() == df.join(keys, "k", "left_semi").count()
    assert sure.join(keys, "k", "left_semi").isEmpty() and may.count() < 3000
