"""Collocations against SQL and a plain Python version."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import assert_matches, connect
from pyspark.sql import functions as F

from tallymatch.llm import collocations as col

SF = "/root/testdata/sf0.01"
FOLD = {c: c + 32 for c in range(65, 91)}


def plain_version(rows, how):
    """{lang: [(phrase, a, l, r, n, score)]} by dictionaries of all phrases."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(FOLD)):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, how.words + 1):
                for i in range(len(words) - size + 1):
                    f[lang][tuple(words[i : i + size])] += 1
    found = {}
    for lang, counts in f.items():
        best, longer = [], Counter()
        for phrase, a in counts.items():
            if len(phrase) < 2 or a < how.least:
                continue
            cuts = [(counts[phrase[:k]], counts[phrase[k:]]) for k in range(1, len(phrase))]
            score, _, l, r = min((how.scale * a * a // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
            best.append((phrase, a, l, r, n[lang], score))
            for size in range(2, len(phrase)):
                for i in range(len(phrase) - size + 1):
                    longer[phrase[i : i + size]] = max(longer[phrase[i : i + size]], a)
        kept = [(" ".join(p), a, *rest) for p, a, *rest in best if not longer[p] or 100 * longer[p] < how.contained * a]
        kept.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        if kept:
            found[lang] = kept[: how.top]
    return found


def result(df):
    found = defaultdict(list)
    for x in sorted(df.collect(), key=lambda x: (x["lang"], x["rank"])):
        found[x["lang"]].append((x["phrase"], x["a"], x["l"], x["r"], x["n"], x["score"]))
        assert x["rank"] == len(found[x["lang"]])
    return dict(found)


def test_matches_sql(spark):
    sql = col.SQL["op11_collocations"]
    assert assert_matches(col.QUERIES["op11_collocations"](spark, SF), connect(SF), sql) > 1000


@pytest.mark.parametrize("how", [col.Settings(words=4, least=3, top=50), col.Settings(words=2, least=1, contained=80)])
def test_small_texts(spark, how):
    draw = random.Random(7)
    parts = ["New York", "new york city", "the", "of", "é", "a.b", "über", "\n", ";", "\t ", "x" * 40, "x" * 41, "日本"]
    rows = [
        (draw.choice(["en", "und", None, "de", "e"]), " ".join(draw.choices(parts, k=draw.randrange(0, 60)))) for _ in range(60)
    ]
    df = spark.createDataFrame([(None, t, lang) for lang, t in rows], "doc_id long, text string, lang string").repartition(3)
    assert result(col.collocations(df, how)) == plain_version(rows, how)


def test_cases(spark, nasty, empty):
    how = col.Settings(least=2)
    want = plain_version([(r["lang"], r.text) for r in nasty.collect()], how)
    assert result(col.collocations(nasty, how)) == want and list(want) == ["und"]
    assert col.collocations(empty).count() == 0


def test_several_tries_and_passes(spark, documents, folder):
    """Small tries, one to a pass, count the same."""
    words = documents.select("lang", "text").where("doc_id < 20")
    keys = [(r["lang"], w) for r in words.collect() for w in set(re.findall(r"[a-z]+", r.text))]
    keys = spark.createDataFrame(sorted(set(keys)), "lang string, phrase string")
    whole = col.counted_phrases(words, col.built_tries(keys, f"{folder}/one"), f"{folder}/a")
    small = col.built_tries(keys, f"{folder}/many", trie_keys=100)
    assert small.count() > 5
    parts = col.counted_phrases(words, small, f"{folder}/b", pass_bytes=1)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(whole) == rows(parts) and whole.count() > 100


KEYS = st.lists(st.text(alphabet="ab c", min_size=1, max_size=9), min_size=1, max_size=40)


@settings(max_examples=150, deadline=None)
@given(phrases=KEYS, texts=st.lists(st.text(alphabet="AabBc ,\n", max_size=40), min_size=1, max_size=5))
def test_trie_counts(phrases, texts):
    keys = sorted({" ".join(p.split()) for p in phrases if p.split()}, key=str.encode)
    if not keys:
        return
    trie = col.DoubleArray.build([k.encode() for k in keys])
    words = col.Words(texts, ["x"] * len(texts))
    want = Counter()
    for text in texts:
        for piece in re.split(r"[,\n]", text.translate(FOLD)):
            found = piece.split()
            for i in range(len(found)):
                for j in range(i + 1, len(found) + 1):
                    want[" ".join(found[i:j])] += 1
    assert trie.counts(words.bytes, words.starts).tolist() == [want[k] for k in keys]


def test_score_beyond_64_bits(spark):
    big = 3_000_000_000
    counts = spark.createDataFrame([("en", "a b", big), ("en", "a", big + 1), ("en", "b", big + 7)], "lang string, phrase string, f long")
    totals = spark.createDataFrame([("en", 4 * big)], "lang string, n long")
    row = col.scored(counts, totals, col.QUERY).first()
    assert row.score == 1_000_000 * big * big // ((big + 1) * (big + 7))


def test_hashes_tell_languages_apart():
    words = col.Words(["same word", "same word"], ["a", "b"])
    assert len(np.unique(words.hashes())) == 4


def test_grouped_hashes():
    """Every hash with its number and a place of it, also where hashes agree in all high bits."""
    draw = np.random.default_rng(3)
    near = np.uint64(7) << np.uint64(40)
    for size in (0, 1, 2, 1000):
        hashes = draw.choice(np.concatenate([draw.integers(0, 1 << 63, 50, dtype=np.uint64), near + np.arange(9, dtype=np.uint64)]), size)
        found, place, n = col.grouped(hashes)
        assert np.array_equal(hashes[place], found)
        sums = Counter()
        for h, k in zip(found.tolist(), n.tolist(), strict=True):
            sums[h] += k
        assert sums == Counter(hashes.tolist())


def test_counts_leave_a_task_in_chunks(spark, documents, folder):
    """Words of a language are counted with the keys, and a task sends a row for many keys, not for each."""
    texts = documents.select("lang", "text").repartition(3)
    rows = [(r["lang"] or "und", (r.text or "").translate(FOLD)) for r in texts.collect()]
    words = Counter()
    for lang, text in rows:
        words[lang] += sum(len(re.findall(r"[^ \t]+", piece)) for piece in re.split(r"[.,;:!?\x0a-\x0d]", text))
    keys = sorted({(lang, w) for lang, text in rows for w in re.findall(r"[a-z]+", text)})
    tries = col.built_tries(spark.createDataFrame(keys, "lang string, phrase string"), f"{folder}/tries", trie_keys=1 << 18)
    assert tries.count() <= len(words) and len(keys) > 2 * col.CHUNK
    small = tries.withColumn("phrases", F.slice("phrases", 1, 1))
    found = col.counts_of(texts, tries, f"{folder}/counts")
    assert {r["name"]: r.f for r in found.where("at = -1").collect()} == words
    assert found.where("at >= 0").groupBy("name", "at").count().where("count > 1").isEmpty()
    counted = {(r["lang"], r.phrase): r.f for r in col.named(tries, found).collect()}
    lang, word = max(counted, key=counted.get)
    want = sum(piece.count(word) for x, text in rows if x == lang for piece in [re.findall(r"[^ \t.,;:!?\x0a-\x0d]+", text)])
    assert counted[lang, word] == want
    assert col.named(small, found).count() <= small.count()
