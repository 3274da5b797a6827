"""The whole pipeline on planted rows, every stage against plain Python."""

from __future__ import annotations

import random

import corpus_pipeline

VILE = "gruntzik vorpalach skarnbeld mulgrothi".split()


def planted():
    """(doc_id, text) and (doc_id, quality, toxic)."""
    draw = random.Random(7)
    syllables = "ba ce di fo gu la me ni po ru sa te vi wo".split()
    words = sorted({"".join(draw.choices(syllables, k=draw.randint(2, 4))) for _ in range(600)})
    plain = lambda n=80: draw.choices(words, k=n)
    docs, labels = {}, []
    for k in range(240):
        text = plain()
        if k % 2:
            for _ in range(8):
                text.insert(draw.randrange(len(text)), draw.choice(VILE))
        docs[k] = " ".join(text)
        labels.append((k, 1, k % 2))
    for k in range(1000, 1010):
        docs[k] = " ".join(plain(5))  # too short
    for k in range(1010, 1020):
        docs[k] = " ".join(plain(8) * 10)  # repeats itself
    for k in range(1020, 1030):
        docs[k] = docs[2 * (k - 1020)].replace(" ", "  ")  # equal but for spaces
    for k in range(1030, 1040):
        near = docs[40 + 2 * (k - 1030)].split()
        near[-1] = "ende"
        docs[k] = " ".join(near)
    docs[1040] = docs[1]  # an equal toxic row
    docs[1041] = docs[1000]  # an equal bad row
    docs[-5] = docs[1042] = " ".join(plain())
    return docs, labels


def clean(docs):
    return {k for k, t in docs.items() if not set(t.split()) & set(VILE)}


def good(docs, kept):
    def passes(text):
        words = text.split()
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        again = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)}
        return len(words) >= 10 and 100 * len(again) <= 20 * len(words)

    return {k for k in kept if passes(docs[k])}


def unequal(docs, kept):
    first = {}
    for k in sorted(kept):
        first.setdefault(" ".join(docs[k].split()), k)
    return set(first.values())


def far(docs, kept):
    sets = {k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for k in kept for w in [docs[k].split()]}
    root = {k: k for k in kept}
    changed = True
    while changed:
        changed = False
        for a in kept:
            for b in kept:
                if root[a] < root[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                    root[b], changed = root[a], True
    return {k for k in kept if root[k] == k}


def test_every_stage(spark, tmp_path, monkeypatch):
    docs, labels = planted()
    spark.createDataFrame(
        [(k, t, "en", "s", len(t)) for k, t in docs.items()],
        "doc_id long, text string, lang string, source string, n_chars long",
    ).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stages, keep = [], corpus_pipeline.stored

    def stored(frame, path):
        stages.append(keep(frame, path))
        return stages[-1]

    monkeypatch.setattr(corpus_pipeline, "stored", stored)
    corpus_pipeline.run(spark, str(tmp_path))
    got = [[r.doc_id for r in s.select("doc_id").collect()] for s in stages]
    want = [clean(docs)]
    for plain in (good, unequal, far):
        want.append(plain(docs, want[-1]))
    assert all(len(a) > len(b) for a, b in zip([docs, *want], want, strict=False))
    for rows, ids in zip(got, want, strict=False):
        assert sorted(rows) == sorted(ids)
    assert set(got[4]) == want[3]  # packing: in pieces, all of them
