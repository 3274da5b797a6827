"""Fill-in-middle forms against SQL and a plain Python version."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tallymatch.llm import fill_in_middle as fim

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def plain_version(key, text):
    """(n, form, prefix_chars, middle_chars, output) by a list of units."""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    first, second = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:first], units[first:second], units[second:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(rows, texts):
    forms = set()
    for r in rows:
        text = texts[r.doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_version(r.doc_id, text)
        assert r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()
        forms.add(r.form)
    return forms


def test_documents(documents, texts):
    rows = fim.transform(documents).collect()
    assert len(rows) == len(texts) and check(rows, texts) == {"plain", "psm", "spm"}


def test_cases(spark, nasty, empty):
    rows = fim.transform(nasty).collect()
    assert len(rows) == nasty.count()
    check(rows, {r.doc_id: r.text or "" for r in nasty.collect()})
    assert fim.transform(empty).count() == 0
    marked = [(k, t) for k in range(40) for t in ("a <P> b", "x<M>", "a<", "<S", "P>", "<<P", ">" * 5)]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(marked)], "doc_id long, text string")
    texts = {i: t for i, (_, t) in enumerate(marked)}
    rows = fim.transform(df).collect()
    check(rows, texts)
    assert all(r.form == "plain" for r in rows if "<P>" in texts[r.doc_id] or "<M>" in texts[r.doc_id])


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(alphabet="aZ 9é\n\t<😀", max_size=90), min_size=1, max_size=6), data=st.data())
def test_cuts_of_several_texts(texts, data):
    index = fim.UnitIndex(texts, fim.TOKENS)
    units = [UNIT.findall(t) for t in texts]
    assert index.counts().tolist() == [len(u) for u in units]
    cut = [data.draw(st.integers(0, len(u))) for u in units]
    got = index.cuts(np.array(cut, dtype=np.int64)).tolist()
    assert got == [len("".join(u[:k])) for u, k in zip(units, cut)]


def test_other_units():
    text = "one two\nthree  four\nfive"
    words = fim.UnitIndex([text], fim.WORDS)
    assert words.counts().tolist() == [5]
    places = [m.start() for m in re.finditer("[a-z]+", text)]
    assert [int(words.cuts(np.array([k]))[0]) for k in range(5)] == places
    lines = fim.UnitIndex([text], fim.LINES)
    assert lines.counts().tolist() == [2] and int(lines.cuts(np.array([1]))[0]) == text.rindex("\n")


def test_wavelet_ranks():
    draw = random.Random(3)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = np.array([draw.randrange(7) for _ in range(size)], dtype=np.uint8)
        matrix = fim.WaveletMatrix(symbols, 3)
        at = np.arange(size + 1)
        for symbol in range(8):
            want = [int((symbols[:k] == symbol).sum()) for k in at]
            assert matrix.rank(symbol, at).tolist() == want
