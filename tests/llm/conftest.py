from __future__ import annotations

import pytest

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that operators use for their own columns.
    "kept boolean, keep_id long, _row long, _digest string, n_words long, _words string, score double, "
    "length long, rank long, shard int, component_id long, ids binary"
)
LONG = "lorem " * 3000 + "x" * 30_000 + " ende" * 2000
PROSE = (
    "the quick brown fox jumps over a lazy dog while seven wizards quietly boil extra large jars of "
    "purple fig jam near the old stone bridge and nobody asks them why it takes so long today"
)


def nasty_rows():
    texts = [
        (1, PROSE),
        (2, None),
        (3, ""),
        (4, " \t\n "),
        (5, PROSE.replace(" ", "  ")),
        (None, "no id here"),
        (6, LONG),
        (7, "Größe «naïve» 日本語 \U0001f600 \x1c\x85 <|endoftext|> it's"),
        (8, "same row twice"),
        (8, "same row twice"),
        (9, PROSE.upper()),
        (10, PROSE + " indeed"),
        (2_000_000_000_000, "one\ntwo\none\n\none " * 30),
    ]
    extra = (True, -1, -2, "d", -3, "w", -1.0, -4, -5, -6, -7, b"i")
    return [(k, t, None, "s", None if t is None else len(t), *extra) for k, t in texts]


@pytest.fixture(scope="session")
def nasty(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("nasty") / "documents.parquet")
    spark.createDataFrame(nasty_rows(), COLUMNS).repartition(3).write.parquet(folder)
    return spark.read.parquet(folder)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.collect()}
