"""Fill-in-middle documents, cut at units that a wavelet matrix counts.

Every code point has a class, and a letter that goes on a run of letters has one of its
own, so the classes in which units begin can be counted.  The class sequence of a slice of
texts goes into one wavelet matrix; ranks of classes give the number of units before any
position, and a bisection on those ranks, for all texts of the slice at once, finds the
position of a cut.  Texts are never split into lists of units.

Defined cases: a null text is an empty one, and an empty text stays plain; a text that holds
a marker stays plain, so what stands between markers can be read back exactly; long texts
are cut whole; the cuts depend on ``doc_id`` alone, so repeated rows get equal results; a
null ``doc_id`` draws as an empty one; an empty table gives an empty one; only ``doc_id``
and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import ship, slices, table

#: Classes of code points.
GOES_ON, LETTERS, WHITE, BREAK, DIGIT, MARK, OTHER = range(7)
CLASS_BITS = 3

#: Classes whose code points begin a unit.
TOKENS = (LETTERS, WHITE, BREAK, DIGIT, MARK, OTHER)
WORDS = (LETTERS,)
LINES = (BREAK,)

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

OUT = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, "
    "output_sha256 string, restored_sha256 string"
)


@dataclass(frozen=True)
class Settings:
    """``seed`` goes before the id that draws the cuts; percentages of texts left plain, and of spm among the others."""

    seed: str = "1"
    plain_percent: int = 10
    spm_percent: int = 20
    units: tuple[int, ...] = TOKENS


QUERY = Settings()


class BitRanks:
    """Ones before a position of a bit vector, by counts at word boundaries and one word's popcount."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, dtype=np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def __call__(self, at: np.ndarray) -> np.ndarray:
        word, place = at >> 6, (at & 63).astype(np.uint64)
        below = (np.uint64(1) << place) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Ranks of symbols: a bit vector for each bit of a symbol, from the highest, sorted stably by it in between."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for bit in reversed(range(bits)):
            ones = (symbols >> bit) & 1
            self.levels.append((bit, BitRanks(ones), len(ones) - int(ones.sum())))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before each position."""
        low, high = np.zeros(1, dtype=np.int64), at
        for bit, ones, zeros in self.levels:
            if symbol >> bit & 1:
                low, high = zeros + ones(low), zeros + ones(high)
            else:
                low, high = low - ones(low), high - ones(high)
        return high - low


def _ascii_classes() -> np.ndarray:
    kinds = np.full(128, MARK, dtype=np.uint8)
    for k in range(128):
        if chr(k).isalpha():
            kinds[k] = LETTERS
        elif chr(k).isdigit():
            kinds[k] = DIGIT
    kinds[[9, 32]] = WHITE
    kinds[10:14] = BREAK
    return kinds


ASCII_CLASSES = _ascii_classes()


class UnitIndex:
    """Unit counts and cuts of several texts, kept end to end in one wavelet matrix."""

    def __init__(self, texts: list[str], units: tuple[int, ...]):
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)))
        self.starts, self.ends = np.concatenate([[0], ends[:-1]]).astype(np.int64), ends
        kinds = np.full(len(points), OTHER, dtype=np.uint8)
        plain = points < 128
        kinds[plain] = ASCII_CLASSES[points[plain]]
        letter = kinds == LETTERS
        goes_on = letter[1:] & letter[:-1]
        firsts = self.starts[(self.starts > 0) & (self.starts < len(points))]
        goes_on[firsts - 1] = False
        kinds[1:][goes_on] = GOES_ON
        self.matrix = WaveletMatrix(kinds, CLASS_BITS)
        # Whichever of the classes and the rest are fewer are counted.
        rest = tuple(k for k in range(1 << CLASS_BITS) if k not in units and k <= OTHER)
        self.inverse = len(rest) < len(units)
        self.counted = rest if self.inverse else units

    def before(self, at: np.ndarray) -> np.ndarray:
        """Units that begin before each position."""
        found = sum((self.matrix.rank(k, at) for k in self.counted), np.zeros(len(at), dtype=np.int64))
        return at - found if self.inverse else found

    def counts(self) -> np.ndarray:
        return self.before(self.ends) - self.before(self.starts)

    def cuts(self, units: np.ndarray) -> np.ndarray:
        """For every text the code points of its first ``units`` units."""
        goal = self.before(self.starts) + units
        low, high = self.starts.copy(), self.ends.copy()
        while (low < high).any():  # the last position with no more units than that before it
            middle = (low + high + 1) >> 1
            fits = self.before(middle) <= goal
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low - self.starts


def draws(key: int | None, seed: str) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4)]


def form_of(text: str, h3: int, h4: int, settings: Settings) -> str:
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= 100 - settings.plain_percent:
        return PLAIN
    return SPM if h4 % 100 < settings.spm_percent else PSM


def render(text: str, form: str, first: int, second: int) -> str:
    """The text in its form: prefix up to ``first``, middle up to ``second``."""
    if form == PLAIN:
        return text
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if form == SPM:
        return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text that was rendered; no part holds a marker, so the first of each is its place."""
    if form == PLAIN:
        return output
    head, inner = (SUFFIX, PREFIX) if form == SPM else (PREFIX, SUFFIX)
    one, _, rest = output.removeprefix(head).partition(inner)
    two, _, middle = rest.partition(MIDDLE)
    prefix, suffix = (two, one) if form == SPM else (one, two)
    return prefix + middle + suffix


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def transform(docs: DataFrame, settings: Settings = QUERY, *, texts: bool = True) -> DataFrame:
    """Every document in its form, with the places of its cuts; ``texts=False`` leaves the output out."""
    ship(docs.sparkSession)
    schema = OUT if texts else OUT.replace("output string, ", "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, rows in slices(batches):
            drawn = [draws(k, settings.seed) for k in keys]
            index = UnitIndex(rows, settings.units)
            n = index.counts()
            h = np.array(drawn, dtype=np.int64).reshape(-1, 4)
            ends = [index.cuts(f(h[:, 0] % (n + 1), h[:, 1] % (n + 1))) for f in (np.minimum, np.maximum)]
            forms = [form_of(t, d[2], d[3], settings) for t, d in zip(rows, drawn, strict=True)]
            places = list(zip(*(e.tolist() for e in ends), strict=True))
            outputs = [render(t, f, *p) for t, f, p in zip(rows, forms, places, strict=True)]
            cut = [(None, None) if f == PLAIN else (a, b - a) for f, (a, b) in zip(forms, places, strict=True)]
            columns = {
                "doc_id": pa.array(keys, type=pa.int64()),
                "n": pa.array(n),
                "form": pa.array(forms, type=pa.string()),
                "prefix_chars": pa.array([a for a, _ in cut], type=pa.int64()),
                "middle_chars": pa.array([b for _, b in cut], type=pa.int64()),
                **({"output": pa.array(outputs, type=pa.string())} if texts else {}),
                "output_sha256": pa.array(map(_sha, outputs), type=pa.string()),
                "restored_sha256": pa.array(map(_sha, map(restore, outputs, forms)), type=pa.string()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the form and digests of every document."""
    return transform(table(spark, sf_dir, "documents"), QUERY, texts=False)


QUERIES = {"op13_fill_in_middle": fill_in_middle}

SQL = {
    "op13_fill_in_middle": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), drawn AS (
  SELECT doc_id, text, units, len(units) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS x,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS y,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), parts AS (
  SELECT doc_id, text, n, form,
         array_to_string(units[1:least(x, y)], '') AS p,
         array_to_string(units[least(x, y) + 1:greatest(x, y)], '') AS m,
         array_to_string(units[greatest(x, y) + 1:], '') AS s
  FROM drawn
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
                        ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
""",
}
