r"""Quality rules as a ledger of bits, in DataFrame functions only.

Every rule is evaluated once: a document gets its measurements and one long, ``failed_bits``,
in which bit i says that rule i failed.  Policies are versioned sets of rules, so a
decision is ``failed_bits & policy.mask``, and an ablation (what would a policy keep
without one of its rules?) is bitwise arithmetic on the counts of distinct ledgers.

Words are ``[^\x20\x09-\x0D]+``.  ``n_repeat_words`` counts the words that lie in a 5-word
window whose words occur as a window twice or more in the text.  Windows are compared by
the 64-bit hash of their word hashes: two different windows of one text of a million
windows agree with a chance of about 3e-8.  All work stays in the row; nothing is shuffled.

Defined cases: a null or empty text has no words, so it fails ``few_words``; a null
``doc_id`` is kept as it is; repeated rows are judged each for itself; an empty table gives
an empty ledger; further columns stay unless they bear the name of a measurement, in which
case the measurement replaces them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, count_of, table

WINDOW = 5
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements."""

    name: str
    fails: str


#: The order gives the bits.  New rules go to the end, so that stored ledgers stay readable.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("capitals", "100 * n_capitals > 40 * word_chars"),
    Rule("repeated_lines", "100 * n_dup_lines > 60 * n_lines"),
    Rule("exclamations", "10 * n_exclamations > 2 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """A version of what is demanded: the rules that a kept document must not fail."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        names = [r.name for r in RULES]
        return sum(1 << names.index(r) for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
STRICT = Policy("web_text", 1, tuple(r.name for r in RULES))


def measured(docs: DataFrame) -> DataFrame:
    """Add the measurements of every text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # Each step reads columns the step before has made, so that no lambda below carries an
    # expression that would be worked out again for every element.
    one = docs.withColumns(
        {
            "_words": F.transform(F.expr(f"regexp_extract_all(coalesce(text, ''), r'{WORD}', 0)"), lambda w: F.xxhash64(w)),
            "_lines": F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)),
            "word_chars": F.length(F.translate(text, "\x20\x09\x0a\x0b\x0c\x0d", "")).cast("long"),
            "n_symbols": count_of(text, SYMBOLS).cast("long"),
            "n_capitals": count_of(text, CAPITALS).cast("long"),
            "n_exclamations": count_of(text, "!").cast("long"),
        }
    )
    words = F.col("_words")
    window = F.transform(
        words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, WINDOW)])
    )
    two = one.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            # The last four windows are short of words and are left out.
            "_windows": F.slice(window, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))),
        }
    )
    three = two.withColumn("_repeats", F.size("_windows") > F.size(F.array_distinct("_windows")))
    ordered = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    four = three.withColumn("_ordered", F.when(F.col("_repeats"), ordered))
    near = F.zip_with(
        F.transform("_ordered", lambda x, k: F.struct(x.alias("x"), F.get(F.col("_ordered"), k - 1).alias("before"))),
        F.transform("_ordered", lambda x, k: F.get(F.col("_ordered"), k + 1)),
        lambda a, after: F.struct(
            a.x.i.alias("i"),
            (a.x.h.eqNullSafe(a.before.h) | a.x.h.eqNullSafe(after.h)).alias("twice"),
        ),
    )
    five = four.withColumn(
        "_places", F.sort_array(F.transform(F.filter(near, lambda x: x.twice), lambda x: x.i))
    )
    covered = F.aggregate(
        F.transform(
            "_places",
            lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_places"), k + 1) - p, F.lit(WINDOW))),
        ),
        F.lit(0),
        lambda a, b: a + b,
    )
    return five.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop(
        "_words", "_lines", "_windows", "_repeats", "_ordered", "_places"
    )


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements and ``failed_bits`` of every document."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(RULES)]
    total = bits[0]
    for bit in bits[1:]:
        total = total + bit
    # The condition always holds.  It depends on the row's number, so the optimizer leaves the
    # measurements below: a filter on the bits, pushed down, would repeat them over and over.
    return measured(docs).withColumn("failed_bits", F.when(F.monotonically_increasing_id() >= 0, total.cast("long")))


def passes(policy: Policy) -> Column:
    return F.col("failed_bits").bitwiseAND(F.lit(policy.mask)) == 0


def ablations(entries: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of a policy: documents failing it, failing only it, kept, kept without it.

    One aggregate over distinct ledgers (at most two to the number of rules).
    """
    seen = entries.groupBy(F.col("failed_bits").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(
        F.count(F.lit(1)).alias("n")
    )
    names = [r.name for r in RULES]
    each = F.array(
        *[F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("long").alias("bit")) for r in policy.rules]
    )
    rest = F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit")))
    n = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))
    return (
        seen.select("bits", "n", F.inline(each))
        .groupBy("rule")
        .agg(
            n(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("failed"),
            n(F.col("bits") == F.col("bit")).alias("failed_alone"),
            n(F.col("bits") == 0).alias("kept"),
            n(rest == 0).alias("kept_without"),
            F.bit_or(rest).alias("other_bits"),
        )
    )


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: measurements and verdict of every document."""
    return ledger(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~passes(BASE)).alias("base_failed"),
        passes(STRICT).alias("kept"),
        "failed_bits",
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: the documents that the policy keeps, with their own columns."""
    held = F.struct(*[F.col(c) for c in docs.columns])
    return (
        ledger(docs.select(held.alias("_doc"), "text")).where(passes(STRICT)).select("_doc.*")
    )


QUERIES = {"op2_quality_rules": quality_rules}

SQL = {
    "op2_quality_rules": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents
), w AS (
  SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS pos
  FROM (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d)
), win AS (
  SELECT r, pos, word,
         CASE WHEN lead(pos, 4) OVER o IS NOT NULL THEN
           concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o)
         END AS five
  FROM w WINDOW o AS (PARTITION BY r ORDER BY pos)
), twice AS (
  SELECT r, pos, word, (five IS NOT NULL AND count(*) OVER (PARTITION BY r, five) > 1)::INT AS starts FROM win
), covered AS (
  SELECT r, word, max(starts) OVER (PARTITION BY r ORDER BY pos ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c
  FROM twice
), words AS (
  SELECT r, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars, sum(c)::BIGINT AS n_repeat_words
  FROM covered GROUP BY r
), lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), m AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals,
         length(text) - length(regexp_replace(text, '!', '', 'g')) AS n_exclamations,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN words USING (r) LEFT JOIN lines USING (r)
), f AS (
  SELECT *, (n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT
    + 4 * (10 * n_symbols > n_words)::INT + 8 * (100 * n_capitals > 40 * word_chars)::INT
    + 16 * (100 * n_dup_lines > 60 * n_lines)::INT + 32 * (10 * n_exclamations > 2 * n_words)::INT AS bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       bits & 3 <> 0 AS base_failed, bits = 0 AS kept, bits::BIGINT AS failed_bits
FROM f
""",
}
