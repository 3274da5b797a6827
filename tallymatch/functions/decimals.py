"""Decimal text of any length: one spelling per number, so that equality is equality of text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sign, whole digits, fraction digits, exponent.  An exponent of more than nine digits is no number.
_NUMBER = r"\A\s*([+-]?)(\d*)(?:\.(\d*))?(?:[eE]([+-]?\d{1,9}))?\s*\z"

#: Scales of DECIMAL(37, s) in which a difference is tried, the one for usual sums first.
#: One digit below the maximum, so that the difference keeps its scale.
_SCALES = (18, 10, 6, 4, 2, 1, 0, 28, 36)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _parts(c: Column) -> Column:
    """Struct of a number's text: whether it is one, its sign, its digits without outer zeros
    (none for zero), and the power of ten that they are multiplied by."""

    def marked(text: Column) -> Column:
        # One match gives all groups: a number's text holds no comma, so what is replaced has changed.
        return _let(
            F.regexp_replace(text, _NUMBER, "$1,$2,$3,$4"),
            lambda groups: F.struct((groups != text).alias("shaped"), F.split(groups, ",").alias("groups")),
        )

    def matched(g: Column) -> Column:
        sign, whole, part, power = (F.get(g["groups"], F.lit(k)) for k in range(4))
        return F.struct(
            g["shaped"].alias("shaped"),
            sign.alias("sign"),
            F.concat(whole, part).alias("all"),
            F.length(part).alias("behind"),
            F.coalesce(power.try_cast("bigint"), F.lit(0).cast("bigint")).alias("power"),
        )

    def without_zeros(m: Column) -> Column:
        return F.struct(m.alias("m"), F.ltrim(m["all"], F.lit("0")).alias("front"))

    def numbered(f: Column) -> Column:
        digits = F.rtrim(f["front"], F.lit("0"))
        return F.struct(
            (f["m"]["shaped"] & (F.length(f["m"]["all"]) > 0)).alias("ok"),
            F.when(f["m"]["sign"] == "-", "-").otherwise("").alias("sign"),
            digits.alias("digits"),
            (f["m"]["power"] - f["m"]["behind"] + F.length(f["front"]) - F.length(digits)).alias("exponent"),
        )

    return _let(c, lambda text: _let(_let(_let(marked(text), matched), without_zeros), numbered))


def canonical(c: Column) -> Column:
    """Decimal text as sign, digits without outer zeros, and exponent; NULL where it is no number.

    ``1.10``, ``+01.1`` and ``11e-1`` are all ``11E-1``; every zero is ``0``.  No digit is ever lost.
    """

    def spelled(p: Column) -> Column:
        number = F.concat(p["sign"], p["digits"], F.lit("E"), p["exponent"].cast("string"))
        return F.when(p["ok"], F.when(p["digits"] == "", "0").otherwise(number))

    return _let(_parts(c), spelled)


def fraction_digits(c: Column) -> Column:
    """Digits behind the point that the number needs; NULL where it is no number."""
    none = F.lit(0).cast("bigint")
    return _let(
        _parts(c), lambda p: F.when(p["ok"], F.when(p["digits"] == "", none).otherwise(F.greatest(-p["exponent"], none)))
    )


#: Numbers written out are at most that long; beyond, ``plain`` is NULL.
_LONGEST = 10_000


def _written(p: Column) -> Column:
    def placed(q: Column) -> Column:
        behind, digits = q["behind"], q["padded"]
        whole = F.concat(digits.substr(F.lit(1), F.length(digits) - behind), F.repeat(F.lit("0"), q["zeros"]))
        part = F.when(behind > 0, F.concat(F.lit("."), F.right(digits, behind))).otherwise("")
        return F.concat(q["sign"], whole, part)

    behind = F.greatest(-p["exponent"], F.lit(0).cast("bigint")).cast("int")
    padded = F.lpad(p["digits"], F.greatest(F.length(p["digits"]), behind + 1), F.lit("0"))
    zeros = F.greatest(p["exponent"], F.lit(0).cast("bigint")).cast("int")
    shape = F.struct(p["sign"].alias("sign"), padded.alias("padded"), behind.alias("behind"), zeros.alias("zeros"))
    short = F.abs(p["exponent"]) + F.length(p["digits"]) <= _LONGEST
    return F.when(p["ok"], F.when(p["digits"] == "", "0").when(short, _let(shape, placed)))


def plain(c: Column) -> Column:
    """The number written out: no exponent, no zeros that do not count."""
    return _let(_parts(c), _written)


def exact_difference(new: Column, old: Column) -> Column:
    """new - old as plain text, where the sides are equal or one DECIMAL type holds both and the result; else NULL."""

    def fits(p: Column, scale: int) -> Column:
        whole = F.length(p["digits"]) + p["exponent"]
        return p["ok"] & ((p["digits"] == "") | ((p["exponent"] >= -scale) & (whole <= 37 - scale)))

    def subtracted(s: Column) -> Column:
        def at(scale: int) -> Column:
            kind = f"decimal(37,{scale})"
            both = [s[side].try_cast(kind) for side in ("new_text", "old_text")]
            return F.when(fits(s["new"], scale) & fits(s["old"], scale), F.try_subtract(*both).cast("string"))

        return F.coalesce(*[at(scale) for scale in _SCALES])

    def sides(s: Column) -> Column:
        texts = [_written(s[side]).alias(f"{side}_text") for side in ("new", "old")]
        return F.struct(s["new"].alias("new"), s["old"].alias("old"), *texts)

    def difference(s: Column) -> Column:
        new_, old_ = s["new"], s["old"]
        alike = (new_["digits"] == old_["digits"]) & (
            (new_["digits"] == "") | ((new_["sign"] == old_["sign"]) & (new_["exponent"] == old_["exponent"]))
        )
        # Equal numbers, most of them, are neither written out nor subtracted.
        both = new_["ok"] & old_["ok"]
        return F.when(both & alike, "0").when(both, plain(_let(sides(s), subtracted)))

    return _let(F.struct(_parts(new).alias("new"), _parts(old).alias("old")), difference)
