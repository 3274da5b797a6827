"""Text rules: the three spellings of a missing value, and date spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column name as written in an expression, even if it holds dots or back-ticks."""
    return "`" + name.replace("`", "``") + "`"


def name_col(name: str) -> Column:
    """Column by its exact name."""
    return F.col(quoted(name))


def blank_to_null(c: Column) -> Column:
    """An empty string is no value."""
    return F.nullif(c, F.lit(""))


# Character and the letter that stands for it behind a backslash.
_ESCAPES = (("\t", "t"), ("\n", "n"), ("\r", "r"))


def escaped(c: Column) -> Column:
    """Text without tabs, line breaks or the bare word NULL; ``unescaped`` gives it back."""
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for character, letter in _ESCAPES:
        out = F.replace(out, F.lit(character), F.lit("\\" + letter))
    return F.when(out == "NULL", F.lit("\\NULL")).otherwise(out)


def unescaped(c: Column) -> Column:
    """What was ``escaped``.  Between escaped backslashes every backslash begins an escape."""

    def part(p: Column) -> Column:
        for character, letter in _ESCAPES:
            p = F.replace(p, F.lit("\\" + letter), F.lit(character))
        return p

    whole = F.array_join(F.transform(F.split(c, r"\\\\", -1), part), "\\")
    return F.when(c == "\\NULL", F.lit("NULL")).otherwise(whole)


def as_missing(c: Column) -> Column:
    """NULL, the empty string and the word NULL in any case all become NULL."""
    return F.when(~F.upper(c).isin("", "NULL"), c)


def dashed_date(c: Column) -> Column:
    """``yyyyMMdd`` becomes ``yyyy-MM-dd``; text of any other length is kept."""
    dashed = F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))
    return F.when(F.length(c) == 8, dashed).otherwise(c)


def dashed_date_text(data_dt: str) -> str:
    """The same rule for a date given as a parameter."""
    if len(data_dt) != 8:
        return data_dt
    return "-".join((data_dt[:4], data_dt[4:6], data_dt[6:]))
