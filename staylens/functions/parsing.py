"""Text columns to typed columns. Bad input gives null, never an error or NaN."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Text forms of a number and of a day, and the white space around them.
NUMBER = r"^\s*([+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:inf(?:inity)?)))\s*$"
INTEGER = r"^\s*([+-]?[0-9]+)\s*$"
DAY = r"^\s*([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})\s*(?:$|[ T].*)"
SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Trim every kind of white space, not blanks only."""
    return F.btrim(c, F.lit(SPACE))


def squeeze(c: Column) -> Column:
    """Trim and turn each run of white space into one blank."""
    return F.regexp_replace(strip(c), r"(?U)\s+", " ")


def num(c: Column) -> Column:
    """One pattern match per value: what it does not take is empty, hence null."""
    return F.regexp_extract(c.cast("string"), NUMBER, 1).try_cast("double")


def whole(c: Column) -> Column:
    """64-bit integer; digits are cast directly so that long ids stay exact."""
    value = num(c)
    return F.coalesce(
        F.regexp_extract(c.cast("string"), INTEGER, 1).try_cast("bigint"),
        F.when(value == F.floor(value), value.try_cast("bigint")),
    )


def money(c: Column) -> Column:
    return num(F.translate(c.cast("string"), "$,", ""))


def percent(c: Column) -> Column:
    return num(F.rtrim(c.cast("string"), F.lit("%"))) / F.lit(100.0)


def parse_date(c: Column) -> Column:
    """Year first, with - or /, and an optional time; then month or day first;
    then English month names."""
    text = F.translate(c.cast("string"), "/", "-")
    other = strip(text)
    return F.coalesce(
        F.try_to_date(F.regexp_extract(text, DAY, 1), "yyyy-M-d"),
        F.when(
            ~text.rlike(DAY),
            F.coalesce(
                F.try_to_date(other, "yyyyMMdd"),
                F.try_to_date(other, "M-d-yyyy"),
                F.try_to_date(other, "d-M-yyyy"),
                F.try_to_date(other, "MMMM d, yyyy"),
                F.try_to_date(other, "MMM d, yyyy"),
                F.try_to_date(other, "d MMM yyyy"),
            ),
        ),
    )


def boolean(c: Column) -> Column:
    text = F.lower(strip(c.cast("string")))
    return F.when(text.isin("t", "true"), True).when(text.isin("f", "false"), False)


def canonical(c: Column, vocabulary: Mapping[str, str]) -> Column:
    """Standard spelling where the lower-case text is known, else the trimmed text."""
    text = strip(c)
    pairs = [F.lit(x) for pair in vocabulary.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(text)), text)


def blank_to_null(c: Column, tokens: tuple[str, ...]) -> Column:
    return F.when(~c.isin(*tokens), c)
