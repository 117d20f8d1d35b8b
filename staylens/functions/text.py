"""Free-text standardisation and keyword flags."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from staylens.functions.parsing import squeeze, strip


def capitalise_words(c: Column) -> Column:
    """Upper-case the first letter of each word and leave the rest as it is."""
    parts = F.regexp_extract_all(c, F.lit(r"((?U)\w+|\W+)"), 1)
    raised = F.transform(
        parts, lambda p: F.concat(F.upper(p.substr(1, 1)), p.substr(F.lit(2), F.length(p)))
    )
    return F.array_join(raised, "")


def tidy_words(c: Column) -> Column:
    """Squeezed text with one spelling of condo and capitalised words."""
    return capitalise_words(F.regexp_replace(squeeze(c), "(?i)condominium", "condo"))


def family(c: Column) -> Column:
    """Coarse property family; a missing type is Other."""
    text = F.lower(c)
    return (
        F.when(text.startswith("entire"), "Entire place")
        .when(text.startswith("private room"), "Private room")
        .when(text.startswith("shared room"), "Shared room")
        .when(text.contains("hotel") | text.contains("hostel"), "Hotel/Hostel")
        .otherwise("Other")
    )


def before_comma(c: Column) -> Column:
    return squeeze(F.split_part(c, F.lit(","), F.lit(1)))


def title_segment(slug: Column, position: int) -> Column:
    """Segment of a path slug as a title: north-holland -> North Holland."""
    return F.initcap(F.replace(F.split_part(slug, F.lit("/"), F.lit(position)), F.lit("-"), F.lit(" ")))


def has_word(c: Column, words: tuple[str, ...]) -> Column:
    pattern = r"(?i)\b(" + "|".join(re.escape(w) for w in words) + r")\b"
    return F.coalesce(c, F.lit("")).rlike(pattern)


def flag_name(text: str) -> str:
    return "has_" + re.sub(r"[^a-z0-9]+", "_", text.lower()).strip("_")


def list_flags(c: Column, names: tuple[str, ...]) -> list[Column]:
    """One flag per name: some element of the JSON list contains it, any case."""
    items = F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))

    def listed(name: str) -> Column:
        return F.coalesce(F.exists(items, lambda x: F.lower(x).contains(name.lower())), F.lit(False))

    return [listed(name).alias(flag_name(name)) for name in names]


def sorted_tokens(c: Column) -> Column:
    """Words in order, one blank between them, case kept."""
    return F.array_join(F.array_sort(F.split(strip(c), r"(?U)\s+")), " ")
