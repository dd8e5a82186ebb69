"""String column functions."""

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from bidlake.functions import fixed

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def any_of(words: list[str]) -> str:
    """Regular expression that finds any of the literal words."""
    return "|".join(re.escape(w) for w in words)


def holds_any(c: Column, words: list[str]) -> Column:
    """Does the text hold any of the literal words?"""
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(w)) for w in words])


def strip_ws(c: Column) -> Column:
    """Drop Unicode whitespace at both ends; an all-blank text becomes empty, not null."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def norm_ws(c: Column) -> Column:
    """Every whitespace run becomes one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def norm_blanks(c: Column) -> Column:
    """Like `norm_ws`, but only blanks and tabs are collapsed: line breaks inside stay."""
    return strip_ws(F.regexp_replace(c, r"[ \t]+", " "))


def blank_to_null(c: Column) -> Column:
    """The text `nan` is erased, whitespace collapsed, and what is then empty is null."""
    return F.nullif(norm_ws(F.when(c == "nan", "").otherwise(c)), F.lit(""))


def na_to_null(c: Column) -> Column:
    """Null where the text is one of the missing-value words."""
    return F.when(~c.isin(fixed.NA_TOKENS), c)


def strip_punct(c: Column) -> Column:
    """Drop blanks and commas at both ends; empty becomes null."""
    return F.nullif(F.btrim(c, F.lit(" ,")), F.lit(""))


def normalize_unit(c: Column) -> Column:
    """Upper-case unit, `-` and `/` as blanks, known spellings mapped to their code."""
    shown = F.translate(F.upper(norm_ws(c)), "-/", "  ")
    pairs = [F.lit(x) for pair in fixed.UNIT_SYNONYMS.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), shown), shown)


def to_number(c: Column) -> Column:
    """Text to double, null unless it is a plain number (so `1.5d` and `abc` are null)."""
    t = strip_ws(c)
    return F.when(t.rlike(NUMBER), t.try_cast("double"))


def money(c: Column) -> Column:
    """`$1,234.50` to double, null where it is not a number."""
    return to_number(F.translate(c, "$,", ""))


def printed_number(c: Column) -> Column:
    """Money or quantity that a pattern has already found to be digits, commas and a point."""
    return F.translate(c, "$, \t", "").try_cast("double")


def qty(c: Column) -> Column:
    """`3,890` to double, null where it is not a number."""
    return to_number(F.translate(c, ",", ""))


def capture(c: Column, pattern: str, group: int = 1) -> Column:
    """First match's group, null where there is no match (or an empty one)."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def is_engineer(c: Column) -> Column:
    """Does the text name the engineer's estimate?"""
    return c.rlike(fixed.ENGINEER)


def safe_stem(c: Column) -> Column:
    """File name of a path without its extension, other characters than A-Za-z0-9._- as `_`."""
    return F.regexp_replace(F.regexp_extract(c, r"([^/]+?)(\.[^./]*)?$", 1), r"[^A-Za-z0-9._-]+", "_")


def csv_stem(c: Column) -> Column:
    """Document key held in the name of a parsed CSV file."""
    name = F.substring_index(c, "/", -1)
    for tail in ("_line_items_filled.csv", "_line_items.csv", "_bids_summary.csv"):
        name = F.replace(name, F.lit(tail), F.lit(""))
    return name


def project_id() -> Column:
    """`name|schedule|option`, null parts as empty text."""
    return F.concat_ws("|", *[F.coalesce(F.col(k), F.lit("")) for k in ("project_name", "schedule", "option")])
