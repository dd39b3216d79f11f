"""Text helpers under one rule: an empty string is a null.

The catalogs use ``-`` for "no value" and give blanks no meaning of their own,
so everything that can shorten a string turns an empty result into null.
All helpers are ``Column -> Column`` and made of built-ins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARK = "-"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def clean_sql(name: str) -> str:
    """SQL text of `clean` for a column name."""
    return f"CASE WHEN `{name}` <> '{NULL_MARK}' THEN nullif(trim(`{name}`), '') END"


def clean(c: Column) -> Column:
    """Null for the null mark, otherwise the value without outer spaces.

    The mark is compared before trimming: a padded mark is a real dash.
    """
    return F.when(c != NULL_MARK, blank_to_null(F.trim(c)))


def remove(c: Column, *pieces: str) -> Column:
    """Delete every occurrence of each piece."""
    for piece in pieces:
        c = F.replace(c, F.lit(piece), F.lit(""))
    return blank_to_null(c)


def strip_end(c: Column, chars: str = "?") -> Column:
    """Strip all trailing characters found in `chars`."""
    return blank_to_null(F.rtrim(c, F.lit(chars)))


def piece(c: Column, start: int, length: int | None = None) -> Column:
    """Substring from a 1-based position; to the end if no length is given."""
    size = F.char_length(c) if length is None else F.lit(length)
    return blank_to_null(F.substr(c, F.lit(start), size))


def before_first(c: Column, mark: str) -> Column:
    """Text before the first mark, or all of it when there is none."""
    return blank_to_null(F.substring_index(c, mark, 1))


def before_last(c: Column, mark: str) -> Column:
    """Text before the last mark, or null when there is none."""
    kept = F.char_length(c) - F.char_length(F.substring_index(c, mark, -1)) - len(mark)
    return F.when(F.contains(c, F.lit(mark)), blank_to_null(F.substr(c, F.lit(1), kept)))


def after_last(c: Column, mark: str) -> Column:
    """Text after the last mark, or all of it when there is none."""
    return blank_to_null(F.substring_index(c, mark, -1))


def first_token(c: Column) -> Column:
    """Text before the first blank, leading blanks skipped."""
    return blank_to_null(F.regexp_extract(c, "[^ ]+", 0))


def after_first_blank(c: Column) -> Column:
    """Trimmed text after the first run of white space."""
    return blank_to_null(F.trim(F.regexp_extract(c, r"\s+(.*)", 1)))


def glue(*parts: Column) -> Column:
    """Concatenate, with null as nothing."""
    return blank_to_null(F.concat_ws("", *parts))


def yes_no(condition: Column) -> Column:
    return F.when(condition, "Yes").otherwise("No")
