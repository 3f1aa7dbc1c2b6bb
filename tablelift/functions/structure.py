"""Expressions over one physical line of a delimited file (quotes are ordinary data here)."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from tablelift.functions.text import WHITESPACE

# Fixed value: a number with more digits than this counts double as data.
LONG_NUMBER = 10


def strip_line(line: Column, delimiter: str) -> Column:
    """Trim the line's surrounding white space, but never a delimiter: it ends a field."""
    return F.btrim(line, F.lit("".join(c for c in WHITESPACE if c != delimiter)))


def split_fields(line: Column, delimiter: str) -> Column:
    return F.split(strip_line(line, delimiter), re.escape(delimiter), -1)


def field_count(line: Column, delimiter: str) -> Column:
    return F.size(split_fields(line, delimiter))


def truncate_fields(line: Column, delimiter: str, keep: int) -> Column:
    """The first ``keep`` fields of the line."""
    return F.array_join(F.slice(split_fields(line, delimiter), 1, keep), delimiter)


def field_count_verdict(actual: Column, expected: int) -> Column:
    return F.when(actual == expected, "ok").when(actual > expected, "extra").otherwise("missing")


def looks_like_header(line: Column, delimiter: str, leading: int | None = None) -> Column:
    """True when the fields (or only so many ``leading`` ones) look more like column names than like data.

    A field with a letter that is more than plain words counts for a header; a field of digits
    counts for data, twice when it is long.  Plain words are header names when nothing else is there.
    """
    every = split_fields(line, delimiter)
    fields = F.transform(every if leading is None else F.slice(every, 1, leading), lambda f: F.btrim(f, F.lit(WHITESPACE)))

    def how_many(pattern: str) -> Column:
        return F.size(F.filter(fields, lambda f: f.rlike(pattern)))

    with_letter, plain_words = how_many(r"\p{L}"), how_many(r"^[_ ]*\p{L}[\p{L}_ ]*$")
    numbers, long_numbers = how_many(r"^\d+$"), how_many(r"^\d{%d,}$" % (LONG_NUMBER + 1))
    for_header, for_data = with_letter - plain_words, numbers + long_numbers
    return (for_header > for_data) | ((for_data == 0) & (plain_words > 0))
