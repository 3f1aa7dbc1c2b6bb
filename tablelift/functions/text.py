"""Cleaning of text columns.  Everything is a built-in expression, so it stays in codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablelift.formats import CP1252_NAMES, LATIN1_NAMES

# The two control characters a load removes (NUL and SUB).
CONTROL_CHARACTERS = "\x00\x1a"

# White space that surrounds a line (never a delimiter, see structure.py).
WHITESPACE = " \t\n\r\x0b\x0c"

# Windows-1252 differs from latin-1 only in the bytes 80..9F; five of those are unused.
_C1 = [chr(b) for b in range(0x80, 0xA0)]
_C1_IN_CP1252 = [bytes([b]).decode("cp1252", errors="replace") for b in range(0x80, 0xA0)]
_REPLACEMENT = "\ufffd"
_CP1252_SPECIALS = "".join(c for c in _C1_IN_CP1252 if c != _REPLACEMENT)

# One character a charset cannot hold.  The cheap range test comes first: nearly every character
# of a text fails it, so the short list of special characters is hardly ever looked at.
_UNMAPPABLE = {
    "ascii": r"[^\x00-\x7f]",
    "latin1": r"[^\x00-\xff]",
    "cp1252": r"[\x80-\x9f\x{100}-\x{10ffff}&&[^" + _CP1252_SPECIALS + "]]",
}
_HAS_CP1252_SPECIAL = r"[\x{100}-\x{ffff}&&[" + _CP1252_SPECIALS + "]]"
_HAS_C1 = r"[\x80-\x9f]"


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def map_strings(df: DataFrame, change, columns: list[str] | None = None) -> DataFrame:
    """Apply ``change`` to every string column (or the named ones) in one projection."""
    names = set(string_columns(df) if columns is None else columns)
    return df.select(*[change(F.col(f"`{c}`")).alias(c) if c in names else F.col(f"`{c}`") for c in df.columns])


def strip_control(column: Column) -> Column:
    """Remove NUL and SUB characters."""
    for character in CONTROL_CHARACTERS:
        column = F.replace(column, F.lit(character), F.lit(""))
    return column


def strip_control_all(df: DataFrame) -> DataFrame:
    return map_strings(df, strip_control)


def null_marker(column: Column, marker: str = "") -> Column:
    """NULL where the text equals the marker (by default: empty text)."""
    return F.nullif(column, F.lit(marker))


def charset_key(charset: str) -> str:
    name = charset.lower().replace("_", "-")
    if name in CP1252_NAMES:
        return "cp1252"
    if name in LATIN1_NAMES:
        return "latin1"
    if name in ("ascii", "us-ascii"):
        return "ascii"
    raise ValueError(f"no one-byte charset {charset!r}")


def unmappable(charset: str) -> str:
    """Regex for one character that ``charset`` cannot hold."""
    return _UNMAPPABLE[charset_key(charset)]


def to_charset(column: Column, charset: str = "cp1252", replacement: str = "?") -> Column:
    """Replace each character the charset cannot hold."""
    return F.regexp_replace(column, F.lit(unmappable(charset)), F.lit(replacement))


def charset_loses(column: Column, charset: str = "cp1252") -> Column:
    """True where :func:`to_charset` would change the text."""
    return F.coalesce(column.rlike(unmappable(charset)), F.lit(False))


def cp1252_to_latin1(column: Column) -> Column:
    """Text whose latin-1 bytes are the cp1252 bytes of the input (used just before a write)."""
    specials = "".join(c for c, s in zip(_C1, _C1_IN_CP1252) if s != _REPLACEMENT)
    return F.when(column.rlike(_HAS_CP1252_SPECIAL), F.translate(column, _CP1252_SPECIALS, specials)).otherwise(column)


def latin1_to_cp1252(column: Column) -> Column:
    """Undo a latin-1 read of cp1252 bytes; unused bytes become the replacement character."""
    return F.when(column.rlike(_HAS_C1), F.translate(column, "".join(_C1), "".join(_C1_IN_CP1252))).otherwise(column)


def is_blank(column: Column) -> Column:
    return F.length(F.btrim(column, F.lit(WHITESPACE))) == 0
