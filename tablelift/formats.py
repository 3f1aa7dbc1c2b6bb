"""Delimited file formats."""

from __future__ import annotations

from dataclasses import dataclass

# The delimiter each named format stands for.
DELIMITERS = {"csv": ",", "tsv": "\t", "pipe": "|", "custom": ","}

# Micro-second timestamps; the writer's own default would cut them to milliseconds.
TIMESTAMP_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# A code point that is no character, so no text holds it.  As NULL marker it keeps an empty field
# apart from a quoted empty text; as the escape's escape it keeps a NUL after a quote.
_NO_CHARACTER = "\ufffe"


@dataclass(frozen=True)
class FlatFormat:
    """How a delimited file is laid out.

    ``quote=None`` switches quoting off: the quote character is then ordinary data.
    ``collapse_empty`` makes empty text and NULL the same on load (both NULL); switch it off to
    get both back as written.  ``null_text`` is a text that stands for NULL instead: it is written
    for NULL, read as NULL, and empty fields are then empty text.
    ``row_delimiter`` ends a record; by default any of the usual line ends.
    ``compression`` is the codec of written files; readers go by the file name.
    """

    format_type: str = "csv"
    delimiter: str | None = None
    quote: str | None = '"'
    escape: str | None = '"'
    header: bool = True
    encoding: str = "utf-8"
    collapse_empty: bool = True
    multi_line: bool = True
    null_text: str = ""
    row_delimiter: str | None = None
    compression: str | None = None

    def __post_init__(self) -> None:
        if self.format_type not in DELIMITERS:
            raise ValueError(f"unknown format {self.format_type!r}, use one of {sorted(DELIMITERS)}")

    @property
    def separator(self) -> str:
        return self.delimiter if self.delimiter is not None else DELIMITERS[self.format_type]

    @property
    def file_encoding(self) -> str:
        """The encoding Spark reads and writes; cp1252 travels as latin-1 bytes (see text.py)."""
        name = self.encoding.lower().replace("_", "-")
        return "iso-8859-1" if name in ONE_BYTE_NAMES else name

    @property
    def is_cp1252(self) -> bool:
        return self.encoding.lower().replace("_", "-") in CP1252_NAMES

    def _shared_options(self) -> dict[str, str]:
        options = {
            "sep": self.separator,
            "quote": self.quote or "",
            "header": str(self.header).lower(),
            "encoding": self.file_encoding,
            "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false",
            "timestampFormat": TIMESTAMP_PATTERN,
            "timestampNTZFormat": TIMESTAMP_PATTERN,
        }
        if self.escape:
            options["escape"] = self.escape
        if self.escape == self.quote:
            options["charToEscapeQuoteEscaping"] = _NO_CHARACTER
        if self.row_delimiter:
            options["lineSep"] = self.row_delimiter
        return options

    def write_options(self) -> dict[str, str]:
        options = self._shared_options()
        if self.null_text:
            options["nullValue"] = self.null_text
        if self.compression:
            options["compression"] = self.compression
        return options

    def read_options(self) -> dict[str, str]:
        options = self._shared_options()
        options["multiLine"] = str(self.multi_line).lower()
        if self.null_text or not self.collapse_empty:
            options["nullValue"] = _NO_CHARACTER
            options["emptyValue"] = ""
        return options


# Names of the one-byte encodings.
CP1252_NAMES = ("cp1252", "windows-1252", "1252")
LATIN1_NAMES = ("latin1", "latin-1", "iso-8859-1", "iso8859-1")
ONE_BYTE_NAMES = CP1252_NAMES + LATIN1_NAMES
