"""Native column expressions for text fields.

Everything here returns a ``Column`` built from Spark's own expressions, so
it runs inside whole-stage code generation on the executors; no Python
worker is involved.

Parity notes for text produced by a Python-regex parser:

* ``regexp_extract`` returns ``''`` when nothing matches, a Python search
  returns ``None``; :func:`field` returns null on no match.
* Python's ``\\s``/``\\d`` and ``str.strip`` are Unicode-aware, Java's are
  ASCII unless ``(?U)`` is set; all patterns here carry ``(?U)``.
* Python's ``.`` stops only at ``\\n``; Java's also at ``\\r`` unless
  ``(?d)`` (UNIX_LINES) is set.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Python's str.strip() removes: fixed values.
_STRIP = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B)))
          + "\u2028\u2029\u202f\u205f\u3000")

# Every decimal digit of Unicode, as ``\\d`` matches it, and the ASCII digit it stands for.
_DIGITS = [c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"]
_ASCII_DIGITS = "".join(str(unicodedata.decimal(c)) for c in _DIGITS)


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ustrip(c: str | Column) -> Column:
    """Remove leading and trailing Unicode whitespace (``str.strip``)."""
    return F.btrim(col_of(c), F.lit(_STRIP))


def field(text: str | Column, pattern: str, group: int = 1, *, group_never_empty: bool = False) -> Column:
    """First match of ``pattern`` in ``text`` (group ``group``); null when no match.

    When the group cannot match the empty string (one or more digits, say), an empty
    extract already means "no match" and the text is scanned once instead of
    twice.
    """
    t = col_of(text)
    if group_never_empty:
        return F.nullif(F.regexp_extract(t, pattern, group), F.lit(""))
    return F.when(t.rlike(pattern), F.regexp_extract(t, pattern, group))


def int_field(text: str | Column, pattern: str, group: int = 1) -> Column:
    """Integer captured by ``pattern`` (a group of one or more digits, of any
    script); null when absent or not a number."""
    found = field(text, pattern, group, group_never_empty=True)
    return F.translate(found, "".join(_DIGITS), _ASCII_DIGITS).try_cast("int")


def non_empty(c: str | Column) -> Column:
    """True when the value has at least one character before any newline.

    Same rule as ``bool(re.match('.+', value))``; null values give null, so a
    ``filter`` drops them.
    """
    return col_of(c).rlike(r"(?d)^.+")


def list_to_text(c: str | Column, sep: str = ", ") -> Column:
    """Array of strings -> one delimited string without brackets or quotes."""
    return F.translate(F.array_join(col_of(c), sep), '[]"', "")


def leading_year(c: str | Column) -> Column:
    """Integer from the first four characters, null when they are no number."""
    return F.substring(col_of(c), 1, 4).try_cast("int")


def contains_ci(c: str | Column, phrase: str) -> Column:
    """Case-insensitive substring test."""
    return F.lower(col_of(c)).contains(phrase.lower())


def basename(c: str | Column) -> Column:
    """Last path segment of a key or URL path (query and fragment removed)."""
    return F.regexp_extract(F.regexp_replace(col_of(c), r"[?#].*$", ""), r"([^/]*)$", 1)
