"""Text scalars shared by every layout.

All functions are ``Column -> Column`` and stay inside whole-stage codegen.
Python string semantics are reproduced where the extraction rules depend on
them (``str.strip``/``str.split`` whitespace, ``splitlines``, ``' '.join``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() treats as whitespace
# (str.strip() and str.split() with no argument use exactly this set).
PY_WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_WS_CLASS = "[" + "".join("\\x{%x}" % ord(ch) for ch in PY_WHITESPACE) + "]"
# The line boundaries of Python's str.splitlines().
LINE_BREAKS = "\\n\\r\\x{b}\\x{c}\\x{1c}\\x{1d}\\x{1e}\\x{85}\\x{2028}\\x{2029}"
_SPLITLINES = "\\r\\n|[" + LINE_BREAKS + "]"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pystrip(c) -> Column:
    """``str.strip()``: remove leading/trailing whitespace of any kind."""
    return F.btrim(col_(c), F.lit(PY_WHITESPACE))


def pysplit(c) -> Column:
    """``str.split()`` with no separator: whitespace runs, no empty tokens."""
    return F.filter(F.split(col_(c), _WS_CLASS + "+"), lambda t: t != F.lit(""))


def splitlines(c) -> Column:
    """``str.splitlines()``: all Unicode line boundaries; no trailing empty line."""
    parts = F.split(col_(c), _SPLITLINES)
    return F.when(F.size(parts) == 0, parts).when(
        F.get(parts, F.size(parts) - 1) == F.lit(""), F.slice(parts, 1, F.size(parts) - 1)
    ).otherwise(parts)


def split_newline(c) -> Column:
    """``str.split('\\n')``: only the newline character, empty pieces kept."""
    return F.split(col_(c), "\n")


def is_blank(c) -> Column:
    """Page text that is empty or whitespace only (null counts as blank)."""
    return F.coalesce(pystrip(c) == F.lit(""), F.lit(True))


def row_text(row) -> Column:
    """P10: ``' '.join(cell if cell is not None else '' ...)``; nulls keep their slot."""
    return F.array_join(col_(row), " ", "")


def row_text_nonnull(row) -> Column:
    """``' '.join(cell for cell in row if cell is not None)``."""
    return F.array_join(col_(row), " ")


def cell_line(cell, k: int) -> Column:
    """``cell.split('\\n')[k].strip()``; null when the line does not exist."""
    return pystrip(F.get(split_newline(cell), F.lit(k)))


def description_head(c) -> Column:
    """newline to space, then the text before the first colon."""
    return F.substring_index(F.replace(col_(c), F.lit("\n"), F.lit(" ")), ":", 1)


def newline_to_space(c) -> Column:
    return F.replace(col_(c), F.lit("\n"), F.lit(" "))


def strip_label(c, label: str) -> Column:
    """remove a literal label everywhere, then strip."""
    return pystrip(F.replace(col_(c), F.lit(label), F.lit("")))


def provider_prefix(c, prefix: str = "LOFT-") -> Column:
    """provider identification = fixed prefix + job number."""
    return F.concat(F.lit(prefix), col_(c))


def truthy(c) -> Column:
    """Python truthiness of an optional string: not None and not ''."""
    c = col_(c)
    return c.isNotNull() & (c != F.lit(""))


def nullif_empty(c) -> Column:
    c = col_(c)
    return F.when(c != F.lit(""), c)


def search(c, pattern: str, group: int = 0) -> Column:
    """``re.search(pattern, c).group(g)`` or null when nothing matches."""
    c = col_(c)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def first_match(c, pattern: str, group: int = 0) -> Column:
    """:func:`search` for a pattern that is matched once a row: null when nothing matches, the group's text, empty
    or not, when it does."""
    return F.get(F.regexp_extract_all(col_(c), F.lit(pattern), F.lit(group)), 0)
