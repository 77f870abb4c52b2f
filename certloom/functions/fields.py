"""Field scalars: quantities, serials, label blocks, IDs and certificate
numbers found in free text (F6-F11, F15-F17, F22, A3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .swl import REGISTER_CAPACITY
from .text import LINE_BREAKS, PY_WHITESPACE, col_, first_match, pystrip, split_newline, splitlines

# The F6, F8, F15, F16 and F22 patterns.
REGISTER_ID = r"(?U)(\(\w+\)\s*)?[A-Z]{3}\d+"
REPORT_REF = r"[A-Z]{3}/\d{6}/\d{5}"
REPORT_NUMBER_LABEL = r"(?i)Report\s*Number:"
CERTIFICATE_NO = r"Certificate No\. :\s*(\d+)"
ID_AFTER_PAREN = r"\)\s*([^\s]+)"
SERIAL_PREFIX = "SerialNo(s):"
LEADING_QUANTITY = r"^(?U:\s*)(\d+)(?U:\s+)\d*"


# ---------------------------------------------------------------- quantities
def extract_quantity(text) -> Column:
    """leading integer followed by whitespace (``4 RIDGEGEAR ...`` -> 4)."""
    return first_match(text, LEADING_QUANTITY, 1).try_cast("bigint")


def quantity_cell(cell) -> Column:
    """``int(float(x))``: truncate toward zero; unparsable or non-finite -> null."""
    d = pystrip(cell).try_cast("double")
    return F.when(~F.isnan(d), d.try_cast("bigint"))


# ---------------------------------------------------------------- serials
def serial_clean(cell) -> Column:
    """F8: drop all whitespace, split on commas, cut each piece at `` -`` (none
    left once whitespace is gone), drop a ``SerialNo(s):`` prefix, rejoin."""
    squeezed = F.regexp_replace(col_(cell), r"(?U)\s+", "")

    def clean(p):
        p = pystrip(p)
        p = F.when(p.rlike(r"(?s)(.+?)\s+-"), pystrip(F.regexp_extract(p, r"(?s)(.+?)\s+-", 1))).otherwise(p)
        p = F.replace(p, F.lit(" "), F.lit(""))
        return F.when(p.startswith(SERIAL_PREFIX), p.substr(F.lit(len(SERIAL_PREFIX) + 1), F.lit(1 << 30))) \
            .otherwise(p)

    return F.array_join(F.transform(F.split(squeezed, ","), clean), ",")


def serial_last_segment(cell) -> Column:
    """text after the last colon, stripped."""
    parts = F.split(col_(cell), ":")
    return pystrip(F.get(parts, F.size(parts) - 1))


def id_after_paren(text) -> Column:
    """first non-space run after a closing parenthesis."""
    return first_match(text, ID_AFTER_PAREN, 1)


# ---------------------------------------------------------------- label blocks
def label_entries_last(block) -> Column:
    """A3/F10/F11 (Sparrow rules): every line ``key: ... : value`` becomes
    ``(key lower-cased without spaces, last colon segment)``; a line without a
    colon is its own key and value."""
    def entry(line):
        parts = F.split(line, ":")
        key = pystrip(F.replace(F.lower(F.get(parts, 0)), F.lit(" "), F.lit("")))
        value = pystrip(F.get(parts, F.size(parts) - 1))
        return F.struct(key.alias("key"), value.alias("value"))
    return F.transform(split_newline(block), entry)


def label_entries_first(block) -> Column:
    """A3/F10/F11 (Centurion rules): ``splitlines``; only lines with a colon;
    key lower-cased without spaces, ``/`` and ``.``; value after the first colon."""
    lines = F.filter(splitlines(block), lambda l: l.contains(":"))

    def entry(line):
        parts = F.split(line, ":", 2)
        key = F.translate(F.lower(F.get(parts, 0)), " /.", "")
        return F.struct(key.alias("key"), pystrip(F.get(parts, 1)).alias("value"))
    return F.transform(lines, entry)


def label_lookup(entries, key: str) -> Column:
    """Value of ``key`` in a label block; the last duplicate wins; null if absent."""
    hits = F.filter(col_(entries), lambda e: e["key"] == F.lit(key))
    return F.try_element_at(hits, F.lit(-1))["value"]


def label_fields(entries, **keys: str) -> Column:
    """``label_lookup`` of several keys in one pass over the entries, as a struct."""
    empty = F.struct(*[F.lit(None).cast("string").alias(n) for n in keys])
    return F.aggregate(col_(entries), empty, lambda acc, e: F.struct(*[
        F.when(e["key"] == F.lit(k), e["value"]).otherwise(acc[n]).alias(n) for n, k in keys.items()]))


def _letters(key: str, between: str) -> str:
    """A lower-case key with any case of its letters (the Kelvin sign lower-cases to k)."""
    return between.join("[" + c + c.upper() + ("\\x{212a}" if c == "k" else "") + "]" for c in key)


def _ranges(codes: list[int]) -> str:
    """A character class of code points, neighbours as one range: each range is one test a character."""
    out: list[list[int]] = []
    for c in sorted(codes):
        if out and c == out[-1][1] + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join("\\x{%x}" % a + ("" if a == b else "-\\x{%x}" % b) for a, b in out)


def _label_pattern(key: str, rule: str) -> str:
    """Group 1 is the raw value of the last line whose key is ``key``: a greedy start tries the last line first."""
    if rule == "last":
        blank = "[" + _ranges([ord(c) for c in PY_WHITESPACE if c != "\n"]) + "]*"
        name = blank + _letters(key, " *") + blank
        return rf"(?s)^(?:.*\n)?(?:{name}:(?:[^\n]*:)?|(?={name}(?:\n|\z)))([^:\n]*)(?:\n|\z)"
    if rule == "first":
        line, skip = LINE_BREAKS, "[ /.]*"
        return rf"(?s)^(?:.*[{line}])?{skip}{_letters(key, skip)}{skip}:([^{line}]*)"
    raise ValueError(f"unknown label rule {rule!r}")


def label_value(block, key: str, rule: str) -> Column:
    """``label_lookup`` of one key straight from the block, with one anchored pattern instead of a list of entries:
    the rules of ``label_entries_last`` (``last``) or ``label_entries_first`` (``first``); null if absent."""
    return pystrip(first_match(block, _label_pattern(key, rule), 1))


def label_values(block, rule: str, **keys: str) -> Column:
    """Several :func:`label_value` as a struct."""
    return F.struct(*[label_value(block, k, rule).alias(n) for n, k in keys.items()])


def label_value_last(line) -> Column:
    """F11 (last): value = last colon segment."""
    parts = F.split(col_(line), ":")
    return pystrip(F.get(parts, F.size(parts) - 1))


def label_value_first(line) -> Column:
    """F11 (first): value after the first colon; null when there is no colon."""
    return F.when(col_(line).contains(":"), pystrip(F.get(F.split(col_(line), ":", 2), 1)))


# ---------------------------------------------------------------- searches
def id_search(text) -> Column:
    """register ID, optionally preceded by a parenthesised tag."""
    return first_match(text, REGISTER_ID)


def certificate_search(text, kind: str = "report_ref") -> Column:
    """F16: ``report_ref`` (``ABC/123456/12345``), ``report_number`` (cell with
    the ``Report Number:`` label removed) or ``certificate_no`` (digits after
    ``Certificate No. :``)."""
    t = col_(text)
    if kind == "report_ref":
        return first_match(t, REPORT_REF)
    if kind == "report_number":
        return F.when(t.rlike(REPORT_NUMBER_LABEL), pystrip(F.regexp_replace(t, REPORT_NUMBER_LABEL, "")))
    if kind == "certificate_no":
        return first_match(t, CERTIFICATE_NO, 1)
    raise ValueError(f"unknown certificate search {kind!r}")


def between_matches(text, compat: bool = False) -> Column:
    """the text between the register ID and the capacity token, with
    parenthesised parts removed (after stripping, so a trailing space can stay).
    Without a capacity the rules cut one character short (``compat=True``); the
    default keeps the text to its end."""
    t = col_(text)
    to_id = first_match(t, rf"(?s)^.*?(?:{REGISTER_ID})")  # the text up to the end of the first ID
    to_capacity = first_match(t, rf"(?s)^(.*?)(?:{REGISTER_CAPACITY})", 1)
    whole = t.substr(F.lit(1), F.length(t) - 1) if compat else t
    # past the end of the shorter text there is nothing: a capacity before or inside the ID gives an empty text
    raw = F.coalesce(to_capacity, whole).substr(F.length(to_id) + 1, F.length(t))
    return F.regexp_replace(pystrip(raw), r"\([^)]*\)(?U)\s*", "")
