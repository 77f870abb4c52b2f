"""Capacity (safe working load) parsing: F1-F5.

A capacity text such as ``2.5te @ 90`` is split into value / unit / note.
Each client layout has its own *profile*: the regex (unit glued to the number
or not), a unit alias map and the list of accepted units.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_, first_match, nullif_empty

# Accepted capacity units, in the order the extraction rules list them.
BASE_UNITS = (
    "kg", "g", "lb", "ton", "t", "m", "cm", "mm", "ft", "in", "m²", "cm²", "mm²", "ft²", "in²", "m³", "cm³", "mm³",
    "ft³", "in³", "km/h", "mph", "m/s", "kph", "°C", "°F", "°K", "bar", "atm", "Pa", "kPa", "psi", "N", "J",
    "W", "A", "V", "F", "Ω", "S", "H", "Hz", "C", "Bq", "Gy", "Sv", "cd", "lm", "lx", "B", "mol", "unit", "te",
)
# Extra units accepted by the local Centurion rules.
CENTURION_EXTRA_UNITS = ("KG", "T", "TE", "G", "TH /FITTING")
# Extra units accepted by the First Integrated rules.
FIRST_INTEGRATED_EXTRA_UNITS = ("TONNE", "TONNES", "Kilos", "Tonnes")
# Unit aliases.
SPARROW_ALIASES = {"kgs": "kg"}
FIRST_INTEGRATED_ALIASES = {"TONNE": "te", "TONNES": "te", "Tonnes": "te", "Kilos": "kg"}

# The three patterns of a capacity text.  (?d): '.' and '$' know only '\n' as a line end, like Python's re.
TIGHT_PATTERN = r"(?d)^(\d+(?:\.\d+)?)([a-zA-Z]+)?\s*(.*)$"
LOOSE_PATTERN = r"(?d)^(\d+(?:\.\d+)?)\s*([a-zA-Z]+)?\s*(.*)$"

_MARK = "\u0001"  # never part of the number or the unit

# F5 capacity searches (group 0 unless stated).
REGISTER_CAPACITY = r"(?i)(\d+\.\d+)\s+(Tonnes|Kilos)\s"
TONNE_CAPACITY = r"(?i)(\d+(?:\.\d+)?)\s*(TONNE|TONNES)\b"
HENDRIK_CAPACITY = r"(\d+(\.\d+)?\s*t)"


@dataclass(frozen=True)
class SwlProfile:
    name: str
    pattern: str
    aliases: dict
    units: tuple


SPARROW = SwlProfile("sparrow", TIGHT_PATTERN, SPARROW_ALIASES, BASE_UNITS)
CENTURION_DEPLOYED = SwlProfile("centurion_deployed", TIGHT_PATTERN, SPARROW_ALIASES, BASE_UNITS)
CENTURION_LOCAL = SwlProfile("centurion_local", TIGHT_PATTERN, SPARROW_ALIASES, BASE_UNITS + CENTURION_EXTRA_UNITS)
FIRST_INTEGRATED = SwlProfile("first_integrated", LOOSE_PATTERN, FIRST_INTEGRATED_ALIASES,
                              BASE_UNITS + FIRST_INTEGRATED_EXTRA_UNITS)
PROFILES = {p.name: p for p in (SPARROW, CENTURION_DEPLOYED, CENTURION_LOCAL, FIRST_INTEGRATED)}


def _profile(profile) -> SwlProfile:
    return PROFILES[profile] if isinstance(profile, str) else profile


def unit_alias(unit, profile=SPARROW) -> Column:
    """map an alias to its canonical unit (case-sensitive)."""
    u = col_(unit)
    expr = None
    for alias, canon in _profile(profile).aliases.items():
        expr = (F.when(u == F.lit(alias), F.lit(canon)) if expr is None
                else expr.when(u == F.lit(alias), F.lit(canon)))
    return u if expr is None else expr.otherwise(u)


def is_unit(unit, profile=SPARROW) -> Column:
    """Membership in the profile's unit list (a semi-join to a literal set)."""
    return col_(unit).isin(list(_profile(profile).units))


def parse_swl(swl, profile=SPARROW) -> Column:
    """F1/F2 + F3 + F4: ``struct<value, unit, note>``.

    No match: value and unit null, note = whole text.  A unit that is not in
    the list moves to the front of the note.  A null input gives a null struct.
    """
    p = _profile(profile)
    s = col_(swl)
    # one replacement puts the three groups side by side; they are bound once as a lambda variable
    whole = p.pattern[:-1] + r"\n?\z"
    parts = F.split(F.regexp_replace(s, whole, f"$1{_MARK}$2{_MARK}$3"), _MARK, 3)

    def read(g):
        unit = g["unit"]
        known = is_unit(unit, p)
        note = F.when(unit.isNotNull() & ~known,
                      F.when(g["note"] != F.lit(""), F.concat(unit, F.lit(" "), g["note"])).otherwise(unit)
                      ).otherwise(g["note"])
        return F.struct(g["value"].alias("value"), F.when(known, unit).alias("unit"), note.alias("note"))

    matched = s.rlike(p.pattern)
    groups = F.transform(F.array(F.when(matched, parts)), lambda g: F.struct(
        F.get(g, 0).alias("value"), unit_alias(nullif_empty(F.get(g, 1)), p).alias("unit"),
        F.coalesce(F.get(g, 2), s).alias("note")))
    return F.when(s.isNotNull(), F.get(F.transform(groups, read), 0))


def capacity_search(text, kind: str = "register") -> Column:
    """find a capacity token in free text; null when absent."""
    t = col_(text)
    if kind == "register":
        return first_match(t, REGISTER_CAPACITY)
    if kind == "tonne":
        return first_match(t, TONNE_CAPACITY)
    if kind == "hendrik":
        return first_match(t, HENDRIK_CAPACITY, 1)
    raise ValueError(f"unknown capacity search {kind!r}")
