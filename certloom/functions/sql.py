"""The scalars as Spark SQL temporary functions (SQL UDFs, no Python at run time).

    register_sql_functions(spark)
    spark.sql("SELECT swl_value(t), swl_unit(t), swl_note(t), date_plus_180(d) FROM ...")

Each body is a plain SQL expression built from the same patterns and unit lists
as the Column functions, so Catalyst inlines it like any built-in expression.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import dates, fields, swl


def _q(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _units(profile) -> str:
    return "(" + ", ".join(_q(u) for u in profile.units) + ")"


def _alias(x: str, profile) -> str:
    cases = " ".join(f"WHEN {_q(a)} THEN {_q(b)}" for a, b in profile.aliases.items())
    return f"CASE {x} {cases} ELSE {x} END" if cases else x


def sql_functions(profile=swl.SPARROW, suffix: str = "") -> dict[str, str]:
    """name -> CREATE statement."""
    P = _q(profile.pattern)
    unit0 = f"nullif(regexp_extract(s, {P}, 2), '')"
    unit1 = _alias(unit0, profile)
    note0 = f"CASE WHEN s RLIKE {P} THEN regexp_extract(s, {P}, 3) ELSE s END"
    u = _units(profile)
    defs = {
        f"swl_value{suffix}": f"CASE WHEN s RLIKE {P} THEN regexp_extract(s, {P}, 1) END",
        f"swl_unit{suffix}": f"CASE WHEN s RLIKE {P} AND ({unit1}) IN {u} THEN {unit1} END",
        f"swl_note{suffix}": (f"CASE WHEN s RLIKE {P} AND ({unit1}) IS NOT NULL AND ({unit1}) NOT IN {u} THEN "
                              f"CASE WHEN ({note0}) <> '' THEN concat({unit1}, ' ', {note0}) ELSE {unit1} END "
                              f"ELSE {note0} END"),
        "date_plus_180": (f"date_format(date_add(try_to_date(s, {_q(dates.DMY_IN)}), 180), "
                          f"{_q(dates.DMY_OUT)})"),
        "date_normalise": f"date_format(try_to_date(s, {_q(dates.DMY_IN)}), {_q(dates.DMY_OUT)})",
        "description_head": "substring_index(replace(s, '\\n', ' '), ':', 1)",
        "extract_quantity": f"try_cast(nullif(regexp_extract(s, {_q(fields.LEADING_QUANTITY)}, 1), '') AS BIGINT)",
        "id_search": f"nullif(regexp_extract(s, {_q(fields.REGISTER_ID)}, 0), '')",
        "report_ref": f"nullif(regexp_extract(s, {_q(fields.REPORT_REF)}, 0), '')",
    }
    return {name: (f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS "
                   f"{'BIGINT' if name == 'extract_quantity' else 'STRING'} RETURN {body}")
            for name, body in defs.items()}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Register the functions for the tight (``swl_*``) and loose
    (``swl_*_loose``) capacity rules plus the date/text helpers."""
    stmts = {**sql_functions(swl.SPARROW), **sql_functions(swl.FIRST_INTEGRATED, "_loose")}
    for stmt in stmts.values():
        spark.sql(stmt)
    return list(stmts)
