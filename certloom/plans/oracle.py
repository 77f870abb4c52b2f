"""DuckDB SQL for every registered query that SQL can express.

Written independently of the Spark code, in plain DuckDB SQL over the same
parquet tables.  Patterns and unit lists are written out here, so that a slip
in the code's own constants shows; only the message texts, the whitespace set
and the test dictionary are shared.
"""

from __future__ import annotations

from types import SimpleNamespace

from ..functions.text import PY_WHITESPACE
from . import carriers as cr
from . import messages as C

SQL: dict[str, str] = {}

# The rules' patterns and unit lists.
_UNITS = ("kg g lb ton t m cm mm ft in m² cm² mm² ft² in² m³ cm³ mm³ ft³ in³ km/h mph m/s kph °C °F °K bar atm Pa kPa "
          "psi N J W A V F Ω S H Hz C Bq Gy Sv cd lm lx B mol unit te").split()
_TIGHT = r"^(\d+(?:\.\d+)?)([a-zA-Z]+)?\s*(.*)$"
_LOOSE = r"^(\d+(?:\.\d+)?)\s*([a-zA-Z]+)?\s*(.*)$"
_KGS = {"kgs": "kg"}
swl = SimpleNamespace(
    LOOSE_PATTERN=_LOOSE,
    SPARROW=SimpleNamespace(pattern=_TIGHT, aliases=_KGS, units=_UNITS),
    CENTURION_DEPLOYED=SimpleNamespace(pattern=_TIGHT, aliases=_KGS, units=_UNITS),
    CENTURION_LOCAL=SimpleNamespace(pattern=_TIGHT, aliases=_KGS, units=[*_UNITS, "KG", "T", "TE", "G", "TH /FITTING"]),
    FIRST_INTEGRATED=SimpleNamespace(
        pattern=_LOOSE, aliases={"TONNE": "te", "TONNES": "te", "Tonnes": "te", "Kilos": "kg"},
        units=[*_UNITS, "TONNE", "TONNES", "Kilos", "Tonnes"]),
    REGISTER_CAPACITY=r"(?i)(\d+\.\d+)\s+(Tonnes|Kilos)\s",
    TONNE_CAPACITY=r"(?i)(\d+(?:\.\d+)?)\s*(TONNE|TONNES)\b",
    HENDRIK_CAPACITY=r"(\d+(\.\d+)?\s*t)")
fields = SimpleNamespace(
    REGISTER_ID=r"(\(\w+\)\s*)?[A-Z]{3}\d+", REPORT_REF=r"[A-Z]{3}/\d{6}/\d{5}",
    REPORT_NUMBER_LABEL=r"(?i)Report\s*Number:", CERTIFICATE_NO=r"Certificate No\. :\s*(\d+)",
    ID_AFTER_PAREN=r"\)\s*([^\s]+)", SERIAL_PREFIX="SerialNo(s):", LEADING_QUANTITY=r"^\s*(\d+)\s+\d*")
DASHED_DATE, ANY_DATE, ROW_END_DATE = (
    r"(\d{2}-\d{2}-\d{4})", r"\b(\d{2}/\d{2}/\d{4})\b", r"(\d{2}/\d{2}/\d{4})$")

# The derived certificate view (portable SQL; equal in Spark and DuckDB).
FX = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS INT) AS qty,
  concat(CAST(CAST(l_quantity AS INT) AS VARCHAR),
    CASE l_linenumber WHEN 1 THEN 'kgs' WHEN 2 THEN '.5te @ 90' WHEN 3 THEN CASE WHEN CAST(l_quantity AS INT) % 2 = 1 THEN 'KG' ELSE ' kg' END WHEN 4 THEN 'XX note'
      WHEN 5 THEN '' WHEN 6 THEN ' Tonnes ' ELSE 'KG' END) AS swl_text,
  CASE l_linenumber % 5
    WHEN 0 THEN concat('D', CAST(l_suppkey AS VARCHAR), '-1 to ', CAST(CAST(l_quantity AS INT) AS VARCHAR))
    WHEN 1 THEN concat('MGL', CAST(l_partkey AS VARCHAR), ' to MGL', CAST(l_partkey + 5 AS VARCHAR))
    WHEN 2 THEN concat('AB', CAST(l_suppkey AS VARCHAR), ' x3, CD', CAST(l_partkey AS VARCHAR), ' x2')
    WHEN 3 THEN concat('A', CAST(l_partkey AS VARCHAR), ',B', CAST(l_suppkey AS VARCHAR))
    ELSE concat('S', CAST(l_orderkey AS VARCHAR)) END AS id_text,
  CASE l_linenumber % 4
    WHEN 0 THEN concat('TZW', CAST(l_suppkey AS VARCHAR), '-', CAST(l_suppkey + 6 AS VARCHAR))
    WHEN 1 THEN concat('TZW', CAST(l_suppkey + 9 AS VARCHAR), '-', CAST(l_suppkey AS VARCHAR))
    WHEN 2 THEN concat('TZW', CAST(l_suppkey AS VARCHAR), '/01-0', CAST(l_linenumber AS VARCHAR))
    ELSE concat('ZZ-', CAST(l_suppkey AS VARCHAR)) END AS range_text,
  concat('Report Number: R', CAST(l_orderkey AS VARCHAR), chr(10),
    'Date of Thorough Examination : ', lpad(CAST(day(l_shipdate) AS VARCHAR), 2, '0'), '/',
    lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0'), '/', CAST(year(l_shipdate) AS VARCHAR), chr(10),
    'Job Number: ', CAST(l_suppkey AS VARCHAR), ':', CAST(l_linenumber AS VARCHAR)) AS header_block,
  concat(lpad(CAST(day(l_shipdate) AS VARCHAR), 2, '0'), '/', lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0'), '/',
    CAST(year(l_shipdate) AS VARCHAR)) AS date_text
FROM lineitem
"""
K = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
WS = " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def pat(p: str) -> str:
    return q(p)


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def with_fx(body: str) -> str:
    return f"WITH fx AS ({FX})\n{body}"


def swl_cols(src: str, profile, prefix: str = "") -> str:
    """Select-list fragment: {prefix}swl_value / swl_unit / swl_note (uses
    DuckDB's lateral column aliases)."""
    P = pat(profile.pattern)
    units = in_list(profile.units)
    alias = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in profile.aliases.items())
    p = prefix
    return f"""
      CASE WHEN regexp_matches({src}, {P}) THEN regexp_extract({src}, {P}, 1) END AS {p}swl_value,
      CASE WHEN regexp_matches({src}, {P}) THEN nullif(regexp_extract({src}, {P}, 2), '') END AS {p}_u0,
      CASE WHEN regexp_matches({src}, {P}) THEN regexp_extract({src}, {P}, 3) ELSE {src} END AS {p}_n0,
      CASE {p}_u0 {alias} ELSE {p}_u0 END AS {p}_u1,
      CASE WHEN {p}_u1 IN {units} THEN {p}_u1 END AS {p}swl_unit,
      CASE WHEN {p}_u1 IS NOT NULL AND {p}_u1 NOT IN {units}
           THEN CASE WHEN {p}_n0 <> '' THEN {p}_u1 || ' ' || {p}_n0 ELSE {p}_u1 END ELSE {p}_n0 END AS {p}swl_note"""


def nz(x: str) -> str:
    return f"nullif({x}, '')"


# ======================================================================== F: scalars
SQL["swl_parse_tight"] = with_fx(f"""
SELECT {K}, swl_text, swl_value, swl_unit, swl_note FROM (SELECT *, {swl_cols('swl_text', swl.SPARROW)} FROM fx)""")

SQL["swl_parse_loose"] = with_fx(f"""
SELECT {K}, swl_text, swl_value, swl_unit, swl_note FROM (
  SELECT *, {swl_cols('swl_text', swl.FIRST_INTEGRATED)} FROM fx)""")


def _alias_case(x, profile):
    return "CASE " + x + " " + " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in profile.aliases.items()) + \
        f" ELSE {x} END"


SQL["unit_alias"] = with_fx(f"""
SELECT {K}, raw_unit, {_alias_case('raw_unit', swl.FIRST_INTEGRATED)} AS unit,
       {_alias_case('raw_unit', swl.SPARROW)} AS unit_sparrow
FROM (SELECT *, {nz(f"regexp_extract(swl_text, {pat(swl.LOOSE_PATTERN)}, 2)")} AS raw_unit FROM fx)""")

SQL["unit_semi"] = with_fx(f"""
SELECT unit, count(*) AS n_rows FROM (
  SELECT {_alias_case(nz(f"regexp_extract(swl_text, {pat(swl.LOOSE_PATTERN)}, 2)"), swl.FIRST_INTEGRATED)} AS unit
  FROM fx) WHERE unit IN {in_list(swl.FIRST_INTEGRATED.units)} GROUP BY unit""")

CAP_TEXT = ("CAST(qty AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR) || ' ' || CASE WHEN l_linenumber % 3 = 0 "
            "THEN 'Tonnes' WHEN l_linenumber % 3 = 1 THEN 'kilos' ELSE 'TONNE' END || ' x ' || swl_text")
SQL["capacity_search"] = with_fx(f"""
SELECT {K}, cap_text, {nz(f"regexp_extract(cap_text, {pat(swl.REGISTER_CAPACITY)}, 0)")} AS cap_register,
  {nz(f"regexp_extract(cap_text, {pat(swl.TONNE_CAPACITY)}, 0)")} AS cap_tonne,
  {nz(f"regexp_extract(cap_text, {pat(swl.HENDRIK_CAPACITY)}, 1)")} AS cap_hendrik
FROM (SELECT *, {CAP_TEXT} AS cap_text FROM fx)""")

SQL["extract_quantity"] = with_fx(f"""
SELECT {K}, qty_text, TRY_CAST({nz(f"regexp_extract(qty_text, {pat(fields.LEADING_QUANTITY)}, 1)")} AS BIGINT)
  AS quantity
FROM (SELECT *, CASE WHEN l_linenumber % 3 = 0 THEN ' ' ELSE '' END || CAST(qty AS VARCHAR) ||
        CASE WHEN l_linenumber % 2 = 0 THEN ' RIDGEGEAR RGL28' ELSE 'X 4' END AS qty_text FROM fx)""")

SQL["quantity_cell"] = with_fx(f"""
SELECT {K}, cell, CAST(trunc(TRY_CAST({strip('cell')} AS DOUBLE)) AS BIGINT) AS quantity
FROM (SELECT *, CASE WHEN l_linenumber % 3 = 0 THEN CAST(qty AS VARCHAR) || '.9' WHEN l_linenumber % 3 = 1
        THEN 'abc' ELSE ' ' || CAST(qty AS VARCHAR) END AS cell FROM fx)""")

SQL["serial_clean"] = with_fx(f"""
SELECT {K}, array_to_string(list_transform(string_split(regexp_replace('Serial No(s): ' || id_text, '\\s+', '', 'g'),
  ','), lambda p: CASE WHEN starts_with(p, {q(fields.SERIAL_PREFIX)}) THEN substr(p, {len(fields.SERIAL_PREFIX) + 1})
  ELSE p END), ',') AS serials FROM fx""")

_LAST_SEG = strip("string_split(header_block, ':')[-1]")
SQL["serial_last_segment"] = with_fx(f"SELECT {K}, {_LAST_SEG} AS serial FROM fx")

LINES = with_fx(f"""
, lines AS (SELECT {K}, unnest(string_split(header_block, chr(10))) AS line,
     unnest(range(len(string_split(header_block, chr(10))))) AS line_no FROM fx)
""")
SQL["explode_lines"] = LINES + f"SELECT {K}, line_no, line FROM lines"
_V_LAST = strip("string_split(line, ':')[-1]")
_V_FIRST = strip("substr(line, strpos(line, ':') + 1)")
SQL["label_value_last"] = LINES + f"SELECT {K}, line_no, {_V_LAST} AS value FROM lines"
SQL["label_value_first"] = LINES + f"SELECT {K}, line_no, CASE WHEN contains(line, ':') THEN {_V_FIRST} END AS value FROM lines"


def _entries_last(block):
    key = strip("replace(lower(string_split(l, ':')[1]), ' ', '')")
    val = strip("string_split(l, ':')[-1]")
    return f"list_transform(string_split({block}, chr(10)), lambda l: {{'k': {key}, 'v': {val}}})"


def _entries_first(block):
    key = "replace(replace(replace(lower(string_split(l, ':')[1]), ' ', ''), '/', ''), '.', '')"
    return (f"list_transform(list_filter(string_split({block}, chr(10)), lambda l: contains(l, ':')), lambda l: "
            f"{{'k': {key}, 'v': {strip('substr(l, strpos(l, chr(58)) + 1)')}}})")


def _lookup(entries, key):
    return f"list_filter({entries}, lambda z: z.k = {q(key)})[-1].v"


SQL["label_map"] = with_fx(f"""
SELECT {K}, {_lookup('e', 'reportnumber')} AS report_number, {_lookup('e', 'dateofthoroughexamination')} AS examined,
  {_lookup('e', 'jobnumber')} AS job_number, {_lookup('e2', 'jobnumber')} AS job_number_first,
  {_lookup('e', 'duedateofnextthoroughexamination')} AS next_due
FROM (SELECT *, {_entries_last('header_block')} AS e, {_entries_first('header_block')} AS e2 FROM fx)""")

SQL["provider_prefix"] = with_fx(f"""
SELECT {K}, 'LOFT-' || {_lookup('e', 'jobnumber')} AS provider
FROM (SELECT *, {_entries_last('header_block')} AS e FROM fx)""")

SQL["cell_line"] = with_fx(f"SELECT {K}, " + ", ".join(
    f"{strip(f'string_split(header_block, chr(10))[{k + 1}]')} AS line{k}" for k in range(4)) + " FROM fx")

SQL["date_plus_180"] = with_fx(f"""
SELECT {K}, date_text, strftime(try_strptime(date_text, '%d/%m/%Y') + INTERVAL 180 DAY, '%d/%m/%Y') AS next_due
FROM fx""")

SQL["date_normalise"] = """
SELECT o_orderkey, date_raw, strftime(try_strptime(date_raw, '%d/%m/%Y'), '%d/%m/%Y') AS date_out FROM (
  SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0
    THEN '3' || CAST(day(o_orderdate) % 4 AS VARCHAR) || '/02/' || CAST(year(o_orderdate) AS VARCHAR)
    ELSE CAST(day(o_orderdate) AS VARCHAR) || '/' || CAST(month(o_orderdate) AS VARCHAR) || '/' ||
         CAST(year(o_orderdate) AS VARCHAR) END AS date_raw
  FROM orders)"""

SQL["date_search"] = with_fx(f"""
SELECT {K}, {nz("regexp_extract(a, '\\b(\\d{2}/\\d{2}/\\d{4})\\b', 0)")} AS d_anywhere,
  {nz("regexp_extract(a, '(\\d{2}/\\d{2}/\\d{4})$', 1)")} AS d_row_end_none,
  {nz("regexp_extract(b, '(\\d{2}/\\d{2}/\\d{4})$', 1)")} AS d_row_end,
  replace({nz("regexp_extract(c, '(\\d{2}-\\d{2}-\\d{4})', 1)")}, '-', '/') AS d_dashed
FROM (SELECT *, 'Checked ' || date_text || ' ok' AS a, 'Due ' || date_text AS b,
        'Date ' || replace(date_text, '/', '-') || ' x' AS c FROM fx)""")

SQL["strip_label"] = with_fx(f"""
SELECT {K}, {strip("replace('Date of Thorough Examination: ' || date_text || ' ' || chr(10), "
                   "'Date of Thorough Examination:', '')")} AS value FROM fx""")

SQL["description_head"] = """
SELECT p_partkey, string_split(replace(p_name || CASE WHEN p_size % 2 = 0 THEN ': ' || p_brand ELSE '' END ||
  chr(10) || p_type, chr(10), ' '), ':')[1] AS head FROM part"""

BETWEEN_TEXT = ("CASE WHEN l_linenumber % 2 = 0 THEN '(AB) ' ELSE '' END || 'TZW' || CAST(l_suppkey AS VARCHAR) || "
                "' Shackle (blue) ' || CASE WHEN l_linenumber % 3 = 0 THEN CAST(qty AS VARCHAR) || '.5 Tonnes ' "
                "ELSE '' END || 'end'")


def _between(compat):
    end_no_cap = "length(t) - 1" if compat else "length(t)"
    return f"""CASE WHEN m_id <> '' THEN regexp_replace({strip(
        f"CASE WHEN (CASE WHEN m_cap <> '' THEN strpos(t, m_cap) - 1 ELSE {end_no_cap} END) > id_end THEN "
        f"substr(t, id_end + 1, (CASE WHEN m_cap <> '' THEN strpos(t, m_cap) - 1 ELSE {end_no_cap} END) - id_end) "
        f"ELSE '' END")}, '\\([^)]*\\)\\s*', '', 'g') END"""


SQL["between_matches"] = with_fx(f"""
SELECT {K}, {_between(False)} AS description, {_between(True)} AS description_compat FROM (
  SELECT *, strpos(t, m_id) - 1 + length(m_id) AS id_end FROM (
    SELECT *, regexp_extract(t, {pat(fields.REGISTER_ID)}, 0) AS m_id,
           regexp_extract(t, {pat(swl.REGISTER_CAPACITY)}, 0) AS m_cap
    FROM (SELECT *, {BETWEEN_TEXT} AS t FROM fx)))""")

SQL["id_search"] = with_fx(f"""
SELECT {K}, {nz(f"regexp_extract(t, {pat(fields.REGISTER_ID)}, 0)")} AS id_number FROM (
  SELECT *, 'Row ' || CASE WHEN l_linenumber % 2 = 0 THEN '(X1) ' ELSE '' END ||
    CASE WHEN l_linenumber % 3 = 0 THEN 'tz' ELSE 'TZW' END || CAST(l_suppkey AS VARCHAR) || ' end' AS t FROM fx)""")

SQL["certificate_search"] = with_fx(f"""
SELECT {K}, {nz(f"regexp_extract(a, {pat(fields.REPORT_REF)}, 0)")} AS report_ref,
  CASE WHEN regexp_matches(b, {pat(fields.REPORT_NUMBER_LABEL)})
       THEN {strip(f"regexp_replace(b, {pat(fields.REPORT_NUMBER_LABEL)}, '', 'g')")} END AS report_number,
  {nz(f"regexp_extract(c, {pat(fields.CERTIFICATE_NO)}, 1)")} AS certificate_no
FROM (SELECT *, 'Report Ref No ABC/' || lpad(CAST(l_orderkey AS VARCHAR), 6, '0') || '/' ||
        lpad(CAST(l_partkey AS VARCHAR), 5, '0') AS a,
      'Report  number: R' || CAST(l_orderkey AS VARCHAR) || ' ' AS b,
      'Hendrik Certificate No. : ' || CAST(l_suppkey AS VARCHAR) || ' more' AS c FROM fx)""")

SQL["id_after_paren"] = with_fx(f"""
SELECT {K}, {nz(f"regexp_extract('Id (' || CAST(l_linenumber AS VARCHAR) || ') HK-' || CAST(l_orderkey AS VARCHAR) "
                f"|| ' more', {pat(fields.ID_AFTER_PAREN)}, 1)")} AS id_number FROM fx""")


# ======================================================================== G: generators
def g1_cols(s: str) -> str:
    """Prefix / base / suffix of the quantity numbering rule for string ``s``."""
    digits = f"regexp_replace({s}, '[^0-9]', '', 'g')"
    first_digit = f"regexp_matches(substr({s}, 1, 1), '^[0-9]$')"
    return (f"CASE WHEN {first_digit} THEN '' ELSE substr({s}, 1, length({s}) - length({digits})) END AS g_prefix, "
            f"TRY_CAST({digits} AS HUGEINT) AS g_base, "
            f"CASE WHEN {first_digit} THEN substr({s}, length({digits}) + 1) ELSE '' END AS g_suffix")


SQL["id_parts"] = with_fx(f"""
, a AS (SELECT {K}, l_linenumber % 4 AS q, CASE WHEN l_linenumber % 2 = 0 THEN 'MGL' || CAST(l_partkey AS VARCHAR)
          ELSE CAST(l_suppkey AS VARCHAR) || 'B' END AS s FROM fx),
b AS (SELECT *, {g1_cols('s')} FROM a WHERE length(s) > 0),
c AS (SELECT *, unnest(range(q)) AS i FROM b WHERE g_base IS NOT NULL AND q > 0)
SELECT {K}, g_prefix || CAST(g_base + i AS VARCHAR) || g_suffix AS id_number, i AS id_idx FROM c""")

SQL["id_to_range"] = with_fx(f"""
, a AS (SELECT {K}, l_linenumber AS q, {strip("string_split(id_text, 'to')[1]")} AS first FROM fx),
b AS (SELECT *, contains(first, '-') AS dashed, string_split(first, '-') AS parts FROM a),
c AS (SELECT *, CASE WHEN dashed THEN parts[2] ELSE first END AS s,
        CASE WHEN dashed THEN parts[1] || '-' ELSE '' END AS pre FROM b WHERE NOT dashed OR len(parts) = 2),
d AS (SELECT *, {g1_cols('s')} FROM c WHERE length(s) > 0),
e AS (SELECT *, unnest(range(q)) AS i FROM d WHERE g_base IS NOT NULL AND q > 0)
SELECT {K}, pre || g_prefix || CAST(g_base + i AS VARCHAR) || g_suffix AS id_number, i AS id_idx FROM e""")

SQL["id_multiplier"] = with_fx(f"""
, a AS (SELECT {K}, string_split(id_text, ',') AS pieces FROM fx),
ok AS (SELECT * FROM a WHERE len(list_filter(pieces, lambda p: len(string_split(p, 'x')) < 2 OR
         regexp_replace(string_split(p, 'x')[2], '[^0-9]', '', 'g') = '')) = 0),
p AS (SELECT {K}, unnest(pieces) AS piece, unnest(range(len(pieces))) AS k FROM ok),
p2 AS (SELECT *, {strip("string_split(piece, 'x')[1]")} AS ident0,
         CAST(regexp_replace(string_split(piece, 'x')[2], '[^0-9]', '', 'g') AS BIGINT) AS n FROM p),
p3 AS (SELECT *, CASE WHEN regexp_matches(ident0, '[0-9]') THEN regexp_extract(ident0, '(?s)^(.*[0-9])', 1)
         ELSE ident0 END AS ident,
         coalesce(sum(n) OVER (PARTITION BY {K} ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           AS off FROM p2),
p4 AS (SELECT *, unnest(range(n)) AS i FROM p3 WHERE n > 0)
SELECT {K}, ident || '-' || CAST(1 + i AS VARCHAR) AS id_number, off + i AS id_idx FROM p4""")

SQL["id_comma"] = with_fx(f"""
SELECT {K}, unnest(string_split(id_text, ',')) AS id_number, unnest(range(len(string_split(id_text, ','))))
  AS id_idx FROM fx""")

SQL["id_dash_range"] = with_fx(f"""
, a AS (SELECT {K}, range_text AS s, string_split(range_text, '-') AS parts FROM fx
        WHERE NOT contains(lower(range_text), 'to') AND NOT regexp_matches(range_text, 'x\\d')
          AND contains(range_text, '-') AND NOT regexp_matches(replace(range_text, '-', ''), '^[0-9]+$')),
b AS (SELECT *, parts[1] AS p0, {strip('parts[2]')} AS p1 FROM a WHERE len(parts) = 2),
c AS (SELECT *, substr(p0, 1, length(p0) - 1) AS pre, TRY_CAST(substr(p0, length(p0), 1) AS HUGEINT) AS st,
        CASE WHEN regexp_matches(p1, '^[+-]?[0-9]+$') THEN TRY_CAST(p1 AS HUGEINT) END AS en
      FROM b WHERE length(p0) > 0 AND regexp_matches(substr(p0, length(p0), 1), '^[0-9]$')),
d AS (SELECT *, unnest(range(CAST(greatest(en - st + 1, 0) AS BIGINT))) AS i FROM c WHERE en IS NOT NULL)
SELECT {K}, pre || CAST(st + i AS VARCHAR) AS id_number, i AS id_idx FROM d
UNION ALL
SELECT {K}, {strip('range_text')} AS id_number, 0 AS id_idx FROM fx
WHERE NOT contains(lower(range_text), 'to') AND NOT regexp_matches(range_text, 'x\\d')
  AND contains(range_text, '-') AND NOT regexp_matches(replace(range_text, '-', ''), '^[0-9]+$')
  AND len(string_split(range_text, '-')) <> 2""")

HYPHEN = with_fx(f"""
, a AS (SELECT {K}, range_text AS s,
          regexp_matches(range_text, '^([A-Za-z]+)(\\d+)-(\\d+)') AS a_ok,
          regexp_matches(range_text, '^([A-Za-z]+\\d+/?\\d*)/(\\d+)-(\\d+)') AS b_ok FROM fx),
b AS (SELECT *,
    CASE WHEN a_ok THEN regexp_extract(s, '^([A-Za-z]+)(\\d+)-(\\d+)', 1)
         WHEN b_ok THEN regexp_extract(s, '^([A-Za-z]+\\d+/?\\d*)/(\\d+)-(\\d+)', 1) || '/' ELSE s END AS pre,
    CASE WHEN a_ok THEN CAST(regexp_extract(s, '^([A-Za-z]+)(\\d+)-(\\d+)', 2) AS HUGEINT)
         WHEN b_ok THEN CAST(regexp_extract(s, '^([A-Za-z]+\\d+/?\\d*)/(\\d+)-(\\d+)', 2) AS HUGEINT) END AS st,
    CASE WHEN a_ok THEN CAST(regexp_extract(s, '^([A-Za-z]+)(\\d+)-(\\d+)', 3) AS HUGEINT)
         WHEN b_ok THEN CAST(regexp_extract(s, '^([A-Za-z]+\\d+/?\\d*)/(\\d+)-(\\d+)', 3) AS HUGEINT) END AS en,
    CASE WHEN b_ok AND NOT a_ok THEN 2 ELSE 0 END AS pad FROM a),
c AS (SELECT *, CASE WHEN st IS NULL THEN 1 WHEN en < st THEN 1 ELSE en - st + 1 END AS n,
        CASE WHEN en < st THEN 'Error: End of range (' || CAST(en AS VARCHAR) || ') is less than start of range ('
          || CAST(st AS VARCHAR) || ') for ID number ' || s END AS range_error FROM b),
d AS (SELECT *, unnest(range(CAST(n AS BIGINT))) AS i FROM c),
hy AS (SELECT {K}, range_error, CASE WHEN st IS NULL THEN pre ELSE pre ||
    CASE WHEN length(CAST(st + i AS VARCHAR)) < pad THEN lpad(CAST(st + i AS VARCHAR), pad, '0')
         ELSE CAST(st + i AS VARCHAR) END END AS id_number, i AS id_idx FROM d)
""")
SQL["id_hyphen_range"] = HYPHEN + "SELECT * FROM hy"
SQL["distinct_ids"] = HYPHEN + "SELECT DISTINCT l_orderkey AS doc_id, id_number FROM hy"

# ======================================================================== grids on lineitem
CELL_ROWS = """
cr AS (SELECT *, rn - CASE WHEN rn > 4 THEN 0 ELSE 1 END AS row_no FROM (SELECT l_orderkey, l_linenumber,
          row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn,
          [CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
          CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_returnflag END, l_linestatus] AS cells FROM lineitem)),
longc AS (SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, row_no, unnest(range(4)) AS col_no,
          unnest(cells) AS cell FROM cr)
"""
ROW_TEXT = "array_to_string(list_transform(cells, lambda c: coalesce(c, '')), ' ')"
SQL["row_text"] = f"WITH {CELL_ROWS} SELECT l_orderkey, l_linenumber, {ROW_TEXT} AS row_text FROM cr"
SQL["row_text_nonnull"] = f"WITH {CELL_ROWS} SELECT l_orderkey, l_linenumber, array_to_string(cells, ' ') AS row_text FROM cr"
SQL["skip_header_rows"] = (f"WITH {CELL_ROWS} SELECT * FROM (SELECT l_orderkey, l_linenumber, {ROW_TEXT} AS row_text "
                           f"FROM cr) WHERE NOT contains(row_text, ' A F')")
SQL["assemble_grid"] = f"""WITH {CELL_ROWS},
g AS (SELECT l_orderkey, max(row_no) + 1 AS mx FROM cr GROUP BY l_orderkey),
r AS (SELECT l_orderkey, unnest(range(mx)) AS r FROM g),
j AS (SELECT r.l_orderkey, r.r, CASE WHEN cr.cells IS NULL THEN '<null>' ELSE
        array_to_string(list_transform(cr.cells, lambda c: coalesce(c, '~')), ',') END AS rt
      FROM r LEFT JOIN cr ON cr.l_orderkey = r.l_orderkey AND cr.row_no = r.r)
SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, 1 AS page_no, 1 AS n_tables, count(*) AS n_rows,
       string_agg(rt, '|' ORDER BY r) AS grid FROM j GROUP BY l_orderkey"""
SQL["cell_at"] = f"""WITH {CELL_ROWS}
SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, max(CASE WHEN row_no = 0 THEN cells[1] END) AS c000,
  max(CASE WHEN row_no = 2 THEN cells[3] END) AS c022, max(CASE WHEN row_no = 6 THEN cells[4] END) AS c063,
  CAST(NULL AS VARCHAR) AS c100 FROM cr GROUP BY l_orderkey"""


def _pick(label):
    return (f"v.cells[list_position(list_transform(h.cells, lambda c: coalesce(contains(lower(c), {q(label)}), "
            f"false)), true)]")


SQL["label_pick"] = f"""WITH {CELL_ROWS}
SELECT CAST(d.l_orderkey AS VARCHAR) AS doc_id, {_pick('1')} AS pick_1, {_pick('f')} AS pick_f
FROM (SELECT DISTINCT l_orderkey FROM cr) d
LEFT JOIN (SELECT * FROM cr WHERE row_no = 0) h ON h.l_orderkey = d.l_orderkey
LEFT JOIN (SELECT * FROM cr WHERE row_no = 1) v ON v.l_orderkey = d.l_orderkey"""
SQL["next_row_value"] = f"""WITH {CELL_ROWS}
SELECT doc_id, row_no, col_no, cell, lead(cell) OVER (PARTITION BY doc_id, col_no ORDER BY row_no) AS next_cell
FROM longc"""
SQL["header_value_join"] = f"""WITH {CELL_ROWS}
SELECT h.doc_id, h.col_no, h.cell AS header, v.cell AS value FROM (SELECT * FROM longc WHERE row_no = 0) h
LEFT JOIN (SELECT * FROM longc WHERE row_no = 1) v ON v.doc_id = h.doc_id AND v.col_no = h.col_no"""
SQL["page_rows_to_items"] = f"""WITH {CELL_ROWS}
SELECT l_orderkey, l_linenumber, regexp_extract(row_text, {pat(fields.REGISTER_ID)}, 0) AS id_number FROM (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN 'ABC' ELSE 'ab' END || {ROW_TEXT} AS row_text
  FROM cr) WHERE regexp_matches(row_text, {pat(fields.REGISTER_ID)})"""

SQL["classify_layout"] = """
SELECT p_partkey, CASE WHEN starts_with(lower(t), 'small') THEN 'small'
  WHEN starts_with(lower(t), 'red') OR starts_with(lower(t), 'hot') THEN 'warm'
  WHEN starts_with(lower(t), 'large ') THEN 'big' END AS layout
FROM (SELECT p_partkey, p_name || ' ' || '' || ' ' || p_type AS t FROM part)"""
SQL["classify_header"] = """
SELECT p_partkey, CASE WHEN contains(p_name, 'anvil') THEN 'anvil' WHEN contains(p_name, 'bolt') THEN 'bolt'
  WHEN contains(p_name, 'ring') THEN 'ring' END AS layout FROM part"""

# ======================================================================== documents
ROUTE = ("CASE WHEN contains(lower(text), 'elle') THEN 'elle' WHEN contains(lower(text), 'the') THEN 'the' "
         "WHEN contains(lower(text), 'und') THEN 'und' END")
BLANK = f"coalesce({strip('text')} = '', true)"
SQL["blank_text"] = f"SELECT doc_id, {BLANK} AS blank FROM documents"
SQL["route_documents"] = f"SELECT doc_id, {ROUTE} AS client FROM documents"
SQL["page_filter"] = "SELECT doc_id, lang FROM documents WHERE contains(text, 'the') AND NOT contains(text, 'und')"
SQL["document_status"] = f"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN NOT blank THEN client END AS client,
  CASE WHEN NOT blank AND client IS NOT NULL THEN {q(C.STATUS_SUCCESS)} ELSE {q(C.STATUS_FAILURE)} END AS status,
  CASE WHEN blank THEN {q(C.REASON_BLANK)} WHEN client IS NULL THEN {q(C.REASON_NO_CLIENT)} END AS reason,
  '2024-01-01' AS run_date
FROM (SELECT doc_id, {ROUTE} AS client, {BLANK} AS blank FROM documents)"""
SQL["output_name"] = """
SELECT doc_id, regexp_replace(path, '\\.pdf$', '.xlsx') AS output_name, replace(path, 'pdf', 'xlsx') AS output_name_compat
FROM (SELECT doc_id, 'in/' || source || '/pdfdoc_' || CAST(doc_id AS VARCHAR) || '.pdf' AS path FROM documents)"""


# ======================================================================== dictionary
def dict_ctes() -> str:
    man, mod = cr.FIXTURE_DICTIONARY

    def val(v):
        return "NULL" if v is None else q(v)
    m = ", ".join(f"({i}, {val(k)}, {val(c)})" for i, (k, c) in enumerate(man))
    d = ", ".join(f"({i}, {val(k)}, {val(c)})" for i, (k, c) in enumerate(mod))
    return (f"dm(ord, keyword, canonical) AS (VALUES {m}), "
            f"dd(ord, model, manufacturer) AS (VALUES {d})")


def tokens(x):
    return f"list_distinct(list_filter(string_split_regex(lower({x}), '\\s+'), lambda t: t <> ''))"


def token_hits(src_cte: str, col: str) -> str:
    """CTEs th_m / th_d / th: first manufacturer / model row per distinct text."""
    return f"""
th_descs AS (SELECT DISTINCT {col} AS d FROM {src_cte} WHERE {col} IS NOT NULL),
th_toks AS (SELECT d, unnest({tokens('d')}) AS tok FROM th_descs),
th_m AS (SELECT d, arg_min({{'c': canonical, 'k': keyword}}, ord) AS s FROM th_toks
         JOIN dm ON lower(dm.keyword) = th_toks.tok WHERE dm.keyword <> '' GROUP BY d),
th_d AS (SELECT d, arg_min({{'m': model, 'f': manufacturer}}, ord) AS s FROM th_toks
         JOIN dd ON lower(dd.model) = th_toks.tok WHERE dd.model <> '' GROUP BY d),
th AS (SELECT th_descs.d, th_m.s.c AS mc, th_m.s.k AS mk, th_d.s.m AS dm_model, th_d.s.f AS dmf
       FROM th_descs LEFT JOIN th_m ON th_m.d = th_descs.d LEFT JOIN th_d ON th_d.d = th_descs.d)"""


def token_resolve(override=True) -> str:
    mc = (f"CASE WHEN lower(mc) = 'miller' AND list_contains({tokens('d')}, 'weblift') THEN 'Miller Weblift' "
          f"ELSE mc END") if override else "mc"
    return f"""
thr AS (SELECT d, CASE WHEN ({mc}) <> '' THEN ({mc}) WHEN dmf <> '' THEN dmf END AS manufacturer,
        nullif(dm_model, '') AS model, nullif(mk, '') AS m_keyword FROM th)"""


SQL["dict_token_lookup"] = f"""WITH {dict_ctes()}, {token_hits('part', 'p_name')}, {token_resolve()}
SELECT p_partkey, p_name, thr.manufacturer, thr.model FROM part LEFT JOIN thr ON thr.d = part.p_name"""
SQL["dict_keyword_lookup"] = f"""WITH {dict_ctes()}, {token_hits('part', 'p_name')}, {token_resolve()}
SELECT p_partkey, p_name, thr.m_keyword AS manufacturer, thr.model FROM part LEFT JOIN thr ON thr.d = part.p_name"""
SQL["dict_substring_lookup"] = f"""WITH {dict_ctes()},
descs AS (SELECT DISTINCT p_name FROM part),
hit AS (SELECT p_name, arg_min({{'f': manufacturer, 'm': model}}, ord) AS s FROM descs
        JOIN dd ON dd.model <> '' AND contains(lower(p_name), lower(dd.model)) GROUP BY p_name)
SELECT p_partkey, part.p_name, nullif(hit.s.f, '') AS manufacturer, nullif(hit.s.m, '') AS model
FROM part LEFT JOIN hit ON hit.p_name = part.p_name"""
SQL["manufacturer_fallback"] = f"""WITH {dict_ctes()}, {token_hits('part', 'p_name')}
SELECT p_partkey, nullif(th.mc, '') AS canonical_hit, nullif(th.dmf, '') AS model_maker,
  coalesce(nullif(th.mc, ''), nullif(th.dmf, '')) AS manufacturer FROM part LEFT JOIN th ON th.d = part.p_name"""
SQL["manufacturer_override"] = f"""WITH {dict_ctes()},
src AS (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'MILLER ' ELSE '' END || p_name ||
          CASE WHEN p_size % 2 = 0 THEN ' Weblift' ELSE '' END AS description FROM part),
{token_hits('src', 'description')}, {token_resolve()}
SELECT p_partkey, thr.manufacturer, thr.model FROM src LEFT JOIN thr ON thr.d = src.description"""
SQL["dict_misses"] = f"""WITH {dict_ctes()},
descs AS (SELECT DISTINCT p_name FROM part),
toks AS (SELECT p_name, unnest({tokens('p_name')}) AS tok FROM descs),
keys AS (SELECT lower(keyword) AS tok FROM dm WHERE keyword <> '' UNION SELECT lower(model) FROM dd WHERE model <> '')
SELECT p_name FROM descs WHERE p_name NOT IN (SELECT p_name FROM toks JOIN keys USING (tok))"""
SQL["scan_dictionary"] = """
SELECT CAST(first_key AS INTEGER) AS ord, keyword, canonical, keyword AS model, canonical AS model_manufacturer FROM (
  SELECT string_split(p_name, ' ')[2] AS keyword, arg_min(p_brand, p_partkey) AS canonical, min(p_partkey) AS first_key
  FROM part GROUP BY 1)"""

# ======================================================================== aggregations / windows
SQL["items_last_wins"] = """
SELECT l_orderkey, l_linenumber, arg_min(l_partkey, (l_partkey, l_suppkey)) AS first_partkey,
  arg_min(l_suppkey, (l_partkey, l_suppkey)) AS first_suppkey,
  arg_max(l_quantity, (l_partkey, l_suppkey)) AS l_quantity,
  arg_max(l_extendedprice, (l_partkey, l_suppkey)) AS l_extendedprice,
  arg_max(l_returnflag, (l_partkey, l_suppkey)) AS l_returnflag,
  CAST(arg_max(l_shipdate, (l_partkey, l_suppkey)) AS VARCHAR) AS l_shipdate
FROM lineitem GROUP BY l_orderkey, l_linenumber"""
SQL["page_last_nonnull"] = """
SELECT l_orderkey, arg_max(flag, (l_linenumber, l_partkey, l_suppkey)) FILTER (WHERE flag IS NOT NULL) AS flag,
  arg_max(status, (l_linenumber, l_partkey, l_suppkey)) FILTER (WHERE status IS NOT NULL) AS status
FROM (SELECT *, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_returnflag END AS flag,
        CASE WHEN l_linenumber >= 4 THEN NULL ELSE l_linestatus END AS status FROM lineitem)
GROUP BY l_orderkey"""

FX_ERRORS = with_fx(f"""
, e AS (SELECT *, list_filter([CASE WHEN coalesce(swl_value, '') = '' THEN 'SWL Value not found' END,
          CASE WHEN coalesce(swl_unit, '') = '' THEN 'SWL Unit not found' END,
          CASE WHEN {_lookup(_entries_last('header_block'), 'duedateofnextthoroughexamination')} IS NULL
               THEN 'Next Inspection Due Date not found' END], lambda x: x IS NOT NULL) AS errors
        FROM (SELECT *, {swl_cols('swl_text', swl.SPARROW)} FROM fx))
""")


def pylist(x):
    return f"'[' || array_to_string(list_transform({x}, lambda e: '''' || e || ''''), ', ') || ']'"


SQL["item_errors"] = FX_ERRORS + f"SELECT {K}, CASE WHEN len(errors) > 0 THEN {pylist('errors')} END AS errors FROM e"
SQL["running_errors"] = FX_ERRORS + f"""
SELECT {K}, len(r) AS n_errors, {pylist('r')} AS running_errors FROM (
  SELECT *, flatten(list(errors) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS r FROM e)"""
SQL["row_numbering"] = f"""
SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, first_partkey) + 2
  AS row_no FROM ({SQL['items_last_wins']})"""
SQL["stamp_page_attrs"] = with_fx(f"""
, r AS (SELECT {K}, CASE WHEN l_linenumber = 2 THEN date_text END AS cert_date,
          CASE WHEN l_linenumber % 2 = 1 THEN 'R' || CAST(l_partkey AS VARCHAR) END AS report FROM fx),
pg AS (SELECT l_orderkey,
  arg_max(cert_date, (l_linenumber, l_partkey, l_suppkey)) FILTER (WHERE cert_date IS NOT NULL) AS cert_date,
  arg_max(report, (l_linenumber, l_partkey, l_suppkey)) FILTER (WHERE report IS NOT NULL) AS report
  FROM r GROUP BY l_orderkey)
SELECT r.l_orderkey, l_partkey, l_suppkey, l_linenumber, pg.cert_date, pg.report FROM r
LEFT JOIN pg ON pg.l_orderkey = r.l_orderkey""")
SQL["union_layouts"] = f"""
SELECT l_orderkey, id_number, 'to_range' AS source, CAST(NULL AS VARCHAR) AS range_error
FROM ({SQL['id_to_range']})
UNION ALL
SELECT l_orderkey, id_number, 'hyphen' AS source, range_error FROM ({SQL['id_hyphen_range']})"""

# ======================================================================== carrier pages
PAGED = f"""
paged AS (SELECT fx.*, p.p_name,
    CASE WHEN l_linenumber <> 7 THEN p.p_name || CASE WHEN l_linenumber % 3 = 0 THEN ' MILLER weblift'
      WHEN l_linenumber % 3 = 1 THEN ' TCB14' ELSE '' END END AS description,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS INTEGER)
      AS page_no, CAST(l_orderkey AS VARCHAR) AS doc_id
  FROM fx LEFT JOIN part p ON p.p_partkey = fx.l_partkey)
"""
SQL["first_page"] = with_fx(f", {PAGED} SELECT doc_id, page_no, 'Sparrows inspection certificate' AS text "
                            f"FROM paged WHERE page_no = 1")
SQL["scan_page_grids"] = with_fx(f""", {PAGED}
SELECT doc_id, page_no, CASE WHEN no_table THEN 0 ELSE 1 END AS n_tables, CASE WHEN NOT no_table THEN 5 END AS n_rows,
  CASE WHEN NOT no_table THEN header_block || '|x|x|Identification Number,Quantity,Description of Equipment,SWL|' ||
  id_text || ',' || CAST(qty AS VARCHAR) || ',' || coalesce(description, '~') || ',' || swl_text END AS grid
FROM (SELECT *, l_linenumber = 6 AND qty % 2 = 0 AS no_table FROM paged)""")


# ======================================================================== layouts
def id_expr_ctes(variant: str) -> str:
    """CTEs over ``ie_src(rid, s, q)``: ``ie_ids(rid, id_number, id_idx)`` and
    ``ie_ok(rid, ok)`` (ok = false where the numbering rules fail)."""
    dash = "contains(s, '-') AND NOT regexp_matches(replace(s, '-', ''), '^[0-9]+$')"
    branches = ["WHEN s IS NULL THEN 'fail'", "WHEN contains(lower(s), 'to') THEN 'g2'",
                "WHEN regexp_matches(s, 'x\\d') THEN 'g3'"]
    if variant in ("sparrow", "centurion", "centurion_deployed"):
        branches.append("WHEN contains(s, ',') THEN 'g4'")
    if variant in ("centurion", "centurion_local"):
        branches.append(f"WHEN {dash} THEN 'g5'")
    otherwise = "'fail'" if variant == "sparrow" else "'empty'"
    return f"""
ie_b AS (SELECT rid, s, q, CASE {' '.join(branches)} ELSE {otherwise} END AS br FROM ie_src),
ie_g2a AS (SELECT rid, q, {strip("string_split(s, 'to')[1]")} AS first FROM ie_b WHERE br = 'g2'),
ie_g2b AS (SELECT *, contains(first, '-') AS dashed, string_split(first, '-') AS parts FROM ie_g2a),
ie_g2c AS (SELECT *, CASE WHEN dashed THEN parts[2] ELSE first END AS gs,
             CASE WHEN dashed THEN parts[1] || '-' ELSE '' END AS pre FROM ie_g2b WHERE NOT dashed OR len(parts) = 2),
ie_g2d AS (SELECT *, {g1_cols('gs')} FROM ie_g2c WHERE length(gs) > 0),
ie_g2ok AS (SELECT * FROM ie_g2d WHERE g_base IS NOT NULL AND q IS NOT NULL),
ie_g2ids AS (SELECT rid, pre || g_prefix || CAST(g_base + i AS VARCHAR) || g_suffix AS id_number, i AS id_idx
             FROM (SELECT *, unnest(range(q)) AS i FROM ie_g2ok WHERE q > 0)),
ie_g3a AS (SELECT rid, string_split(s, ',') AS pieces FROM ie_b WHERE br = 'g3'),
ie_g3ok AS (SELECT * FROM ie_g3a WHERE len(list_filter(pieces, lambda p: len(string_split(p, 'x')) < 2 OR
             regexp_replace(string_split(p, 'x')[2], '[^0-9]', '', 'g') = '')) = 0),
ie_g3p AS (SELECT rid, unnest(pieces) AS piece, unnest(range(len(pieces))) AS k FROM ie_g3ok),
ie_g3q AS (SELECT *, {strip("string_split(piece, 'x')[1]")} AS ident0,
             CAST(regexp_replace(string_split(piece, 'x')[2], '[^0-9]', '', 'g') AS BIGINT) AS n FROM ie_g3p),
ie_g3r AS (SELECT *, CASE WHEN regexp_matches(ident0, '[0-9]') THEN regexp_extract(ident0, '(?s)^(.*[0-9])', 1)
             ELSE ident0 END AS ident,
             coalesce(sum(n) OVER (PARTITION BY rid ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             AS off FROM ie_g3q),
ie_g3ids AS (SELECT rid, ident || '-' || CAST(1 + i AS VARCHAR) AS id_number, off + i AS id_idx
             FROM (SELECT *, unnest(range(n)) AS i FROM ie_g3r WHERE n > 0)),
ie_g4ids AS (SELECT rid, unnest(string_split(s, ',')) AS id_number, unnest(range(len(string_split(s, ','))))
             AS id_idx FROM ie_b WHERE br = 'g4'),
ie_g5a AS (SELECT rid, s, string_split(s, '-') AS parts FROM ie_b WHERE br = 'g5'),
ie_g5b AS (SELECT *, parts[1] AS p0, {strip('parts[2]')} AS p1 FROM ie_g5a WHERE len(parts) = 2),
ie_g5ok AS (SELECT *, substr(p0, 1, length(p0) - 1) AS pre, TRY_CAST(substr(p0, length(p0), 1) AS HUGEINT) AS st,
             TRY_CAST(p1 AS HUGEINT) AS en FROM ie_g5b
             WHERE length(p0) > 0 AND regexp_matches(substr(p0, length(p0), 1), '^[0-9]$')
               AND regexp_matches(p1, '^[+-]?[0-9]+$')),
ie_g5ids AS (SELECT rid, pre || CAST(st + i AS VARCHAR) AS id_number, i AS id_idx
             FROM (SELECT *, unnest(range(CAST(greatest(en - st + 1, 0) AS BIGINT))) AS i FROM ie_g5ok)
             UNION ALL SELECT rid, {strip('s')}, 0 FROM ie_g5a WHERE len(parts) <> 2),
ie_ids AS (SELECT * FROM ie_g2ids UNION ALL SELECT * FROM ie_g3ids UNION ALL SELECT * FROM ie_g4ids
           UNION ALL SELECT * FROM ie_g5ids),
ie_ok AS (SELECT rid, CASE br WHEN 'g2' THEN rid IN (SELECT rid FROM ie_g2ok) WHEN 'g3' THEN rid IN
           (SELECT rid FROM ie_g3ok) WHEN 'g4' THEN true WHEN 'g5' THEN (rid IN (SELECT rid FROM ie_g5ok) OR
           rid IN (SELECT rid FROM ie_g5a WHERE len(parts) <> 2)) WHEN 'empty' THEN true ELSE false END AS ok,
           (SELECT count(*) FROM ie_ids WHERE ie_ids.rid = ie_b.rid) AS n_ids FROM ie_b)"""


PAYLOAD = ["item_description", "model", "swl_value", "swl_unit", "swl_note", "manufacturer", "certificate_no",
           "previous_inspection", "next_inspection_due_date", "provider_identification", "errors"]


def last_wins_sql(src: str) -> str:
    """Per (doc_id, id_number): values of the greatest (page, row, idx) position,
    first position kept."""
    packed = "{" + ", ".join(f"'{c}': {c}" for c in PAYLOAD) + "}"
    return f"""
SELECT doc_id, id_number, w.first_page, w.first_idx, {', '.join(f'v.{c} AS {c}' for c in PAYLOAD)} FROM (
  SELECT doc_id, id_number, arg_max({packed}, (page_no, row_no, id_idx)) AS v,
         arg_min({{'first_page': page_no, 'first_idx': id_idx}}, (page_no, row_no, id_idx)) AS w
  FROM {src} GROUP BY doc_id, id_number)"""


def render_errors(x: str) -> str:
    return f"CASE WHEN len({x}) > 0 THEN {pylist(x)} END"


def lst(*items) -> str:
    """Ordered error list from (condition, text) pairs."""
    return "list_filter([" + ", ".join(f"CASE WHEN {c} THEN {t} END" for c, t in items) + "], lambda x: x IS NOT NULL)"


def truthy(x: str) -> str:
    return f"coalesce({x}, '') <> ''"


SPARROW_SRC = f"""
sp AS (SELECT doc_id, page_no, doc_id || '#' || CAST(page_no AS VARCHAR) AS rid, header_block,
         (l_linenumber = 6 AND qty % 2 = 0) AS no_table, {strip('id_text')} AS ident,
         CASE WHEN description IS NOT NULL THEN replace(description, chr(10), ' ') END AS descr,
         {strip('swl_text')} AS swl_raw,
         CAST(trunc(TRY_CAST({strip('CAST(qty AS VARCHAR)')} AS DOUBLE)) AS BIGINT) AS q FROM paged),
sp_items AS (SELECT * FROM sp WHERE NOT no_table AND ident <> ''),
ie_src AS (SELECT rid, ident AS s, q FROM sp_items WHERE q > 1)"""


def _sparrow_body():
    e = _entries_last('header_block')
    return f"""
sp2 AS (SELECT i.*, thr.manufacturer, thr.model, {_lookup(e, 'reportnumber')} AS certificate_no,
          {_lookup(e, 'dateofthoroughexamination')} AS previous_inspection, {_lookup(e, 'jobnumber')} AS job,
          {_lookup(e, 'duedateofnextthoroughexamination')} AS next_inspection_due_date,
          CASE WHEN q IS NULL THEN false WHEN q <= 1 THEN true ELSE ok.ok END AS id_ok,
          {truthy('descr')} AS has_desc, {truthy('swl_raw')} AS has_swl,
          {swl_cols('swl_raw', swl.SPARROW, 'p_')}
        FROM sp_items i LEFT JOIN thr ON thr.d = i.descr LEFT JOIN ie_ok ok ON ok.rid = i.rid),
sp3 AS (SELECT *, {lst(('NOT has_desc', q(C.SPARROW_NO_DESCRIPTION)),
                       ('has_desc AND manufacturer IS NULL', q(C.MANUFACTURER_NOT_FOUND)),
                       ('has_desc AND model IS NULL', q(C.MODEL_NOT_FOUND)),
                       (f"has_swl AND NOT ({truthy('p_swl_value')})", q(C.SWL_VALUE_NOT_FOUND)),
                       (f"has_swl AND NOT ({truthy('p_swl_unit')})", q(C.SWL_UNIT_NOT_FOUND)),
                       ('NOT has_swl', q(C.SWL_NOT_FOUND)),
                       ('certificate_no IS NULL', q(C.CERTIFICATE_NO_NOT_FOUND)),
                       ('previous_inspection IS NULL', q(C.PREVIOUS_INSPECTION_NOT_FOUND)),
                       ('job IS NULL', q(C.PROVIDER_NOT_FOUND)),
                       ('next_inspection_due_date IS NULL', q(C.NEXT_DUE_NOT_FOUND)))} AS base FROM sp2),
sp4 AS (SELECT *, CASE WHEN NOT id_ok THEN list_concat(base, [{q(C.ID_EXPANSION_FAILED)},
          {q(C.PAGE_NO_PREFIX)} || CAST(page_no AS VARCHAR)])
          WHEN len(base) > 0 THEN list_concat(base, [{q(C.PAGE_NO_PREFIX)} || CAST(page_no AS VARCHAR)])
          ELSE base END AS errs FROM sp3),
sp_ids AS (SELECT rid, id_number, id_idx FROM ie_ids WHERE rid IN (SELECT rid FROM sp4 WHERE id_ok AND q > 1)
           UNION ALL SELECT rid, ident, 0 FROM sp4 WHERE NOT id_ok OR q <= 1),
sp_exp AS (SELECT doc_id, page_no, 4 AS row_no, sp_ids.id_number, sp_ids.id_idx,
             CASE WHEN has_desc THEN descr END AS item_description, model,
             CASE WHEN has_swl THEN nullif(p_swl_value, '') END AS swl_value,
             CASE WHEN has_swl THEN p_swl_unit END AS swl_unit, CASE WHEN has_swl THEN p_swl_note END AS swl_note,
             manufacturer, certificate_no, previous_inspection, next_inspection_due_date,
             CASE WHEN job IS NOT NULL THEN 'LOFT-' || job END AS provider_identification,
             {render_errors('errs')} AS errors
           FROM sp4 JOIN sp_ids USING (rid))"""


SQL["extract_sparrow"] = with_fx(f""", {dict_ctes()}, {PAGED}, {SPARROW_SRC}, {id_expr_ctes('sparrow')},
{token_hits('sp_items', 'descr')}, {token_resolve()}, {_sparrow_body()}
{last_wins_sql('sp_exp')}""")

SQL["page_outcome"] = with_fx(f""", {PAGED}
SELECT layout, doc_id, page_no, CASE WHEN error IS NULL THEN 'items' ELSE 'error' END AS status, n_items, error FROM (
  SELECT 'sparrow' AS layout, doc_id, page_no, CASE WHEN no_table THEN 0 ELSE 1 END AS n_items,
    CASE WHEN no_table THEN {q(C.NO_TEXT_ON_PAGE)} END AS error
  FROM (SELECT *, l_linenumber = 6 AND qty % 2 = 0 AS no_table FROM paged)
  UNION ALL SELECT 'centurion', doc_id, page_no, CASE WHEN description IS NULL THEN 0 ELSE 1 END,
    CASE WHEN description IS NULL THEN {q(C.CENTURION_NO_SERIALS)} END FROM paged
  UNION ALL SELECT 'hendrik', doc_id, page_no, CASE WHEN description IS NULL THEN 0 ELSE 1 END,
    CASE WHEN description IS NULL THEN {q(C.PAGE_SHAPE_ERROR)} END FROM paged
  UNION ALL SELECT 'register', doc_id, page_no, n, CASE WHEN n = 0 THEN {q(C.NO_IDS_ON_PAGE)} END
    FROM (SELECT *, CASE WHEN description IS NULL THEN 0 ELSE 1 END + CASE WHEN l_linenumber % 3 <> 0 THEN 1 ELSE 0 END
          AS n FROM paged)
  UNION ALL SELECT 'declaration', doc_id, page_no, 1, NULL FROM paged
  UNION ALL SELECT 'centurion_qty', doc_id, page_no, CASE WHEN description IS NULL THEN 0 ELSE 1 END,
    CASE WHEN description IS NULL THEN {q(C.CENTURION_NO_SERIALS)} END FROM paged
  UNION ALL SELECT 'cells', doc_id, page_no, CASE WHEN description IS NULL THEN 0 ELSE 1 END,
    CASE WHEN description IS NULL THEN {q(C.NO_IDS_ON_PAGE)} END FROM paged)""")


def _centurion(qty_layout: bool, deployed: bool = False) -> str:
    ef = _entries_first('block')
    if qty_layout:
        cell0 = "CAST(qty AS VARCHAR) || ' ' || description"
        serial_cell = "id_text"
    else:
        cell0 = "description || ': ' || CAST(qty AS VARCHAR) || 'm'"
        serial_cell = "'Serial No(s): ' || id_text"
    serials = (f"array_to_string(list_transform(string_split(regexp_replace({serial_cell}, '\\s+', '', 'g'), ','), "
               f"lambda p: CASE WHEN starts_with(p, {q(fields.SERIAL_PREFIX)}) THEN "
               f"substr(p, {len(fields.SERIAL_PREFIX) + 1}) ELSE p END), ',')")
    if deployed:
        serials = strip(f"string_split({serial_cell}, ':')[-1]")
    qty_expr = (f"TRY_CAST({nz(f'regexp_extract(cell0, {pat(fields.LEADING_QUANTITY)}, 1)')} AS BIGINT)"
                if qty_layout else "NULL")
    ids = ("""ce_ids AS (SELECT rid, id_number, id_idx FROM ie_ids WHERE rid IN (SELECT rid FROM ce3 WHERE q > 1 AND n_ids > 0)
           UNION ALL SELECT rid, serials, 0 FROM ce3 WHERE q <= 1 OR n_ids = 0),""" if qty_layout else
           "ce_ids AS (SELECT rid, serials AS id_number, 0 AS id_idx FROM ce3),")
    head = [] if qty_layout else [(f"NOT ({truthy('maker')})", q(C.MANUFACTURER_NOT_FOUND)),
                                  ("model IS NULL", q(C.MODEL_NOT_FOUND))]
    return with_fx(f""", {dict_ctes()}, {PAGED},
ce AS (SELECT doc_id, page_no, doc_id || '#' || CAST(page_no AS VARCHAR) AS rid,
         'Report Number: C' || CAST(l_orderkey AS VARCHAR) || chr(10) || 'Date of Examination: ' || date_text ||
         chr(10) || 'Cust Ref/PO No.: P' || CAST(l_suppkey AS VARCHAR) AS block,
         {cell0} AS cell0, {strip('swl_text')} AS wwl, strftime(try_strptime({strip('date_text')}, '%d/%m/%Y'),
         '%d/%m/%Y') AS next_date, 'Maker' || CAST(l_suppkey AS VARCHAR) AS maker,
         {serials} AS serials FROM paged),
ce1 AS (SELECT *, CASE WHEN cell0 IS NOT NULL THEN replace(cell0, chr(10), ' ') END AS descr,
          {qty_expr} AS q FROM ce),
ce_items AS (SELECT * FROM ce1 WHERE descr IS NOT NULL AND descr <> ''),
ie_src AS (SELECT rid, serials AS s, q FROM ce_items WHERE q > 1),
{id_expr_ctes('centurion_deployed' if deployed else 'centurion')},
{token_hits('ce_items', 'descr')}, {token_resolve()},
ce2 AS (SELECT i.*, thr.model, {_lookup(ef, 'custrefpono')} AS provider_identification,
          {_lookup(ef, 'reportnumber')} AS certificate_no, {_lookup(ef, 'dateofexamination')} AS previous_inspection,
          coalesce(ok.ok, true) AS id_ok, coalesce(ok.n_ids, 0) AS n_ids, {truthy('wwl')} AS has_wwl,
          {swl_cols('wwl', swl.CENTURION_DEPLOYED if deployed else swl.CENTURION_LOCAL, 'p_')}
        FROM ce_items i LEFT JOIN thr ON thr.d = i.descr LEFT JOIN ie_ok ok ON ok.rid = i.rid),
ce3 AS (SELECT *, {lst(*head,
                       (f"has_wwl AND NOT ({truthy('p_swl_value')})", q(C.SWL_VALUE_NOT_FOUND)),
                       (f"has_wwl AND NOT ({truthy('p_swl_unit')})", q(C.SWL_UNIT_NOT_FOUND_C)),
                       ('NOT has_wwl', q(C.SWL_NOT_FOUND_C)))} AS errs FROM ce2
        WHERE {'q IS NOT NULL AND id_ok' if qty_layout else 'true'}),
{ids}
ce_exp AS (SELECT doc_id, page_no, 4 AS row_no, ce_ids.id_number, ce_ids.id_idx,
             string_split(descr, ':')[1] AS item_description, model,
             CASE WHEN has_wwl THEN nullif(p_swl_value, '') END AS swl_value,
             CASE WHEN has_wwl THEN p_swl_unit END AS swl_unit, CASE WHEN has_wwl THEN p_swl_note END AS swl_note,
             nullif(maker, '') AS manufacturer, certificate_no, previous_inspection,
             next_date AS next_inspection_due_date, provider_identification, {render_errors('errs')} AS errors
           FROM ce3 JOIN ce_ids USING (rid))
{last_wins_sql('ce_exp')}""")


SQL["extract_centurion_single"] = _centurion(False)
SQL["extract_centurion_qty"] = _centurion(True)
SQL["extract_centurion_single_deployed"] = _centurion(False, deployed=True)
SQL["extract_centurion_qty_deployed"] = _centurion(True, deployed=True)


SINK_COLS = {"Id Number": "id_number", "RFID": None, "Item Category": None, "Item Description": "item_description",
             "Model": "model", "SWL Value": "swl_value", "SWL Unit": "swl_unit", "SWL Note": "swl_note",
             "Manufacturer": "manufacturer", "Certificate No": "certificate_no", "Location": None,
             "Detailed Location ": None, "Previous Inspection": "previous_inspection",
             "Next Inspection Due Date": "next_inspection_due_date", "Fit For Purpose Y/N": None, "Status": None,
             "Provider Identification": "provider_identification", "Errors": "errors"}
_SINK_SELECT = ", ".join((f'{v} AS "{k}"' if v else f'CAST(NULL AS VARCHAR) AS "{k}"') for k, v in SINK_COLS.items())
SQL["sink_items"] = f"""
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY first_page, first_idx) + 2 AS sheet_row, {_SINK_SELECT}
FROM ({SQL['extract_sparrow']})"""
SQL["sink_page_errors"] = with_fx(f""", {PAGED}
SELECT doc_id, page_no AS "Page No", {q(C.NO_TEXT_ON_PAGE)} AS "Error" FROM paged
WHERE l_linenumber = 6 AND qty % 2 = 0""")
_MIXED = f"""
SELECT 'S-' || CAST(l_orderkey AS VARCHAR) AS doc_id, 'Sparrows' AS client,
  CASE WHEN l_orderkey % 97 = 0 THEN {q(C.REASON_NO_FIRST_PAGE)} END AS reason, count(*) AS n
FROM lineitem GROUP BY l_orderkey HAVING l_orderkey % 97 <> 0 OR count(*) > 1
UNION ALL SELECT DISTINCT tag || CAST(l_orderkey AS VARCHAR), client, NULL, 1 FROM lineitem, (VALUES ('C-', 'Centurion'),
  ('Q-', 'Centurion'), ('H-', 'Centurion'), ('R-', 'First Integrated'), ('F-', 'First Integrated'),
  ('P-', 'First Integrated')) AS k(tag, client)
UNION ALL SELECT 'D-' || CAST(doc_id AS VARCHAR), NULL,
  CASE WHEN {BLANK} THEN {q(C.REASON_BLANK)} ELSE {q(C.REASON_NO_CLIENT)} END, 1 FROM documents"""
SQL["document_status_mixed"] = f"""
SELECT doc_id, CASE WHEN reason IS NULL THEN client END AS client,
  CASE WHEN reason IS NULL THEN {q(C.STATUS_SUCCESS)} ELSE {q(C.STATUS_FAILURE)} END AS status, reason,
  '2024-01-01' AS run_date FROM ({_MIXED})"""
SQL["sink_manifest"] = f"""
SELECT doc_id, 'Rig-Ware import v2' AS A1, client AS B1, 'CreateLocations=No' AS C1 FROM ({_MIXED}) WHERE reason IS NULL"""
SQL["sink_overwrite"] = SQL["sink_items"]
SQL["scan_documents"] = """
SELECT source, count(*) AS n_documents, sum(length(text)) AS n_characters FROM documents WHERE text IS NOT NULL
GROUP BY source"""
SQL["extraction_summary"] = f"""
SELECT 'Sparrows' AS client, (SELECT count(*) FROM ({SQL['extract_sparrow']})) AS n_items,
  (SELECT count(DISTINCT doc_id) FROM ({SQL['extract_sparrow']})) AS n_docs,
  (SELECT count(*) FROM ({SQL['sink_page_errors']})) AS n_error_pages"""
_ITEM_COLS = "id_number, first_page, first_idx, " + ", ".join(PAYLOAD)
SQL["certificate_pipeline"] = f"""
SELECT 'S-' || doc_id AS doc_id, {_ITEM_COLS} FROM ({SQL['extract_sparrow']}) WHERE CAST(doc_id AS BIGINT) % 97 <> 0
UNION ALL
SELECT 'C-' || doc_id AS doc_id, {_ITEM_COLS} FROM ({SQL['extract_centurion_single']})"""
SQL["union_clients"] = f"""
SELECT doc_id, {_ITEM_COLS}, 'Sparrows' AS client FROM ({SQL['extract_sparrow']})
UNION ALL
SELECT doc_id, {_ITEM_COLS}, 'Centurion' AS client FROM ({SQL['extract_centurion_single']})"""


def _hendrik() -> str:
    return with_fx(f""", {dict_ctes()}, {PAGED},
he AS (SELECT doc_id, page_no,
   {nz(f"regexp_extract('Id (' || CAST(l_linenumber AS VARCHAR) || ') HK-' || CAST(l_orderkey AS VARCHAR) || '-' || "
       f"CAST(l_partkey AS VARCHAR) || ' more', {pat(fields.ID_AFTER_PAREN)}, 1)")} AS ident,
   {nz(f"regexp_extract('WLL ' || swl_text, {pat(swl.HENDRIK_CAPACITY)}, 1)")} AS wwl,
   replace({nz(f"regexp_extract('Date ' || replace(date_text, '/', '-'), {pat(DASHED_DATE)}, 1)")}, '-', '/') AS prev,
   CASE WHEN description IS NOT NULL THEN replace(description, chr(10), ' ') END AS descr,
   CASE WHEN l_linenumber % 2 = 0 THEN 'Tiger blocks' ELSE 'red MILLER' END AS maker_text,
   {nz(f"regexp_extract('Centurion Hendrik Certificate No. : ' || CAST(l_orderkey AS VARCHAR), "
       f"{pat(fields.CERTIFICATE_NO)}, 1)")} AS cert
 FROM paged),
he_items AS (SELECT * FROM he WHERE {truthy('ident')} AND {truthy('descr')}),
texts AS (SELECT descr AS t FROM he_items UNION ALL SELECT maker_text FROM he_items),
{token_hits('texts', 't')}, {token_resolve()},
he2 AS (SELECT i.*, mk.m_keyword AS manufacturer, dk.model AS model, {truthy('wwl')} AS has_wwl,
          {swl_cols('wwl', swl.CENTURION_DEPLOYED, 'p_')}
        FROM he_items i LEFT JOIN thr dk ON dk.d = i.descr LEFT JOIN thr mk ON mk.d = i.maker_text),
he3 AS (SELECT *, {lst(('manufacturer IS NULL', q(C.MANUFACTURER_NOT_FOUND)), ('model IS NULL', q(C.MODEL_NOT_FOUND)),
                       (f"has_wwl AND NOT ({truthy('p_swl_value')})", q(C.SWL_VALUE_NOT_FOUND)),
                       (f"has_wwl AND NOT ({truthy('p_swl_unit')})", q(C.SWL_UNIT_NOT_FOUND_C)),
                       ('NOT has_wwl', q(C.SWL_NOT_FOUND_C)))} AS errs FROM he2),
he_exp AS (SELECT doc_id, page_no, 2 AS row_no, ident AS id_number, 0 AS id_idx,
             string_split(descr, ':')[1] AS item_description, model,
             CASE WHEN has_wwl THEN nullif(p_swl_value, '') END AS swl_value,
             CASE WHEN has_wwl THEN p_swl_unit END AS swl_unit, CASE WHEN has_wwl THEN p_swl_note END AS swl_note,
             manufacturer, cert AS certificate_no, prev AS previous_inspection,
             CAST(NULL AS VARCHAR) AS next_inspection_due_date, CAST(NULL AS VARCHAR) AS provider_identification,
             {render_errors('errs')} AS errors FROM he3)
{last_wins_sql('he_exp')}""")


SQL["extract_hendrik"] = _hendrik()


def _fi_register() -> str:
    item_row = ("CASE WHEN l_linenumber % 2 = 0 THEN '(AB) ' ELSE '' END || 'TZW' || CAST(l_suppkey AS VARCHAR) || ' ' "
                "|| description || ' (' || CAST(l_partkey AS VARCHAR) || ') ' || CAST(qty AS VARCHAR) || '.0 Tonnes'")
    ref_row = ("'Report Ref No ABC/' || lpad(CAST(l_orderkey AS VARCHAR), 6, '0') || '/' || "
               "lpad(CAST(l_partkey AS VARCHAR), 5, '0') || ' ' || 'Date of thorough examination ' || date_text")
    return with_fx(f""", {dict_ctes()}, {PAGED},
fr AS (SELECT doc_id, page_no, 1 AS row_no, coalesce({item_row}, '') || ' ' || date_text AS t, {ref_row} AS ref FROM paged
       UNION ALL SELECT doc_id, page_no, 2, 'TZX' || CAST(l_partkey AS VARCHAR) || ' spare ring (' ||
         CAST(l_suppkey AS VARCHAR) || ') ' || CAST(qty AS VARCHAR) || '.5 Kilos ' || date_text, {ref_row}
       FROM paged WHERE l_linenumber % 3 <> 0),
fr1 AS (SELECT *, regexp_extract(t, {pat(fields.REGISTER_ID)}, 0) AS m_id,
          regexp_extract(t, {pat(swl.REGISTER_CAPACITY)}, 0) AS m_cap,
          {nz(f"regexp_extract(ref, {pat(ANY_DATE)}, 0)")} AS prev,
          {nz(f"regexp_extract(ref, {pat(fields.REPORT_REF)}, 0)")} AS cert,
          {nz(f"regexp_extract(t, {pat(ROW_END_DATE)}, 1)")} AS next_date FROM fr),
fr2 AS (SELECT *, strpos(t, m_id) - 1 + length(m_id) AS id_end FROM fr1 WHERE m_id <> ''),
fr3 AS (SELECT *, regexp_replace({strip(
        "CASE WHEN (CASE WHEN m_cap <> '' THEN strpos(t, m_cap) - 1 ELSE length(t) END) > id_end THEN "
        "substr(t, id_end + 1, (CASE WHEN m_cap <> '' THEN strpos(t, m_cap) - 1 ELSE length(t) END) - id_end) "
        "ELSE '' END")}, '\\([^)]*\\)\\s*', '', 'g') AS descr, nullif(m_cap, '') AS cap FROM fr2),
hit AS (SELECT descr, arg_min({{'f': manufacturer, 'm': model}}, ord) AS s FROM (SELECT DISTINCT descr FROM fr3)
        JOIN dd ON dd.model <> '' AND contains(lower(descr), lower(dd.model)) GROUP BY descr),
fr4 AS (SELECT fr3.*, nullif(hit.s.f, '') AS manufacturer, nullif(hit.s.m, '') AS model,
          {swl_cols('cap', swl.FIRST_INTEGRATED, 'p_')} FROM fr3 LEFT JOIN hit ON hit.descr = fr3.descr),
fr5 AS (SELECT *, {lst((f"NOT ({truthy('descr')})", q(C.DESCRIPTION_NOT_FOUND)),
                       ('manufacturer IS NULL', q(C.MANUFACTURER_NOT_FOUND)),
                       ('model IS NULL', q(C.MODEL_NOT_FOUND)))} AS base FROM fr4),
fr_exp AS (SELECT doc_id, page_no, row_no, m_id AS id_number, 0 AS id_idx,
             CASE WHEN {truthy('descr')} THEN descr END AS item_description, model,
             p_swl_value AS swl_value, p_swl_unit AS swl_unit, p_swl_note AS swl_note, manufacturer,
             cert AS certificate_no, prev AS previous_inspection, next_date AS next_inspection_due_date,
             CAST(NULL AS VARCHAR) AS provider_identification,
             {render_errors(f"CASE WHEN len(base) > 0 THEN list_concat(base, [{q(C.FOR_ID_PREFIX)} || m_id]) ELSE base END")}
             AS errors FROM fr5)
{last_wins_sql('fr_exp')}""")


SQL["extract_fi_register"] = _fi_register()


WLL_CELL = "CAST(qty AS VARCHAR) || ' TONNES'"


def _fi_declaration(kind: str = "declaration") -> str:
    """X7 (declaration) and X6 (cells) over the derived First Integrated grids."""
    if kind == "declaration":
        wll, cert, nxt, where = (WLL_CELL, "'CN' || CAST(l_partkey AS VARCHAR)",
                                 "strftime(try_strptime(decl, '%d/%m/%Y') + INTERVAL 180 DAY, '%d/%m/%Y')", "true")
    else:
        wll, cert, nxt, where = ("CAST(qty AS VARCHAR) || ' TONNE'", "'RN' || CAST(l_orderkey AS VARCHAR)", "decl",
                                 "description IS NOT NULL")
    a_pat, b_pat = "'^([A-Za-z]+)(\\d+)-(\\d+)'", "'^([A-Za-z]+\\d+/?\\d*)/(\\d+)-(\\d+)'"

    def padded(x):
        return (f"CASE WHEN length(CAST({x} AS VARCHAR)) < pad THEN lpad(CAST({x} AS VARCHAR), pad, '0') "
                f"ELSE CAST({x} AS VARCHAR) END")
    return with_fx(f""", {dict_ctes()}, {PAGED},
fd AS (SELECT doc_id, page_no, {strip('range_text')} AS s,
         CASE WHEN description IS NOT NULL THEN {strip('description')} END AS descr,
         {nz(f"regexp_extract({strip(wll)}, {pat(swl.TONNE_CAPACITY)}, 0)")} AS cap,
         {strip(cert)} AS cert, date_text AS decl FROM paged WHERE {where}),
fd2 AS (SELECT *, contains(s, '-') AND regexp_matches(s, {a_pat}) AS a_ok,
          contains(s, '-') AND regexp_matches(s, {b_pat}) AS b_ok FROM fd),
fd3 AS (SELECT *,
    CASE WHEN a_ok THEN regexp_extract(s, {a_pat}, 1) WHEN b_ok THEN regexp_extract(s, {b_pat}, 1) || '/' ELSE s END
      AS pre,
    CASE WHEN a_ok THEN CAST(regexp_extract(s, {a_pat}, 2) AS HUGEINT)
         WHEN b_ok THEN CAST(regexp_extract(s, {b_pat}, 2) AS HUGEINT) END AS st,
    CASE WHEN a_ok THEN CAST(regexp_extract(s, {a_pat}, 3) AS HUGEINT)
         WHEN b_ok THEN CAST(regexp_extract(s, {b_pat}, 3) AS HUGEINT) END AS en,
    CASE WHEN b_ok AND NOT a_ok THEN 2 ELSE 0 END AS pad FROM fd2),
fd4 AS (SELECT *, CASE WHEN st IS NULL THEN 1 WHEN en < st THEN 1 ELSE en - st + 1 END AS n,
          CASE WHEN en < st THEN 'Error: End of range (' || CAST(en AS VARCHAR) || ') is less than start of range ('
            || CAST(st AS VARCHAR) || ') for ID number ' || s END AS range_error FROM fd3),
hit AS (SELECT descr, arg_min({{'f': manufacturer, 'm': model}}, ord) AS hs FROM (SELECT DISTINCT descr FROM fd4)
        JOIN dd ON dd.model <> '' AND contains(lower(descr), lower(dd.model)) GROUP BY descr),
fd5 AS (SELECT fd4.*, nullif(hit.hs.f, '') AS manufacturer, nullif(hit.hs.m, '') AS model,
          {swl_cols('cap', swl.FIRST_INTEGRATED, 'p_')} FROM fd4 LEFT JOIN hit ON hit.descr = fd4.descr),
fd6 AS (SELECT *, list_concat({lst(('descr IS NOT NULL AND manufacturer IS NULL', q(C.MANUFACTURER_NOT_FOUND)),
                                   ('descr IS NOT NULL AND model IS NULL', q(C.MODEL_NOT_FOUND)))},
          CASE WHEN range_error IS NOT NULL THEN [range_error] ELSE [] END) AS base,
          CASE WHEN st IS NULL THEN pre ELSE pre || {padded('st + n - 1')} END AS last_id FROM fd5),
fd7 AS (SELECT *, unnest(range(CAST(n AS BIGINT))) AS i FROM fd6),
fd_exp AS (SELECT doc_id, page_no, 0 AS row_no, CASE WHEN st IS NULL THEN pre ELSE pre || {padded('st + i')} END
             AS id_number, i AS id_idx, descr AS item_description, model, p_swl_value AS swl_value,
             p_swl_unit AS swl_unit, p_swl_note AS swl_note, manufacturer, cert AS certificate_no,
             decl AS previous_inspection,
             {nxt} AS next_inspection_due_date,
             CAST(NULL AS VARCHAR) AS provider_identification,
             {render_errors(f"CASE WHEN len(base) > 0 THEN list_concat(base, [{q(C.FOR_ID_PREFIX)} || last_id]) ELSE base END")}
             AS errors FROM fd7)
{last_wins_sql('fd_exp')}""")


SQL["extract_fi_declaration"] = _fi_declaration("declaration")
SQL["extract_fi_cells"] = _fi_declaration("cells")
SQL["certificate_pipeline"] += f"""
UNION ALL
SELECT 'H-' || doc_id AS doc_id, {_ITEM_COLS} FROM ({SQL['extract_hendrik']})
UNION ALL
SELECT 'F-' || doc_id AS doc_id, {_ITEM_COLS} FROM ({SQL['extract_fi_cells']})
UNION ALL
SELECT 'Q-' || doc_id AS doc_id, {_ITEM_COLS} FROM ({SQL['extract_centurion_qty']})
UNION ALL
SELECT 'R-' || doc_id AS doc_id, {_ITEM_COLS} FROM ({SQL['extract_fi_register']})
UNION ALL
SELECT 'P-' || doc_id AS doc_id, {_ITEM_COLS} FROM ({SQL['extract_fi_declaration']})"""


def _with_row(src: str) -> str:
    """The same items with the grid row of their first appearance (register pages hold several items)."""
    for a, b in (("w.first_page, w.first_idx", "w.first_page, w.first_row, w.first_idx"),
                 ("'first_page': page_no, 'first_idx'", "'first_page': page_no, 'first_row': row_no, 'first_idx'"),
                 ("id_number, first_page, first_idx", "id_number, first_page, first_row, first_idx")):
        src = src.replace(a, b)
    return src


def _sheet(src: str) -> str:
    return f"""
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY first_page, first_row, first_idx) + 2 AS sheet_row,
  id_number AS "Id Number", errors AS "Errors" FROM ({src})"""


SQL["stream_ingest"] = _sheet(_with_row(SQL["certificate_pipeline"]))
SQL["stream_overwrite"] = _sheet(_with_row(SQL["extract_sparrow"]))
