"""ID expressions (G1-G6) parsed into *segments*, without fanning out.

An ID expression such as ``D971-1 to 6`` (with quantity 3) or ``TZW238-243``
names many item IDs.  Parsing never materialises them: it returns
``array<segment>`` where each segment stands for ``n`` consecutive IDs

    prefix + number(start + i, zero-padded to ``pad``) + suffix,  i in [0, n)

and a segment with ``start`` null is one literal ID (``prefix``).  Counting is
``segment_count`` (no expansion); the fan-out itself is the distributed
operator :func:`certloom.operators.expand.explode_ids`, which splits huge
ranges into chunks so one expression never has to sit in one task.

Result conventions (per the extraction rules):
  * ``null``  = the rules fail on this expression (the caller then keeps the raw
    expression as one ID and records an error, or drops the item, per layout);
  * ``[]``    = the rules produce no ID;
  * numbers are arbitrary precision in the rules: up to 37 digits they are
    carried whole as DECIMAL(38,0), longer ones as a text head in the prefix
    and the last 18 digits as the number; a range that needs more than that
    (its ends differ before the last 18 digits, or it has more than 2**63 IDs)
    keeps the raw text as one ID, with an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_, pystrip

NUM = "decimal(38,0)"
SEGMENT_TYPE = "struct<prefix:string,start:decimal(38,0),n:bigint,suffix:string,pad:int>"

# G6 patterns (anchored at the start only, like re.match).
ALPHA_RANGE = r"^([A-Za-z]+)(\d+)-(\d+)"
SLASH_RANGE = r"^([A-Za-z]+\d+/?\d*)/(\d+)-(\d+)"
RANGE_ERROR = "Error: End of range ({end}) is less than start of range ({start}) for ID number {id}"


RANGE_TOO_LONG = "Error: range too long to expand for ID number {id}"
WHOLE, TAIL = 37, 18  # digits carried whole; digits of the tail of a longer number


def segment(prefix, start, n, suffix=None, pad=0) -> Column:
    return F.struct(
        col_(prefix).cast("string").alias("prefix"),
        (F.lit(None) if start is None else col_(start)).cast(NUM).alias("start"),
        col_(n).cast("bigint").alias("n"),
        (F.lit("") if suffix is None else col_(suffix)).cast("string").alias("suffix"),
        (F.lit(pad) if isinstance(pad, int) else pad).cast("int").alias("pad"),
    )


def _bind(value, fn) -> Column:
    """``fn(value)`` with the value evaluated once, as a lambda variable."""
    return F.get(F.transform(F.array(value), fn), 0)


def number(digits) -> Column:
    """``struct<head, tail, pad>`` of a digit string, leading zeros dropped;
    null without digits."""
    d = col_(digits)
    short = F.ltrim(d, F.lit("0"))
    # the last zero of a number stays
    return _bind(F.when(short == "", F.substring(d, -1, 1)).otherwise(short), _number)


def _number(d) -> Column:
    long = F.length(d) > WHOLE
    return F.when(F.length(d) > 0, F.when(long, F.struct(
        d.substr(F.lit(1), F.length(d) - TAIL).alias("head"), F.right(d, F.lit(TAIL)).try_cast(NUM).alias("tail"),
        F.lit(TAIL).alias("pad"))).otherwise(F.struct(
            F.lit("").alias("head"), d.try_cast(NUM).alias("tail"), F.lit(0).alias("pad"))))


def literal_segment(s) -> Column:
    return segment(s, None, F.lit(1))


def literal_ids(s) -> Column:
    """One literal ID."""
    return F.array(literal_segment(s))


def _digits(s) -> Column:
    return F.regexp_replace(col_(s), "[^0-9]+", "")


def id_parts(s, quantity, before=None) -> Column:
    """G1: ``MGL1`` with quantity 3 -> MGL1, MGL2, MGL3; ``before``: text that goes before each ID.

    All digits of the string form the number (leading zeros dropped); the
    non-digit text sits before the number unless the string starts with a digit.
    """
    q = col_(quantity).cast("bigint")
    empty = F.array().cast(f"array<{SEGMENT_TYPE}>")

    # each step is bound once as a lambda variable, so that no expression is copied into the next
    def with_digits(x):
        return F.struct(x["s"].alias("s"), x["before"].alias("before"), _digits(x["s"]).alias("d"))

    def with_number(x):
        return F.struct(x["s"].alias("s"), x["before"].alias("before"), F.length(x["d"]).alias("nd"),
                        number(x["d"]).alias("base"), x["s"].substr(1, 1).between("0", "9").alias("first"))

    def parts(x):
        s, nd, base = x["s"], x["nd"], x["base"]
        fits = (base["pad"] == 0) | (base["tail"] + q <= F.lit(10**TAIL))
        prefix = F.when(x["first"], F.lit("")).otherwise(s.substr(F.lit(1), F.length(s) - nd))
        suffix = F.when(x["first"], s.substr(nd + 1, F.lit(1 << 30))).otherwise(F.lit(""))
        return F.when(base.isNotNull() & fits, F.array(segment(
            F.concat(x["before"], prefix, base["head"]), base["tail"], q, suffix, base["pad"])))

    given = F.filter(F.array(F.struct(col_(s).alias("s"), (F.lit("") if before is None else before).alias("before"))),
                     lambda x: x["s"].isNotNull() & (F.length(x["s"]) > 0))
    found = F.get(F.transform(F.transform(F.transform(given, with_digits), with_number), parts), 0)
    return F.when(q > 0, found).when(q.isNotNull() & (F.length(s) > 0), empty)


def id_to_range(s, quantity) -> Column:
    """``D971-1 to 6`` / ``MGL1 to MGL36``: the upper end is ignored and the
    quantity drives the count.  The ``to`` split is case-sensitive."""
    def of(first):
        parts = F.split(first, "-")
        return F.when(first.contains("-"), F.when(F.size(parts) == 2, F.struct(
            F.concat(F.get(parts, 0), F.lit("-")).alias("before"), F.get(parts, 1).alias("s")))).otherwise(
                F.struct(F.lit("").alias("before"), first.alias("s")))
    return _bind(_bind(pystrip(F.substring_index(col_(s), "to", 1)), of), lambda x: id_parts(x["s"], quantity, x["before"]))


def id_multiplier(s) -> Column:
    """``AB12 x3, CD9 x2`` -> AB12-1..3, CD9-1..2.  Every piece needs an ``x``."""
    def read(xs):
        return F.struct(pystrip(F.get(xs, 0)).alias("ident"), _digits(F.get(xs, 1)).alias("d"))

    def counted(x):
        return F.struct(x["ident"].alias("ident"), F.coalesce(x["d"] != "", F.lit(False)).alias("ok"),
                        x["d"].try_cast(NUM).try_cast("bigint").alias("n"))

    def piece_segment(x):
        ident = F.when(x["ident"].rlike("[0-9]"), F.regexp_extract(x["ident"], r"(?s)^(.*[0-9])", 1)).otherwise(x["ident"])
        return segment(F.concat(ident, F.lit("-")), F.lit(1), x["n"])

    pieces = F.transform(F.transform(F.transform(F.split(col_(s), ","), lambda p: F.split(p, "x")), read), counted)
    return _bind(pieces, lambda ps: F.when(F.forall(ps, lambda x: x["ok"] & x["n"].isNotNull()), F.transform(
        ps, piece_segment)))


def id_comma(s) -> Column:
    """Comma list; pieces are *not* trimmed."""
    return F.transform(F.split(col_(s), ","), literal_segment)


def _python_int(s) -> Column:
    """``int(text)``: optional sign and surrounding whitespace; else null."""
    t = pystrip(s)
    return F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast(NUM))


def id_dash_range(s) -> Column:
    """G5 (local Centurion rules): ``ABC1-5`` -> ABC1..ABC5 using the *last
    digit* before the dash as the start.  Not applicable (``[]``) when the text
    is all digits and dashes; three or more parts give the text as one ID."""
    s = col_(s)
    parts = F.split(s, "-")
    p0, p1 = F.get(parts, 0), F.get(parts, 1)
    last = p0.substr(F.length(p0), F.lit(1))
    start = F.when((F.length(p0) > 0) & last.rlike("^[0-9]$"), last.try_cast(NUM))
    end = _python_int(p1)
    count = F.greatest(end - start + 1, F.lit(0).cast(NUM)).try_cast("bigint")
    prefix = p0.substr(F.lit(1), F.length(p0) - 1)
    two = F.when(start.isNotNull() & count.isNotNull(), F.array(segment(prefix, start, count)))
    return F.when(F.size(parts) == 2, two).otherwise(F.array(literal_segment(pystrip(s))))


def dash_range_applies(s) -> Column:
    s = col_(s)
    return s.contains("-") & ~F.replace(s, F.lit("-"), F.lit("")).rlike(r"^[0-9]+$")


def id_expression(s, quantity, variant: str = "sparrow") -> Column:
    """G2-G5 dispatch in rule order: ``to`` (case-insensitive test), then
    ``x<digits>``, then comma (and/or dash, per ``variant``).

    variant: ``sparrow`` (to, x, comma; nothing else fails),
             ``centurion`` (to, x, comma, dash; nothing else -> []),
             ``centurion_local`` (to, x, dash), ``centurion_deployed`` (to, x, comma).
    """
    s = col_(s)
    empty = F.array().cast(f"array<{SEGMENT_TYPE}>")
    chain = F.when(s.isNull(), F.lit(None)).when(F.lower(s).contains("to"), id_to_range(s, quantity)) \
        .when(s.rlike(r"x\d"), id_multiplier(s))
    if variant == "sparrow":
        return chain.when(s.contains(","), id_comma(s)).otherwise(F.lit(None))
    if variant == "centurion":
        return chain.when(s.contains(","), id_comma(s)).when(dash_range_applies(s), id_dash_range(s)).otherwise(empty)
    if variant == "centurion_local":
        return chain.when(dash_range_applies(s), id_dash_range(s)).otherwise(empty)
    if variant == "centurion_deployed":
        return chain.when(s.contains(","), id_comma(s)).otherwise(empty)
    raise ValueError(f"unknown id variant {variant!r}")


def id_hyphen_range(s) -> Column:
    """``TZW238-243`` -> TZW238..TZW243; ``X1/01-04`` -> X1/01..X1/04
    (zero-padded to two digits).  End < start gives the start ID plus an error.
    Returns ``struct<segments, errors>``; other text is one literal ID."""
    s = col_(s)
    trim = lambda d: F.regexp_replace(d, "^0+(?=.)", "")

    def parts(pattern, tail, pad):
        return F.struct(F.concat(F.regexp_extract(s, pattern, 1), F.lit(tail)).alias("pre"),
                        trim(F.regexp_extract(s, pattern, 2)).alias("x"),
                        trim(F.regexp_extract(s, pattern, 3)).alias("y"), F.lit(pad).alias("pad"))

    def with_numbers(g):
        down = (F.length(g["y"]) < F.length(g["x"])) | ((F.length(g["y"]) == F.length(g["x"])) & (g["y"] < g["x"]))
        return F.struct(g["pre"].alias("pre"), g["x"].alias("x"), g["y"].alias("y"), g["pad"].alias("pad"),
                        number(g["x"]).alias("start"), number(g["y"]).alias("end"), down.alias("down"))

    def with_count(g):
        n = F.when(g["down"], F.lit(1).cast("bigint")).when(
            g["start"]["head"] == g["end"]["head"], (g["end"]["tail"] - g["start"]["tail"] + 1).try_cast("bigint"))
        return F.struct(g.alias("g"), n.alias("n"))

    def rng(r):
        g, n = r["g"], r["n"]
        seg = segment(F.concat(g["pre"], g["start"]["head"]), g["start"]["tail"], n, None,
                      F.when(g["start"]["pad"] > 0, g["start"]["pad"]).otherwise(g["pad"]))
        down = F.array(F.concat(F.lit("Error: End of range ("), g["y"], F.lit(") is less than start of range ("),
                                g["x"], F.lit(") for ID number "), s))
        too_long = F.array(F.concat(F.lit(RANGE_TOO_LONG.split("{")[0]), s))
        return F.struct(F.array(F.when(n.isNull(), literal_segment(s)).otherwise(seg)).alias("segments"),
                        F.when(g["down"], down).when(n.isNull(), too_long).otherwise(
                            F.array().cast("array<string>")).alias("errors"))

    # each step is bound once as a lambda variable, so that no expression is copied into the next
    found = F.when(s.rlike(ALPHA_RANGE), parts(ALPHA_RANGE, "", 0)).when(
        s.rlike(SLASH_RANGE), parts(SLASH_RANGE, "/", 2))
    bound = F.filter(F.array(found), lambda g: g.isNotNull())
    ranges = F.transform(F.transform(F.transform(bound, with_numbers), with_count), rng)
    plain = F.struct(F.array(literal_segment(s)).alias("segments"),
                     F.array().cast("array<string>").alias("errors"))
    return F.when(s.isNotNull(), F.coalesce(F.get(ranges, 0), plain))


def segment_count(segs) -> Column:
    """Number of IDs an expression names, computed without expanding it."""
    return F.aggregate(col_(segs), F.lit(0).cast("bigint"), lambda acc, g: acc + g["n"])


def render_id(g, i, low=None) -> Column:
    """ID number ``i`` (0-based) of segment ``g``.  ``low``: its start as a bigint where every number of the segment
    is one (:func:`low_start`); these are counted without decimals."""
    num = (g["start"] + i).cast("string")
    if low is not None:
        num = F.when(low.isNotNull(), (low + i).cast("string")).otherwise(num)
    num = F.when(g["pad"] <= 0, num).when(F.length(num) < g["pad"], F.lpad(num, g["pad"], "0")).otherwise(num)
    return F.when(g["start"].isNull(), g["prefix"]).otherwise(F.concat(g["prefix"], num, g["suffix"]))


def low_start(start, n) -> Column:
    """``start`` as a bigint, null where it or the last number of the segment might not be one."""
    limit = 1 << 62
    return F.when((start >= F.lit(0).cast(NUM)) & (start < F.lit(str(limit)).cast(NUM)) & (n < F.lit(limit)),
                  start.cast("bigint"))


def last_id(segs) -> Column:
    """The last ID an expression names, by arithmetic (a range of any length is not listed); null without IDs."""
    named = F.filter(col_(segs), lambda g: g["n"] > 0)
    return F.get(F.transform(F.slice(named, -1, 1), lambda g: render_id(g, g["n"] - 1)), 0)


def render_ids(segs) -> Column:
    """Small-expression convenience: the whole ID list as one array.  The
    distributed path is ``operators.expand.explode_ids``."""
    return F.flatten(F.transform(col_(segs), lambda g: F.transform(
        F.when(g["n"] > 0, F.sequence(F.lit(0).cast("bigint"), g["n"] - 1)).otherwise(
            F.array().cast("array<bigint>")), lambda i: render_id(g, i))))
