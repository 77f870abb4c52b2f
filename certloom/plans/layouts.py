"""Layout extractors X1-X7 as row-local Column expressions.

Every extractor maps one page row ``(doc_id, page_no, text, tables)`` to

    struct<items: array<ITEM>, error: string>

without any shuffle, so all layouts run in the same scan (the pipeline picks
one per page with a ``when`` chain).  Dictionary lookups need a join, so an
ITEM carries the text to look up (``lookup_desc``/``lookup_mode``) and its
error list in pieces; :func:`finish_items` completes both after the join.

ITEM error list = err_head + dictionary errors (when ``dict_errors``) +
err_tail, then ``suffix_always`` and, if anything so far, ``suffix_if_any``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, fields, ids, swl, text
from ..functions.text import nullif_empty, pystrip, row_text, truthy
from ..operators.grids import cell_at, row_at
from . import messages as C

STR = "string"
ARR = "array<string>"
SEGS = f"array<{ids.SEGMENT_TYPE}>"

ITEM_FIELDS = [
    ("table_no", "int"), ("row_no", "int"),
    ("id_raw", STR), ("id_segments", SEGS),
    ("item_description", STR), ("lookup_desc", STR), ("lookup_mode", STR),
    ("maker_desc", STR), ("manufacturer", STR), ("model", STR),
    ("swl_value", STR), ("swl_unit", STR), ("swl_note", STR),
    ("certificate_no", STR), ("previous_inspection", STR), ("next_inspection_due_date", STR),
    ("provider_identification", STR),
    ("err_head", ARR), ("dict_errors", "boolean"), ("err_tail", ARR),
    ("suffix_always", ARR), ("suffix_if_any", ARR),
]
ITEM_TYPE = "struct<" + ",".join(f"{n}:{t}" for n, t in ITEM_FIELDS) + ">"
OUTCOME_TYPE = f"struct<items:array<{ITEM_TYPE}>,error:string>"


def item(**kw) -> Column:
    unknown = set(kw) - {n for n, _ in ITEM_FIELDS}
    if unknown:
        raise ValueError(f"unknown item fields {unknown}")
    cols = []
    for name, typ in ITEM_FIELDS:
        v = kw.get(name)
        if v is None:
            v = F.lit(False) if typ == "boolean" else (F.array().cast(typ) if typ.startswith("array") else F.lit(None))
        cols.append(v.cast(typ).alias(name))
    return F.struct(*cols)


def outcome(items=None, error=None) -> Column:
    return F.struct(
        (items if items is not None else F.array()).cast(f"array<{ITEM_TYPE}>").alias("items"),
        (error if error is not None else F.lit(None)).cast(STR).alias("error"))


def errs(*pairs) -> Column:
    """Ordered error list from (condition, text) pairs."""
    none = F.array().cast(ARR)
    return F.concat(none, *[F.when(cond, F.array(F.lit(msg) if isinstance(msg, str) else msg)).otherwise(none)
                            for cond, msg in pairs])


def _swl_struct(raw, profile):
    return swl.parse_swl(raw, profile)


class Steps:
    """Stands in for a page table while a layout is set up and keeps the columns it stages and drops, so that they are
    built once a session: a micro-batch then only applies them."""

    def __init__(self, columns):
        self.columns, self.steps = list(columns), []

    def apply(self, df: DataFrame) -> DataFrame:
        for staged, names in self.steps:
            df = df.select("*", *names) if staged else df.drop(*names)
        return df


def stage(df: DataFrame | Steps, **cols) -> DataFrame | Steps:
    """Add named intermediate columns.  Staging keeps each intermediate a
    column reference, so later expressions never copy a big sub-expression
    (Catalyst keeps the projections apart because they are not cheap)."""
    named = [c.alias(n) for n, c in cols.items()]
    if isinstance(df, Steps):
        df.steps.append((True, named))
        df.columns += list(cols)
        return df
    return df.select("*", *named)


def drop_prefix(df: DataFrame | Steps, prefix: str) -> DataFrame | Steps:
    names = [c for c in df.columns if c.startswith(prefix)]
    if isinstance(df, Steps):
        df.steps.append((False, names))
        df.columns = [c for c in df.columns if c not in names]
        return df
    return df.drop(*names)


def _last_nonnull(arr) -> Column:
    return F.try_element_at(F.filter(arr, lambda v: v.isNotNull()), F.lit(-1))


def _indices(arr) -> Column:
    return F.when(F.size(arr) > 0, F.sequence(F.lit(0), F.size(arr) - 1)).otherwise(F.array().cast("array<int>"))


def _bind(value, fn) -> Column:
    """``fn(value)`` with the value evaluated once, as a lambda variable."""
    return F.get(F.transform(F.array(value), fn), 0)


def _label_cells(hdr, *labels: str) -> Column:
    """The header cells that mention a label, in order: their index ``i`` and ``k0``, ``k1``, ...: which ones.  Each
    cell is lower-cased and searched once; a fold then only meets cells that can change its state."""
    low = F.transform(F.coalesce(hdr, F.array().cast(ARR)), F.lower)
    found = F.transform(low, lambda c, i: F.struct(i.alias("i"), *[c.contains(t).alias(f"k{n}") for n, t in enumerate(labels)]))
    return F.filter(found, lambda x: F.array_contains(F.array(*[x[f"k{n}"] for n in range(len(labels))]), True))


def _swl_fields(p, present=None):
    g = (lambda c: c) if present is None else (lambda c: F.when(present, c))
    return dict(swl_value=g(nullif_empty(p["value"])), swl_unit=g(p["unit"]), swl_note=g(p["note"]))


# ============================================================ X1: Sparrow
def sparrow_header_fold(hdr, val) -> Column:
    """P7 as the rules run it: header cells left to right, each cell feeds the
    first still-unset label it mentions (identification, description, swl,
    quantity); a value that fails to read leaves the label unset."""
    init = F.struct(F.lit(None).cast(STR).alias("ident"), F.lit(None).cast(STR).alias("desc"),
                    F.lit(None).cast(STR).alias("swl"), F.lit(None).cast("bigint").alias("qty"))

    def step(s, x):
        v = F.get(val, x["i"])
        which = (F.when(x["k0"] & ~truthy(s["ident"]), 0).when(x["k1"] & ~truthy(s["desc"]), 1)
                 .when(x["k2"] & ~truthy(s["swl"]), 2)
                 .when(x["k3"] & (s["qty"].isNull() | (s["qty"] == 0)), 3))
        return _bind(which, lambda w: F.struct(
            F.when(w == 0, F.coalesce(pystrip(v), s["ident"])).otherwise(s["ident"]).alias("ident"),
            F.when(w == 1, F.coalesce(text.newline_to_space(v), s["desc"])).otherwise(s["desc"]).alias("desc"),
            F.when(w == 2, F.coalesce(pystrip(v), s["swl"])).otherwise(s["swl"]).alias("swl"),
            F.when(w == 3, F.coalesce(fields.quantity_cell(v), s["qty"])).otherwise(s["qty"]).alias("qty")))

    return F.aggregate(_label_cells(hdr, "identification", "description", "swl", "quantity"), init, step)


def sparrow_outcome(df: DataFrame, out: str = "outcome", variant: str = "local", gate=None) -> DataFrame:
    """X1.  ``variant='deployed'`` only changes one error text (a final dot)."""
    tables, col = F.col("tables") if gate is None else F.when(gate, F.col("tables")), F.col
    d = stage(df, _sp_block=cell_at(tables, 0, 0, 0), _sp_rows=F.size(F.get(tables, 0)),
              _sp_f=sparrow_header_fold(row_at(tables, 0, 3), row_at(tables, 0, 4)))
    d = stage(d, _sp_p=swl.parse_swl(col("_sp_f.swl"), swl.SPARROW),
              _sp_l=fields.label_values(col("_sp_block"), "last", cert="reportnumber", prev="dateofthoroughexamination",
                                        job="jobnumber", next="duedateofnextthoroughexamination"),
              _sp_segs=F.when(col("_sp_f.qty").isNull(), F.lit(None).cast(SEGS)).when(
                  col("_sp_f.qty") > 1, ids.id_expression(col("_sp_f.ident"), col("_sp_f.qty"), "sparrow")
              ).otherwise(ids.literal_ids(col("_sp_f.ident"))))
    ident, desc, swl_raw, p = col("_sp_f.ident"), col("_sp_f.desc"), col("_sp_f.swl"), col("_sp_p")
    has_swl, has_desc = truthy(swl_raw), truthy(desc)
    cert, prev, job, nxt = (col(f"_sp_l.{n}") for n in ("cert", "prev", "job", "next"))
    failed = col("_sp_segs").isNull()
    page_tag = F.concat(F.lit(C.PAGE_NO_PREFIX), col("page_no").cast(STR))
    it = item(
        table_no=F.lit(0), row_no=F.lit(4), id_raw=ident,
        id_segments=F.coalesce(col("_sp_segs"), ids.literal_ids(ident)),
        item_description=F.when(has_desc, desc), lookup_desc=F.when(has_desc, desc),
        lookup_mode=F.when(has_desc, F.lit("token")),
        **_swl_fields(p, has_swl),
        certificate_no=cert, previous_inspection=prev,
        provider_identification=F.when(job.isNotNull(), text.provider_prefix(job)),
        next_inspection_due_date=nxt,
        err_head=errs((~has_desc, C.SPARROW_NO_DESCRIPTION)), dict_errors=has_desc,
        err_tail=errs(
            (has_swl & ~truthy(p["value"]), C.SWL_VALUE_NOT_FOUND),
            (has_swl & ~truthy(p["unit"]), C.SWL_UNIT_NOT_FOUND),
            (~has_swl, C.SWL_NOT_FOUND_DEPLOYED if variant == "deployed" else C.SWL_NOT_FOUND),
            (cert.isNull(), C.CERTIFICATE_NO_NOT_FOUND),
            (prev.isNull(), C.PREVIOUS_INSPECTION_NOT_FOUND),
            (job.isNull(), C.PROVIDER_NOT_FOUND),
            (nxt.isNull(), C.NEXT_DUE_NOT_FOUND)),
        suffix_always=F.when(failed, F.array(F.lit(C.ID_EXPANSION_FAILED), page_tag)).otherwise(
            F.array().cast(ARR)),
        suffix_if_any=F.when(~failed, F.array(page_tag)).otherwise(F.array().cast(ARR)),
    )
    bad_shape = col("_sp_block").isNull() | (col("_sp_rows") < 5)
    o = (F.when(tables.isNull() | (F.size(tables) == 0), outcome(error=F.lit(C.NO_TEXT_ON_PAGE)))
         .when(bad_shape, outcome(error=F.lit(C.PAGE_SHAPE_ERROR)))
         .when(~truthy(ident), outcome(error=F.lit(C.NO_IDS_ON_PAGE)))
         .otherwise(outcome(items=F.array(it))))
    return drop_prefix(stage(d, **{out: o}), "_sp_")


# ============================================================ X2/X3: Centurion
# Header phrases of the two layouts.
CENTURION_SINGLE = "Quantity & Description of Equipment, Serial Numbers"
CENTURION_QTY = "Qty, Description of Equipment, Serial Numbers"


def centurion_header_fold(hdr, val, qty_layout: bool) -> Column:
    """Header row 2 against value row 4: description (cell 0, or its own cell in
    the quantity layout), working load, next date, certificate cell."""
    init = F.struct(F.lit(None).cast(STR).alias("desc"), F.lit(None).cast("int").alias("desc_idx"),
                    F.lit(None).cast("int").alias("desc_at"),
                    F.lit(None).cast(STR).alias("wwl"), F.lit(None).cast(STR).alias("next"),
                    F.lit(None).cast(STR).alias("cert"))

    def step(s, x):
        i = x["i"]
        v = F.get(val, i)
        dsrc = v if qty_layout else F.get(val, 0)
        which = (F.when(x["k0"] & ~truthy(s["desc"]), 0).when(x["k1"] & ~truthy(s["wwl"]), 1)
                 .when(x["k2"] & ~truthy(s["next"]), 2).when(x["k3"] & ~truthy(s["cert"]), 3))
        return _bind(which, lambda w: F.struct(
            F.when(w == 0, F.coalesce(text.newline_to_space(dsrc), s["desc"])).otherwise(s["desc"]).alias("desc"),
            F.when((w == 0) & dsrc.isNotNull(), i).otherwise(s["desc_idx"]).alias("desc_idx"),
            F.when(w == 0, i).otherwise(s["desc_at"]).alias("desc_at"),
            F.when(w == 1, F.coalesce(pystrip(v), s["wwl"])).otherwise(s["wwl"]).alias("wwl"),
            F.when(w == 2, F.coalesce(dates.date_normalise(pystrip(v)), s["next"])).otherwise(s["next"]).alias("next"),
            F.when(w == 3, F.coalesce(pystrip(v), s["cert"])).otherwise(s["cert"]).alias("cert")))

    return F.aggregate(_label_cells(hdr, "description", "working", "next", "certificate"), init, step)


def centurion_outcome(df: DataFrame, out: str = "outcome", id_variant: str = "centurion", gate=None,
                      variant: str = "local") -> DataFrame:
    """X2 / X3 (page text holds ``Centurion`` and not ``Hendrik``).

    ``variant`` picks the unit list and the serial rule, ``id_variant`` the ID
    chain.  Certificate number = report number (D5); serials from the whole row
    5, whitespace removed (F8), or, deployed, the text after the last colon of
    the description's cell in row 5 (F9); item errors are output (D4); a page the rules
    cannot read becomes a page error (D10); quantity 1 or an expression with no
    rule keeps the raw serial text as one ID (D3)."""
    tables, col = F.col("tables"), F.col
    gate = F.lit(True) if gate is None else gate
    hdr, val = row_at(tables, 0, 2), row_at(tables, 0, 4)
    d = stage(df,
              _ce_kind=F.when(~gate, F.lit(None).cast(STR))
              .when(F.coalesce(F.get(hdr, 0).contains(CENTURION_SINGLE), F.lit(False)), F.lit("single"))
              .when(F.coalesce(F.get(hdr, 0).contains(CENTURION_QTY), F.lit(False)), F.lit("qty")))
    on = col("_ce_kind").isNotNull()
    d = stage(d,
              _ce_clean=F.when(on, fields.serial_clean(text.row_text_nonnull(row_at(tables, 0, 5)))),
              _ce_block=cell_at(tables, 0, 0, 13), _ce_rows=F.size(F.get(tables, 0)),
              _ce_maker=pystrip(F.get(val, 4)), _ce_val=val)
    d = stage(d, _ce_f=F.when(col("_ce_kind") == "qty", centurion_header_fold(hdr, val, True))
              .when(on, centurion_header_fold(hdr, val, False)),
              _ce_l=fields.label_values(F.when(on, col("_ce_block")), "first", provider="custrefpono",
                                        cert="reportnumber", prev="dateofexamination"))
    deployed = fields.serial_last_segment(F.get(row_at(tables, 0, 5), col("_ce_f.desc_at")))
    d = stage(d, _ce_serials=F.when(on, deployed) if variant == "deployed" else col("_ce_clean"))
    qty_layout = col("_ce_kind") == "qty"
    d = stage(d, _ce_q=F.when(qty_layout, fields.extract_quantity(F.get(col("_ce_val"), col("_ce_f.desc_idx")))),
              _ce_p=swl.parse_swl(col("_ce_f.wwl"), swl.CENTURION_DEPLOYED if variant == "deployed"
                                  else swl.CENTURION_LOCAL))
    d = stage(d, _ce_expr=F.when(qty_layout & (col("_ce_q") > 1),
                                 ids.id_expression(col("_ce_serials"), col("_ce_q"), id_variant)))
    serials, q, expr = col("_ce_serials"), col("_ce_q"), col("_ce_expr")
    segs = F.when(~qty_layout, ids.literal_ids(serials)).when(q.isNull(), F.lit(None).cast(SEGS)).when(
        q > 1, F.when(F.size(expr) == 0, ids.literal_ids(serials)).otherwise(expr)).otherwise(ids.literal_ids(serials))
    d = stage(d, _ce_segs=segs)
    desc, wwl, p, maker = col("_ce_f.desc"), col("_ce_f.wwl"), col("_ce_p"), col("_ce_maker")
    has_desc, has_wwl = truthy(desc), truthy(wwl)
    provider, cert, prev = (col(f"_ce_l.{n}") for n in ("provider", "cert", "prev"))
    it = item(
        table_no=F.lit(0), row_no=F.lit(4), id_raw=serials, id_segments=col("_ce_segs"),
        item_description=F.when(has_desc, F.substring_index(desc, ":", 1)),
        lookup_desc=F.when(has_desc, desc), lookup_mode=F.when(has_desc, F.lit("model_only")),
        manufacturer=F.when(has_desc, nullif_empty(maker)),
        **_swl_fields(p, has_wwl),
        certificate_no=cert, previous_inspection=prev, next_inspection_due_date=col("_ce_f.next"),
        provider_identification=provider,
        err_head=errs((has_desc & ~qty_layout & ~truthy(maker), C.MANUFACTURER_NOT_FOUND)),
        dict_errors=has_desc & ~qty_layout,
        err_tail=errs(
            (has_wwl & ~truthy(p["value"]), C.SWL_VALUE_NOT_FOUND),
            (has_wwl & ~truthy(p["unit"]), C.SWL_UNIT_NOT_FOUND_C),
            (~has_wwl, C.SWL_NOT_FOUND_C)))
    missing = provider.isNull() | cert.isNull() | prev.isNull()
    shape_ok = (col("_ce_rows") >= 6) & col("_ce_block").isNotNull()
    o = (F.when(tables.isNull() | (F.size(tables) == 0), outcome())
         .when(~shape_ok, outcome(error=F.lit(C.PAGE_SHAPE_ERROR)))
         .when(col("_ce_kind").isNull(), outcome())
         .when(~truthy(col("_ce_f.cert")), outcome())
         .when(~has_desc, outcome(error=F.lit(C.CENTURION_NO_SERIALS)))
         .when(missing, outcome(error=F.lit(C.CENTURION_LABELS_MISSING)))
         .when(col("_ce_segs").isNull(), outcome(error=F.lit(C.ID_EXPRESSION_ERROR)))
         .otherwise(outcome(items=F.array(it))))
    return drop_prefix(stage(d, **{out: o}), "_ce_")


# ============================================================ X4: Hendrik
def hendrik_outcome(df: DataFrame, out: str = "outcome", gate=None) -> DataFrame:
    """X4 (deployed rules).  Model = the model keyword (D1); errors per page."""
    col = F.col
    tables = F.col("tables") if gate is None else F.when(gate, F.col("tables"))
    r2, r3, r9, r10, r14 = (row_at(tables, 0, i) for i in (2, 3, 9, 10, 14))
    d = stage(df, _he_cert=fields.certificate_search(col("text"), "certificate_no"),
              _he_id=fields.id_after_paren(F.get(r2, 0)),
              _he_wwl=swl.capacity_search(F.get(r3, 0), "hendrik"),
              _he_prev=dates.date_search(F.get(r14, 0), "dashed"),
              _he_didx=F.get(F.filter(_indices(r9), lambda i: F.coalesce(
                  F.lower(F.get(r9, i)).contains("description"), F.lit(False))), 0),
              _he_r10=r10, _he_rows=F.size(F.get(tables, 0)),
              _he_ok=F.get(r2, 0).isNotNull() & F.get(r3, 0).isNotNull() & F.get(r14, 0).isNotNull())
    d = stage(d, _he_desc=text.newline_to_space(F.get(col("_he_r10"), col("_he_didx"))),
              _he_p=swl.parse_swl(col("_he_wwl"), swl.CENTURION_DEPLOYED))
    desc, wwl, p, ident = col("_he_desc"), col("_he_wwl"), col("_he_p"), col("_he_id")
    has_desc, has_wwl = truthy(desc), truthy(wwl)
    it = item(
        table_no=F.lit(0), row_no=F.lit(2), id_raw=ident, id_segments=ids.literal_ids(ident),
        item_description=F.substring_index(desc, ":", 1), lookup_desc=desc, lookup_mode=F.lit("keyword"),
        maker_desc=F.get(col("_he_r10"), 2),
        **_swl_fields(p, has_wwl),
        certificate_no=col("_he_cert"), previous_inspection=col("_he_prev"),
        dict_errors=F.lit(True),
        err_tail=errs(
            (has_wwl & ~truthy(p["value"]), C.SWL_VALUE_NOT_FOUND),
            (has_wwl & ~truthy(p["unit"]), C.SWL_UNIT_NOT_FOUND_C),
            (~has_wwl, C.SWL_NOT_FOUND_C)))
    shape_ok = (col("_he_rows") >= 15) & col("_he_ok") & (
        col("_he_didx").isNull() | F.get(col("_he_r10"), col("_he_didx")).isNotNull())
    o = (F.when(tables.isNull() | (F.size(tables) == 0) | ~shape_ok, outcome(error=F.lit(C.PAGE_SHAPE_ERROR)))
         .when(truthy(ident) & has_desc, outcome(items=F.array(it)))
         .otherwise(outcome()))
    return drop_prefix(stage(d, **{out: o}), "_he_")


# ============================================================ First Integrated
# First-row phrases of the three layouts.
FI_REGISTER = "Name & Address of employer for Whom the examination was made"
FI_CELLS = "Date of Thorough Examination"
FI_DECLARATION = ("Name &AddressofManufacturer", "Name & Address of Manufacturer")
FI_LAYOUTS = {"fi_register": [FI_REGISTER], "fi_cells": [FI_CELLS], "fi_declaration": list(FI_DECLARATION)}


def fi_lookup_mode(variant: str) -> Column:
    return F.lit("substring" if variant == "local" else "token")


def _fi_register(d: DataFrame, variant: str, compat: bool) -> DataFrame:
    """Every row (of every table) that holds a register ID is an item;
    certificate and previous-inspection dates are the page's last values and
    are stamped on all its items (J7 inside the row).  Errors are the row's own
    (D6 fixed; ``running_errors`` gives the leaking form)."""
    col = F.col
    d = stage(d, _r_flat=F.flatten(F.transform(F.when(col("_fi_kind") == "fi_register", col("tables")), lambda tbl, t: F.transform(
        tbl, lambda row, r: F.struct(t.alias("t"), r.alias("r"), row_text(row).alias("rt"))))))
    low = lambda s, k: F.lower(s).contains(k.lower())
    d = stage(d, _r_prev=_last_nonnull(F.transform(col("_r_flat"), lambda x: F.when(
        low(x["rt"], "Date of thorough examination"), dates.date_search(x["rt"], "anywhere")))),
        _r_cert=_last_nonnull(F.transform(col("_r_flat"), lambda x: F.when(
            low(x["rt"], "Report Ref No"), fields.certificate_search(x["rt"], "report_ref")))),
        _r_rows=F.filter(col("_r_flat"), lambda x: ~x["rt"].contains("Name & Address of employer") &
                         x["rt"].rlike(fields.REGISTER_ID)))
    d = stage(d, _r_parsed=F.transform(col("_r_rows"), lambda x: F.struct(
        x["t"].alias("t"), x["r"].alias("r"), fields.id_search(x["rt"]).alias("ident"),
        swl.parse_swl(swl.capacity_search(x["rt"], "register"), swl.FIRST_INTEGRATED).alias("p"),
        fields.between_matches(x["rt"], compat=compat).alias("desc"),
        dates.date_search(x["rt"], "row_end").alias("next"))))

    def to_item(x):
        has_desc = truthy(x["desc"])
        return item(
            table_no=x["t"], row_no=x["r"], id_raw=x["ident"], id_segments=ids.literal_ids(x["ident"]),
            item_description=F.when(has_desc, x["desc"]), lookup_desc=x["desc"], lookup_mode=fi_lookup_mode(variant),
            swl_value=x["p"]["value"], swl_unit=x["p"]["unit"], swl_note=x["p"]["note"],
            certificate_no=col("_r_cert"), previous_inspection=col("_r_prev"), next_inspection_due_date=x["next"],
            err_head=errs((~has_desc, C.DESCRIPTION_NOT_FOUND)), dict_errors=F.lit(True),
            suffix_if_any=F.array(F.concat(F.lit(C.FOR_ID_PREFIX), x["ident"])))

    return stage(d, _fi_register=F.when(F.size(col("_r_parsed")) > 0, outcome(
        items=F.transform(col("_r_parsed"), to_item))).otherwise(outcome(error=F.lit(C.NO_IDS_ON_PAGE))))


def _cells_in_order(tbl):
    return F.flatten(F.transform(F.coalesce(tbl, F.array()), lambda row, r: F.transform(
        row, lambda cell, c: F.struct(r.alias("r"), c.alias("c"), cell.alias("v")))))


def _fi_ranges(id_texts):
    return F.transform(id_texts, lambda v: F.when(v.contains("-"), ids.id_hyphen_range(v)).otherwise(
        F.struct(ids.literal_ids(v).alias("segments"), F.array().cast(ARR).alias("errors"))))


def _fi_cells(d: DataFrame, variant: str) -> DataFrame:
    """One shared record per page (fields found anywhere on the page apply
    to every ID on it); each ``identification of the equipment`` cell names
    IDs (G6 ranges).  Per cell the first matching label wins."""
    col = F.col
    d = stage(d, _c_cells=F.transform(F.filter(_cells_in_order(F.when(col("_fi_kind") == "fi_cells", F.get(
        col("tables"), 0))), lambda x: truthy(x["v"])),
                                      lambda x: F.struct(x["v"].alias("v"), F.when(
                                          x["v"].contains("identification of the equipment"), F.lit("ident"))
                                          .when(x["v"].contains("WLL"), F.lit("wll"))
                                          .when(x["v"].rlike(fields.REPORT_NUMBER_LABEL), F.lit("rep"))
                                          .when(x["v"].contains("Date of Thorough"), F.lit("dot"))
                                          .when(x["v"].contains("Latest date by which next"), F.lit("next"))
                                          .alias("k"))))
    cells = col("_c_cells")
    kind = lambda k: F.filter(cells, lambda x: x["k"] == k)
    d = stage(d, _c_idents=F.filter(kind("ident"), lambda x: F.size(text.split_newline(x["v"])) >= 3),
              _c_wll=_last_nonnull(F.transform(kind("wll"), lambda x: swl.capacity_search(
                  F.get(text.split_newline(x["v"]), 3), "tonne"))),
              _c_rep=F.transform(kind("rep"), lambda x: fields.certificate_search(x["v"], "report_number")),
              _c_dot=F.transform(kind("dot"), lambda x: text.strip_label(x["v"], "Date of Thorough Examination:")),
              _c_next=F.transform(kind("next"), lambda x: text.strip_label(
                  x["v"], "Latest date by which next thorough\nexamination must be carried out:")))
    d = stage(d, _c_desc=_last_nonnull(F.transform(col("_c_idents"), lambda x: nullif_empty(
        text.cell_line(x["v"], 1)))),
        _c_idt=F.filter(F.transform(col("_c_idents"), lambda x: text.cell_line(x["v"], 2)), lambda v: truthy(v)),
        _c_p=swl.parse_swl(col("_c_wll"), swl.FIRST_INTEGRATED))
    d = stage(d, _c_ranges=_fi_ranges(col("_c_idt")))
    d = stage(d, _c_segs=F.flatten(F.transform(col("_c_ranges"), lambda r: r["segments"])),
              _c_rerr=F.flatten(F.transform(col("_c_ranges"), lambda r: r["errors"])))
    d = stage(d, _c_last=ids.last_id(col("_c_segs")))
    desc, p = col("_c_desc"), col("_c_p")
    rep, dot, nxt = col("_c_rep"), col("_c_dot"), col("_c_next")
    it = item(
        table_no=F.lit(0), row_no=F.lit(0), id_raw=F.get(col("_c_idt"), F.size(col("_c_idt")) - 1),
        id_segments=col("_c_segs"),
        item_description=desc, lookup_desc=desc, lookup_mode=fi_lookup_mode(variant),
        swl_value=p["value"], swl_unit=p["unit"], swl_note=p["note"],
        certificate_no=_last_nonnull(F.transform(rep, nullif_empty)),
        previous_inspection=_last_nonnull(F.transform(dot, nullif_empty)),
        next_inspection_due_date=_last_nonnull(F.transform(nxt, nullif_empty)),
        err_head=errs((~truthy(desc), C.DESCRIPTION_NOT_FOUND),
                      (F.exists(col("_c_idents"), lambda x: ~truthy(text.cell_line(x["v"], 2))),
                       C.ID_NUMBER_NOT_FOUND)),
        dict_errors=F.lit(True),
        err_tail=F.concat(col("_c_rerr"), errs(
            (F.exists(rep, lambda v: ~truthy(v)), C.CERTIFICATE_NUMBER_NOT_FOUND),
            (F.exists(dot, lambda v: ~truthy(v)), C.PREVIOUS_NOT_FOUND_FI),
            (F.exists(nxt, lambda v: ~truthy(v)), C.NEXT_DUE_NOT_FOUND))),
        suffix_if_any=F.array(F.concat(F.lit(C.FOR_ID_PREFIX), F.coalesce(col("_c_last"), F.lit("None")))))
    return stage(d, _fi_cells=F.when(F.size(col("_c_idt")) > 0, outcome(items=F.array(it))).otherwise(
        outcome(error=F.lit(C.NO_IDS_ON_PAGE))))


def _fi_declaration(d: DataFrame, variant: str) -> DataFrame:
    """Labels whose value sits in the next row (``Id Number``, ``WLL``,
    ``Certificate Number``) or on a later line of the same cell
    (``Description`` line 2, ``Date of Declaration`` line 4); next inspection =
    declaration + 180 days.  One shared record per page, as in X6."""
    col = F.col
    tbl = F.when(col("_fi_kind") == "fi_declaration", F.get(col("tables"), 0))
    d = stage(d, _d_tbl=F.coalesce(tbl, F.array()))
    t = col("_d_tbl")
    d = stage(d, _d_cells=F.transform(F.filter(_cells_in_order(t), lambda x: truthy(x["v"])), lambda x: F.struct(
        x["v"].alias("v"), pystrip(F.get(F.get(t, x["r"] + 1), x["c"])).alias("below"),
        (F.coalesce(F.size(F.get(t, x["r"] + 1)), F.lit(0)) <= 0).alias("last"),
        F.when(x["v"].contains("Id Number"), F.lit("id")).when(x["v"].contains("Description"), F.lit("desc"))
        .when(x["v"].contains("WLL"), F.lit("wll")).when(x["v"].contains("Certificate Number"), F.lit("cert"))
        .when(x["v"].contains("Date of Declaration"), F.lit("decl")).alias("k"))))
    cells = col("_d_cells")
    kind = lambda k: F.filter(cells, lambda x: x["k"] == k)
    d = stage(d, _d_idt=F.filter(F.transform(kind("id"), lambda x: x["below"]), lambda v: v.isNotNull()),
              _d_ndesc=F.size(kind("desc")), _d_ndecl=F.size(kind("decl")),
              _d_noid=F.exists(kind("id"), lambda x: x["last"]),
              _d_nocert=F.exists(kind("cert"), lambda x: x["last"]),
              _d_desc=_last_nonnull(F.transform(kind("desc"), lambda x: F.when(
                  F.size(text.split_newline(x["v"])) >= 2, text.cell_line(x["v"], 1)))),
              _d_wll=_last_nonnull(F.transform(kind("wll"), lambda x: swl.capacity_search(x["below"], "tonne"))),
              _d_cert=_last_nonnull(F.transform(kind("cert"), lambda x: x["below"])),
              _d_decl=_last_nonnull(F.transform(kind("decl"), lambda x: F.when(
                  dates.parse_dmy(text.cell_line(x["v"], 3)).isNotNull(), text.cell_line(x["v"], 3)))))
    d = stage(d, _d_ranges=_fi_ranges(col("_d_idt")), _d_p=swl.parse_swl(col("_d_wll"), swl.FIRST_INTEGRATED))
    d = stage(d, _d_segs=F.flatten(F.transform(col("_d_ranges"), lambda r: r["segments"])),
              _d_rerr=F.flatten(F.transform(col("_d_ranges"), lambda r: r["errors"])))
    d = stage(d, _d_last=ids.last_id(col("_d_segs")))
    desc, p, decl = col("_d_desc"), col("_d_p"), col("_d_decl")
    it = item(
        table_no=F.lit(0), row_no=F.lit(0), id_raw=F.get(col("_d_idt"), F.size(col("_d_idt")) - 1),
        id_segments=col("_d_segs"),
        item_description=desc, lookup_desc=desc, lookup_mode=fi_lookup_mode(variant),
        swl_value=p["value"], swl_unit=p["unit"], swl_note=p["note"],
        certificate_no=col("_d_cert"), previous_inspection=decl,
        next_inspection_due_date=dates.date_plus_180(decl),
        err_head=errs(((col("_d_ndesc") > 0) & desc.isNull(), C.DESCRIPTION_NOT_FOUND)),
        dict_errors=col("_d_ndesc") > 0,
        err_tail=F.concat(col("_d_rerr"), errs(
            (col("_d_noid"), C.ID_NUMBER_NOT_FOUND_FI3), (col("_d_nocert"), C.CERTIFICATE_NUMBER_NOT_FOUND),
            ((col("_d_ndecl") > 0) & decl.isNull(), C.DECLARATION_NOT_FOUND))),
        suffix_if_any=F.array(F.concat(F.lit(C.FOR_ID_PREFIX), F.coalesce(col("_d_last"), F.lit("None")))))
    return stage(d, _fi_decl=F.when(F.size(col("_d_idt")) > 0, outcome(items=F.array(it))).otherwise(
        outcome(error=F.lit(C.NO_IDS_ON_PAGE))))


def first_integrated_outcome(df: DataFrame, out: str = "outcome", variant: str = "local",
                             compat: bool = False, gate=None) -> DataFrame:
    """Dispatch a First Integrated page on its first row (P5)."""
    from ..operators.grids import classify_layout
    col = F.col
    kind = classify_layout(row_at(col("tables"), 0, 0), FI_LAYOUTS)
    d = stage(df, _fi_kind=kind if gate is None else F.when(gate, kind))
    d = _fi_declaration(_fi_cells(_fi_register(d, variant, compat), variant), variant)
    n = col("page_no").cast(STR)
    o = (F.when(col("tables").isNull() | (F.size(col("tables")) == 0),
                outcome(error=F.concat(F.lit(C.FI_NO_TABLES_A), n, F.lit(C.FI_NO_TABLES_B))))
         .when(col("_fi_kind") == "fi_register", col("_fi_register"))
         .when(col("_fi_kind") == "fi_cells", col("_fi_cells"))
         .when(col("_fi_kind") == "fi_declaration", col("_fi_decl"))
         .otherwise(outcome(error=F.concat(F.lit(C.FI_UNRECOGNISED), n))))
    d = stage(d, **{out: o})
    return drop_prefix(drop_prefix(drop_prefix(drop_prefix(d, "_fi_"), "_r_"), "_c_"), "_d_")


def centurion_client_outcome(df: DataFrame, out: str = "outcome", id_variant: str = "centurion",
                             variant: str = "local", gate=None) -> DataFrame:
    """A Centurion client's page: Centurion layouts, or Hendrik when the text says so."""
    col = F.col
    txt = col("text") if gate is None else F.when(gate, col("text"))
    d = centurion_outcome(df, "_cc_c", id_variant, variant=variant,
                          gate=F.coalesce(txt.contains("Centurion") & ~txt.contains("Hendrik"), F.lit(False)))
    d = hendrik_outcome(d, "_cc_h", gate=F.coalesce(txt.contains("Hendrik"), F.lit(False)))
    o = (F.when(F.coalesce(txt.contains("Centurion") & ~txt.contains("Hendrik"), F.lit(False)), col("_cc_c"))
         .when(F.coalesce(txt.contains("Hendrik"), F.lit(False)), col("_cc_h"))
         .otherwise(outcome()))
    return drop_prefix(stage(d, **{out: o}), "_cc_")
