"""Registered queries: one per operator of the inventory.

Each query takes ``(spark, sf_dir)``, reads the benchmark tables (or data
derived from them by Spark), runs the operator over all of it and returns a
DataFrame with scalar columns named exactly like the matching oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates, fields, ids, swl, text
from ..operators import dictionary as dct
from ..operators import grids, reduce
from ..operators.expand import explode_ids
from ..sources.sinks import render_errors, render_list
from . import carriers as cr

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _fx(spark, sf):
    return cr.fx(spark, sf)


def _s(c):
    return c.cast("string")


# ======================================================================== F: scalars
@query("swl_parse_tight")
def q_swl_parse_tight(spark, sf):
    p = swl.parse_swl("swl_text", swl.SPARROW)
    return _fx(spark, sf).select(*KEYS, "swl_text", p["value"].alias("swl_value"), p["unit"].alias("swl_unit"),
                                 p["note"].alias("swl_note"))


@query("swl_parse_loose")
def q_swl_parse_loose(spark, sf):
    p = swl.parse_swl("swl_text", swl.FIRST_INTEGRATED)
    return _fx(spark, sf).select(*KEYS, "swl_text", p["value"].alias("swl_value"), p["unit"].alias("swl_unit"),
                                 p["note"].alias("swl_note"))


def _raw_unit(col):
    return text.nullif_empty(F.regexp_extract(col, swl.LOOSE_PATTERN, 2))


@query("unit_alias")
def q_unit_alias(spark, sf):
    u = _raw_unit(F.col("swl_text"))
    return _fx(spark, sf).select(*KEYS, u.alias("raw_unit"), swl.unit_alias(u, swl.FIRST_INTEGRATED).alias("unit"),
                                 swl.unit_alias(u, swl.SPARROW).alias("unit_sparrow"))


@query("unit_semi")
def q_unit_semi(spark, sf):
    u = swl.unit_alias(_raw_unit(F.col("swl_text")), swl.FIRST_INTEGRATED)
    d = _fx(spark, sf).select(u.alias("unit")).where(swl.is_unit("unit", swl.FIRST_INTEGRATED))
    return d.groupBy("unit").agg(F.count(F.lit(1)).alias("n_rows"))


def _cap_text():
    ln = F.col("l_linenumber")
    word = F.when(ln % 3 == 0, F.lit("Tonnes")).when(ln % 3 == 1, F.lit("kilos")).otherwise(F.lit("TONNE"))
    return F.concat(_s(F.col("qty")), F.lit("."), _s(ln), F.lit(" "), word, F.lit(" x "), F.col("swl_text"))


@query("capacity_search")
def q_capacity_search(spark, sf):
    t = _cap_text()
    return _fx(spark, sf).select(*KEYS, t.alias("cap_text"),
                                 swl.capacity_search(t, "register").alias("cap_register"),
                                 swl.capacity_search(t, "tonne").alias("cap_tonne"),
                                 swl.capacity_search(t, "hendrik").alias("cap_hendrik"))


def _qty_text():
    ln = F.col("l_linenumber")
    return F.concat(F.when(ln % 3 == 0, F.lit(" ")).otherwise(F.lit("")), _s(F.col("qty")),
                    F.when(ln % 2 == 0, F.lit(" RIDGEGEAR RGL28")).otherwise(F.lit("X 4")))


@query("extract_quantity")
def q_extract_quantity(spark, sf):
    t = _qty_text()
    return _fx(spark, sf).select(*KEYS, t.alias("qty_text"), fields.extract_quantity(t).alias("quantity"))


@query("quantity_cell")
def q_quantity_cell(spark, sf):
    ln = F.col("l_linenumber")
    cell = F.when(ln % 3 == 0, F.concat(_s(F.col("qty")), F.lit(".9"))).when(ln % 3 == 1, F.lit("abc")).otherwise(
        F.concat(F.lit(" "), _s(F.col("qty"))))
    return _fx(spark, sf).select(*KEYS, cell.alias("cell"), fields.quantity_cell(cell).alias("quantity"))


@query("serial_clean")
def q_serial_clean(spark, sf):
    cell = F.concat(F.lit("Serial No(s): "), F.col("id_text"))
    return _fx(spark, sf).select(*KEYS, fields.serial_clean(cell).alias("serials"))


@query("serial_last_segment")
def q_serial_last_segment(spark, sf):
    return _fx(spark, sf).select(*KEYS, fields.serial_last_segment("header_block").alias("serial"))


@query("explode_lines")
def q_explode_lines(spark, sf):
    return _fx(spark, sf).select(*KEYS, F.posexplode(text.split_newline(F.col("header_block"))).alias(
        "line_no", "line"))


@query("label_value_last")
def q_label_value_last(spark, sf):
    d = q_explode_lines(spark, sf)
    return d.select(*KEYS, "line_no", fields.label_value_last("line").alias("value"))


@query("label_value_first")
def q_label_value_first(spark, sf):
    d = q_explode_lines(spark, sf)
    return d.select(*KEYS, "line_no", fields.label_value_first("line").alias("value"))


@query("label_map")
def q_label_map(spark, sf):
    block = F.col("header_block")
    return _fx(spark, sf).select(
        *KEYS, *[fields.label_value(block, key, "last").alias(name) for name, key in (
            ("report_number", "reportnumber"), ("examined", "dateofthoroughexamination"), ("job_number", "jobnumber"))],
        fields.label_value(block, "jobnumber", "first").alias("job_number_first"),
        fields.label_value(block, "duedateofnextthoroughexamination", "last").alias("next_due"))


@query("provider_prefix")
def q_provider_prefix(spark, sf):
    job = fields.label_value(F.col("header_block"), "jobnumber", "last")
    return _fx(spark, sf).select(*KEYS, text.provider_prefix(job).alias("provider"))


@query("cell_line")
def q_cell_line(spark, sf):
    return _fx(spark, sf).select(*KEYS, *[text.cell_line("header_block", k).alias(f"line{k}") for k in range(4)])


@query("date_plus_180")
def q_date_plus_180(spark, sf):
    return _fx(spark, sf).select(*KEYS, "date_text", dates.date_plus_180("date_text").alias("next_due"))


def _loose_dates(spark, sf):
    o = cr.table(spark, sf, "orders")
    d = F.col("o_orderdate")
    s = F.concat(_s(F.dayofmonth(d)), F.lit("/"), _s(F.month(d)), F.lit("/"), _s(F.year(d)))
    bad = F.concat(F.lit("3"), _s(F.dayofmonth(d) % 4), F.lit("/02/"), _s(F.year(d)))
    return o.select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, bad).otherwise(s).alias("date_raw"))


@query("date_normalise")
def q_date_normalise(spark, sf):
    return _loose_dates(spark, sf).select("o_orderkey", "date_raw", dates.date_normalise("date_raw").alias("date_out"))


def _date_texts():
    return (F.concat(F.lit("Checked "), F.col("date_text"), F.lit(" ok")),
            F.concat(F.lit("Due "), F.col("date_text")),
            F.concat(F.lit("Date "), F.replace(F.col("date_text"), F.lit("/"), F.lit("-")), F.lit(" x")))


@query("date_search")
def q_date_search(spark, sf):
    a, b, c = _date_texts()
    return _fx(spark, sf).select(*KEYS, dates.date_search(a, "anywhere").alias("d_anywhere"),
                                 dates.date_search(a, "row_end").alias("d_row_end_none"),
                                 dates.date_search(b, "row_end").alias("d_row_end"),
                                 dates.date_search(c, "dashed").alias("d_dashed"))


@query("strip_label")
def q_strip_label(spark, sf):
    t = F.concat(F.lit("Date of Thorough Examination: "), F.col("date_text"), F.lit(" \n"))
    return _fx(spark, sf).select(*KEYS, text.strip_label(t, "Date of Thorough Examination:").alias("value"))


@query("description_head")
def q_description_head(spark, sf):
    p = cr.table(spark, sf, "part")
    d = F.concat(F.col("p_name"), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(": "), F.col("p_brand"))).otherwise(
        F.lit("")), F.lit("\n"), F.col("p_type"))
    return p.select("p_partkey", text.description_head(d).alias("head"))


def _between_text():
    ln = F.col("l_linenumber")
    return F.concat(F.when(ln % 2 == 0, F.lit("(AB) ")).otherwise(F.lit("")), F.lit("TZW"), _s(F.col("l_suppkey")),
                    F.lit(" Shackle (blue) "),
                    F.when(ln % 3 == 0, F.concat(_s(F.col("qty")), F.lit(".5 Tonnes "))).otherwise(F.lit("")),
                    F.lit("end"))


@query("between_matches")
def q_between_matches(spark, sf):
    t = _between_text()
    return _fx(spark, sf).select(*KEYS, fields.between_matches(t).alias("description"),
                                 fields.between_matches(t, compat=True).alias("description_compat"))


@query("id_search")
def q_id_search(spark, sf):
    ln = F.col("l_linenumber")
    t = F.concat(F.lit("Row "), F.when(ln % 2 == 0, F.lit("(X1) ")).otherwise(F.lit("")),
                 F.when(ln % 3 == 0, F.lit("tz")).otherwise(F.lit("TZW")), _s(F.col("l_suppkey")), F.lit(" end"))
    return _fx(spark, sf).select(*KEYS, fields.id_search(t).alias("id_number"))


@query("certificate_search")
def q_certificate_search(spark, sf):
    a = F.concat(F.lit("Report Ref No ABC/"), F.lpad(_s(F.col("l_orderkey")), 6, "0"), F.lit("/"),
                 F.lpad(_s(F.col("l_partkey")), 5, "0"))
    b = F.concat(F.lit("Report  number: R"), _s(F.col("l_orderkey")), F.lit(" "))
    c = F.concat(F.lit("Hendrik Certificate No. : "), _s(F.col("l_suppkey")), F.lit(" more"))
    return _fx(spark, sf).select(*KEYS, fields.certificate_search(a, "report_ref").alias("report_ref"),
                                 fields.certificate_search(b, "report_number").alias("report_number"),
                                 fields.certificate_search(c, "certificate_no").alias("certificate_no"))


@query("id_after_paren")
def q_id_after_paren(spark, sf):
    t = F.concat(F.lit("Id ("), _s(F.col("l_linenumber")), F.lit(") HK-"), _s(F.col("l_orderkey")), F.lit(" more"))
    return _fx(spark, sf).select(*KEYS, fields.id_after_paren(t).alias("id_number"))


# ======================================================================== G: generators
def _explode(df, segs, keep=KEYS, tasks=None):
    return explode_ids(df.select(*keep, segs.alias("_segs")), "_segs", tasks=tasks)


def _qline():
    return F.col("l_linenumber")


@query("id_parts")
def q_id_parts(spark, sf):
    ln = F.col("l_linenumber")
    s = F.when(ln % 2 == 0, F.concat(F.lit("MGL"), _s(F.col("l_partkey")))).otherwise(
        F.concat(_s(F.col("l_suppkey")), F.lit("B")))
    return _explode(_fx(spark, sf), ids.id_parts(s, ln % 4))


@query("id_to_range")
def q_id_to_range(spark, sf):
    return _explode(_fx(spark, sf), ids.id_to_range("id_text", _qline()))


@query("id_multiplier")
def q_id_multiplier(spark, sf):
    return _explode(_fx(spark, sf), ids.id_multiplier("id_text"))


@query("id_comma")
def q_id_comma(spark, sf):
    return _explode(_fx(spark, sf), ids.id_comma("id_text"))


@query("id_dash_range")
def q_id_dash_range(spark, sf):
    """A range names up to as many IDs as its supplier's number, so its chunks are dealt over all tasks."""
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return _explode(_fx(spark, sf), ids.id_expression("range_text", _qline(), "centurion_local"), tasks=tasks)


@query("id_hyphen_range")
def q_id_hyphen_range(spark, sf):
    d = _fx(spark, sf).select(*KEYS, ids.id_hyphen_range("range_text").alias("r"))
    d = d.select(*KEYS, F.col("r.segments").alias("_segs"),
                 F.get(F.col("r.errors"), 0).alias("range_error"))
    return explode_ids(d, "_segs")


@query("distinct_ids")
def q_distinct_ids(spark, sf):
    d = q_id_hyphen_range(spark, sf).select(F.col("l_orderkey").alias("doc_id"), "id_number")
    return reduce.distinct_ids(d)


# ======================================================================== grids on lineitem
def _cell_rows(spark, sf):
    """lineitem as grid rows: every line of an order is one row (``rn``, by
    line, part, supplier), 4 text cells, one cell null on every third line."""
    li = cr.table(spark, sf, "lineitem")
    ln = F.col("l_linenumber")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    cells = F.array(_s(F.col("l_partkey")), _s(F.col("l_suppkey")),
                    F.when(ln % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("l_returnflag")),
                    F.col("l_linestatus"))
    return li.select("l_orderkey", "l_linenumber", F.row_number().over(w).alias("rn"), cells.alias("cells"))


def _long_cells(spark, sf):
    """Long cells, written once and read back with the reader of S3; row 4 is
    missing from every grid."""
    from ..sources.readers import read_cells
    r = _cell_rows(spark, sf)
    cells = r.select(_s(F.col("l_orderkey")).alias("doc_id"), F.lit(1).alias("page_no"), F.lit(0).alias("table_no"),
                     (F.col("rn") - F.when(F.col("rn") > 4, 0).otherwise(1)).cast("int").alias("row_no"),
                     F.posexplode("cells").alias("col_no", "cell"))
    path = _scratch(spark, "cells")
    cells.write.parquet(path)
    return read_cells(spark, path)


def grid_text(tbl):
    return F.array_join(F.transform(tbl, lambda r: F.coalesce(F.array_join(r, ",", "~"), F.lit("<null>"))), "|")


@query("assemble_grid")
def q_assemble_grid(spark, sf):
    g = grids.assemble_grid(_long_cells(spark, sf))
    t = F.get(F.col("tables"), 0)
    return g.select("doc_id", "page_no", F.size("tables").alias("n_tables"), F.size(t).alias("n_rows"),
                    grid_text(t).alias("grid"))


@query("row_text")
def q_row_text(spark, sf):
    return _cell_rows(spark, sf).select("l_orderkey", "l_linenumber", text.row_text("cells").alias("row_text"))


@query("row_text_nonnull")
def q_row_text_nonnull(spark, sf):
    return _cell_rows(spark, sf).select("l_orderkey", "l_linenumber",
                                        text.row_text_nonnull("cells").alias("row_text"))


@query("skip_header_rows")
def q_skip_header_rows(spark, sf):
    d = _cell_rows(spark, sf).select("l_orderkey", "l_linenumber", text.row_text("cells").alias("row_text"))
    return d.where(~F.col("row_text").contains(" A F"))


@query("cell_at")
def q_cell_at(spark, sf):
    g = grids.assemble_grid(_long_cells(spark, sf))
    return g.select("doc_id", grids.cell_at("tables", 0, 0, 0).alias("c000"),
                    grids.cell_at("tables", 0, 2, 2).alias("c022"), grids.cell_at("tables", 0, 6, 3).alias("c063"),
                    grids.cell_at("tables", 1, 0, 0).alias("c100"))


@query("label_pick")
def q_label_pick(spark, sf):
    g = grids.assemble_grid(_long_cells(spark, sf))
    hdr, val = grids.row_at("tables", 0, 0), grids.row_at("tables", 0, 1)
    return g.select("doc_id", grids.label_pick(hdr, val, "1").alias("pick_1"),
                    grids.label_pick(hdr, val, "f").alias("pick_f"))


@query("next_row_value")
def q_next_row_value(spark, sf):
    c = grids.next_row_long(_long_cells(spark, sf))
    return c.select("doc_id", "row_no", "col_no", "cell", "next_cell")


@query("header_value_join")
def q_header_value_join(spark, sf):
    return grids.header_value_join(_long_cells(spark, sf), 0).select("doc_id", "col_no", "header", "value")


_PREFIXES = {"small": ["small"], "warm": ["red", "HOT"], "big": ["large "]}
_HEADERS = {"anvil": "anvil", "bolt": "bolt", "ring": "ring"}


@query("classify_layout")
def q_classify_layout(spark, sf):
    p = cr.table(spark, sf, "part")
    row = F.array(F.col("p_name"), F.lit(None).cast("string"), F.col("p_type"))
    return p.select("p_partkey", grids.classify_layout(row, _PREFIXES).alias("layout"))


@query("classify_header")
def q_classify_header(spark, sf):
    p = cr.table(spark, sf, "part")
    return p.select("p_partkey", grids.classify_header(F.col("p_name"), _HEADERS).alias("layout"))


# ======================================================================== documents
DOC_KEYWORDS = ("elle", "the", "und")


@query("blank_text")
def q_blank_text(spark, sf):
    d = cr.table(spark, sf, "documents")
    return d.select("doc_id", text.is_blank("text").alias("blank"))


@query("route_documents")
def q_route_documents(spark, sf):
    from .pipeline import route_keyword
    d = cr.table(spark, sf, "documents")
    return d.select("doc_id", route_keyword(F.col("text"), DOC_KEYWORDS).alias("client"))


@query("page_filter")
def q_page_filter(spark, sf):
    d = cr.table(spark, sf, "documents")
    t = F.col("text")
    return d.where(t.contains("the") & ~t.contains("und")).select("doc_id", "lang")


@query("document_status")
def q_document_status(spark, sf):
    from .pipeline import document_status, route_documents
    d = cr.table(spark, sf, "documents").select(_s(F.col("doc_id")).alias("doc_id"), F.lit(1).alias("page_no"),
                                                "text")
    return document_status(route_documents(d, DOC_KEYWORDS), "2024-01-01")


@query("output_name")
def q_output_name(spark, sf):
    d = cr.table(spark, sf, "documents")
    from ..sources.sinks import output_name
    path = F.concat(F.lit("in/"), F.col("source"), F.lit("/pdfdoc_"), _s(F.col("doc_id")), F.lit(".pdf"))
    return d.select("doc_id", output_name(path).alias("output_name"),
                    output_name(path, compat=True).alias("output_name_compat"))


# ======================================================================== dictionary on part
def _part(spark, sf):
    return cr.table(spark, sf, "part").select("p_partkey", "p_name", "p_size")


@query("dict_token_lookup")
def q_dict_token_lookup(spark, sf):
    return dct.token_lookup(_part(spark, sf), "p_name", cr.fixture_dictionary(spark)).select(
        "p_partkey", "p_name", "manufacturer", "model")


@query("dict_keyword_lookup")
def q_dict_keyword_lookup(spark, sf):
    return dct.token_lookup(_part(spark, sf), "p_name", cr.fixture_dictionary(spark), mode="keyword").select(
        "p_partkey", "p_name", "manufacturer", "model")


@query("dict_substring_lookup")
def q_dict_substring_lookup(spark, sf):
    return dct.substring_lookup(_part(spark, sf), "p_name", cr.fixture_dictionary(spark)).select(
        "p_partkey", "p_name", "manufacturer", "model")


@query("manufacturer_fallback")
def q_manufacturer_fallback(spark, sf):
    p = _part(spark, sf)
    descs = p.select("p_name").distinct()
    hits = dct.token_matches(descs, "p_name", cr.fixture_dictionary(spark))
    out = hits.select("p_name", text.nullif_empty(F.col("m_canonical")).alias("canonical_hit"),
                      text.nullif_empty(F.col("d_manufacturer")).alias("model_maker"),
                      F.coalesce(text.nullif_empty(F.col("m_canonical")),
                                 text.nullif_empty(F.col("d_manufacturer"))).alias("manufacturer"))
    return p.join(out, "p_name", "left").select("p_partkey", "canonical_hit", "model_maker", "manufacturer")


@query("manufacturer_override")
def q_manufacturer_override(spark, sf):
    p = _part(spark, sf)
    d = p.select("p_partkey", F.concat(F.when(F.col("p_size") % 3 == 0, F.lit("MILLER ")).otherwise(F.lit("")),
                                       F.col("p_name"),
                                       F.when(F.col("p_size") % 2 == 0, F.lit(" Weblift")).otherwise(F.lit("")))
                 .alias("description"))
    return dct.token_lookup(d, "description", cr.fixture_dictionary(spark)).select(
        "p_partkey", "manufacturer", "model")


@query("dict_misses")
def q_dict_misses(spark, sf):
    return dct.dictionary_misses(_part(spark, sf), "p_name", cr.fixture_dictionary(spark))


@query("scan_dictionary")
def q_scan_dictionary(spark, sf):
    """S4 on dictionary sheets derived from ``part``, written as CSV and read with
    the dictionary reader: the noun of each part name is a keyword, its lowest
    part key gives the sheet order."""
    from ..sources.readers import read_dictionary
    p = cr.table(spark, sf, "part")
    kw = F.get(F.split(F.col("p_name"), " "), 1)
    d = p.groupBy(kw.alias("keyword")).agg(F.min_by("p_brand", "p_partkey").alias("canonical"),
                                           F.min("p_partkey").alias("first_key"))
    path = _scratch(spark, "dictionary")
    d.select("first_key", "keyword", "canonical").write.csv(f"{path}/makers", header=True)
    d.select("first_key", F.col("keyword").alias("model"), F.col("canonical").alias("manufacturer")).write.csv(
        f"{path}/models", header=True)
    got = read_dictionary(spark, f"{path}/makers", f"{path}/models")
    models = got.models.select("ord", "model", F.col("manufacturer").alias("model_manufacturer"))
    return got.manufacturers.join(models, "ord").select("ord", "keyword", "canonical", "model", "model_manufacturer")


# ======================================================================== aggregations / windows
def _li(spark, sf):
    return cr.table(spark, sf, "lineitem")


@query("items_last_wins")
def q_items_last_wins(spark, sf):
    """A1 as the pipeline runs it: a line is an ID of its order, its part is the page and its supplier the row."""
    li = _li(spark, sf).select(
        F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("id_number"), F.col("l_partkey").alias("page_no"),
        F.col("l_linenumber").alias("table_no"), F.col("l_suppkey").alias("row_no"), F.lit(0).cast("bigint").alias("id_idx"),
        F.lit(0).alias("segment"), "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    # a line that is there twice is one row of the grid
    items = li.dropDuplicates(["doc_id", "page_no", "table_no", "row_no"])
    r = reduce.last_wins_ids(li, items, ["l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"])
    return r.select(F.col("doc_id").alias("l_orderkey"), F.col("id_number").alias("l_linenumber"),
                    F.col("first_pos.page_no").cast("bigint").alias("first_partkey"),
                    F.col("first_pos.row_no").cast("bigint").alias("first_suppkey"), "l_quantity", "l_extendedprice",
                    "l_returnflag", _s(F.col("l_shipdate")).alias("l_shipdate"))


@query("page_last_nonnull")
def q_page_last_nonnull(spark, sf):
    ln = F.col("l_linenumber")
    li = _li(spark, sf).select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("pos"),
                               F.when(ln % 3 == 0, F.lit(None)).otherwise(F.col("l_returnflag")).alias("flag"),
                               F.when(ln >= 4, F.lit(None)).otherwise(F.col("l_linestatus")).alias("status"))
    return reduce.last_nonnull(li, ["l_orderkey"], "pos", ["flag", "status"])


def _fx_errors(spark, sf):
    p = swl.parse_swl("swl_text", swl.SPARROW)
    due = fields.label_value(F.col("header_block"), "duedateofnextthoroughexamination", "last")
    errs = F.array_compact(F.array(
        F.when(~text.truthy(p["value"]), F.lit("SWL Value not found")),
        F.when(~text.truthy(p["unit"]), F.lit("SWL Unit not found")),
        F.when(due.isNull(), F.lit("Next Inspection Due Date not found"))))
    return _fx(spark, sf).select(*KEYS, errs.alias("errors"))


@query("item_errors")
def q_item_errors(spark, sf):
    return _fx_errors(spark, sf).select(*KEYS, render_errors(F.col("errors")).alias("errors"))


@query("running_errors")
def q_running_errors(spark, sf):
    d = _fx_errors(spark, sf).withColumn("pos", F.struct("l_linenumber", "l_partkey", "l_suppkey"))
    d = reduce.running_errors(d, ["l_orderkey"], "pos")
    return d.select(*KEYS, F.size("running_errors").alias("n_errors"),
                    render_list(F.col("running_errors")).alias("running_errors"))


@query("row_numbering")
def q_row_numbering(spark, sf):
    d = q_items_last_wins(spark, sf).select("l_orderkey", "l_linenumber", "first_partkey")
    d = d.withColumn("pos", F.struct("l_linenumber", "first_partkey"))
    return reduce.number_rows(d, "l_orderkey", "pos", "row_no", start=3).select(
        "l_orderkey", "l_linenumber", "row_no")


@query("stamp_page_attrs")
def q_stamp_page_attrs(spark, sf):
    ln = F.col("l_linenumber")
    rows = _fx(spark, sf).select(*KEYS, F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("pos"),
                                 F.when(ln == 2, F.col("date_text")).alias("cert_date"),
                                 F.when(ln % 2 == 1, F.concat(F.lit("R"), _s(F.col("l_partkey")))).alias("report"))
    page = reduce.last_nonnull(rows, ["l_orderkey"], "pos", ["cert_date", "report"])
    return reduce.stamp(rows.select(*KEYS), page, ["l_orderkey"], ["cert_date", "report"])


@query("page_rows_to_items")
def q_page_rows_to_items(spark, sf):
    r = _cell_rows(spark, sf)
    rt = F.concat(F.when(F.col("l_linenumber") % 2 == 0, F.lit("ABC")).otherwise(F.lit("ab")),
                  text.row_text("cells"))
    d = r.select("l_orderkey", "l_linenumber", rt.alias("row_text"))
    d = d.where(F.col("row_text").rlike(fields.REGISTER_ID))
    return d.select("l_orderkey", "l_linenumber", fields.id_search("row_text").alias("id_number"))


@query("union_layouts")
def q_union_layouts(spark, sf):
    a = q_id_to_range(spark, sf).select("l_orderkey", "id_number", F.lit("to_range").alias("source"))
    b = q_id_hyphen_range(spark, sf).select("l_orderkey", "id_number", F.lit("hyphen").alias("source"),
                                            "range_error")
    return a.unionByName(b, allowMissingColumns=True)


def _page_files(spark, sf):
    from ..sources.readers import read_page_grids
    path = _scratch(spark, "grids")
    cr.sparrow_pages(spark, sf).write.parquet(path)
    return read_page_grids(spark, path)


@query("first_page")
def q_first_page(spark, sf):
    """The page number filter and the two columns reach the Parquet scan; no grid is read."""
    p = _page_files(spark, sf)
    return p.where(F.col("page_no") == 1).select("doc_id", "page_no", "text")


@query("scan_page_grids")
def q_scan_page_grids(spark, sf):
    p = _page_files(spark, sf)
    t = F.get(F.col("tables"), 0)
    return p.select("doc_id", "page_no", F.size("tables").alias("n_tables"), F.size(t).alias("n_rows"),
                    grid_text(t).alias("grid"))


# ======================================================================== layouts (X1-X7) and sinks
ITEM_OUT = ["item_description", "model", "swl_value", "swl_unit", "swl_note", "manufacturer", "certificate_no",
            "previous_inspection", "next_inspection_due_date", "provider_identification"]


def run_layout(spark, pages, client, opts=None, numbered=False, buckets=None):
    """One client's layouts over ``pages`` -> (items, page_errors).  The compact per-page outcomes are stored once
    (under ``spark.checkpoint.dir``): the dictionary step and the weights of the documents read some of their
    fields, and exploding a stored column keeps Catalyst from re-inlining the layout expressions into the
    generator.  ``buckets``: they are stored bucketed by document, and the items are not shuffled."""
    from .pipeline import Options, items_of, page_errors_of
    out = page_outcomes(pages, client, opts or Options(), buckets)
    items = items_of(out, cr.fixture_dictionary(spark), opts or Options(), numbered=numbered, buckets=buckets)
    return items, page_errors_of(out)


def page_outcomes(pages, client, opts=None, buckets=None):
    """The stored outcomes of one client's layouts."""
    from .pipeline import Options, layout_outcome
    return cr.store(layout_outcome(pages, client, opts or Options()), "outcomes", buckets)


def run_derived(spark, sf, client, make, *args, opts=None, numbered=False):
    """:func:`run_layout` over the pages that ``make`` derives, which are made by document and read once: the shuffle
    that numbers them is the only one of lines, pages or items, and no grid is stored."""
    tasks = cr.document_tasks(spark, sf)
    pages = cr.apart(make(spark, sf, *args, lines=cr.numbered(spark, sf, tasks)))
    return run_layout(spark, pages, client, opts, numbered, tasks)


def item_table(items):
    return items.select("doc_id", "id_number", F.col("first_pos.page_no").alias("first_page"),
                        F.col("first_pos.id_idx").alias("first_idx"), *ITEM_OUT,
                        F.col("errors_text").alias("errors"))


@query("extract_sparrow")
def q_extract_sparrow(spark, sf):
    return item_table(run_derived(spark, sf, "Sparrows", cr.sparrow_pages)[0])


@query("extract_centurion_single")
def q_extract_centurion_single(spark, sf):
    return item_table(run_derived(spark, sf, "Centurion", cr.centurion_pages, False)[0])


@query("extract_centurion_qty")
def q_extract_centurion_qty(spark, sf):
    return item_table(run_derived(spark, sf, "Centurion", cr.centurion_pages, True)[0])


@query("page_outcome")
def q_page_outcome(spark, sf):
    from .pipeline import layout_outcome
    lines = cr.store(cr.numbered(spark, sf), "lines")  # numbered once for all layouts
    inputs = {"sparrow": ("Sparrows", cr.sparrow_pages(spark, sf, lines)),
              "centurion": ("Centurion", cr.centurion_pages(spark, sf, False, lines)),
              "centurion_qty": ("Centurion", cr.centurion_pages(spark, sf, True, lines)),
              "hendrik": ("Centurion", cr.hendrik_pages(spark, sf, lines)),
              "register": ("First Integrated", cr.first_integrated_pages(spark, sf, "register", lines)),
              "cells": ("First Integrated", cr.first_integrated_pages(spark, sf, "cells", lines)),
              "declaration": ("First Integrated", cr.first_integrated_pages(spark, sf, "declaration", lines))}
    out = None
    for name, (client, pages) in inputs.items():
        o = layout_outcome(cr.materialize(pages), client).select(F.lit(name).alias("layout"), "doc_id", "page_no", "outcome")
        out = o if out is None else out.unionByName(o)
    return out.select("layout", "doc_id", "page_no", F.when(F.col("outcome.error").isNotNull(), F.lit("error"))
                      .otherwise(F.lit("items")).alias("status"), F.size("outcome.items").alias("n_items"),
                      F.col("outcome.error").alias("error"))


def _sparrow_run(spark, sf, numbered=False):
    return run_derived(spark, sf, "Sparrows", cr.sparrow_pages, numbered=numbered)


@query("sink_items")
def q_sink_items(spark, sf):
    from ..sources.sinks import item_sheet
    return item_sheet(_sparrow_run(spark, sf, numbered=True)[0]).drop("client")


@query("sink_page_errors")
def q_sink_page_errors(spark, sf):
    from ..sources.sinks import page_error_sheet
    return page_error_sheet(_sparrow_run(spark, sf)[1]).drop("client")


@query("sink_manifest")
def q_sink_manifest(spark, sf):
    from ..sources.sinks import manifest
    from .pipeline import document_status, route_documents
    return manifest(document_status(route_documents(mixed_pages(spark, sf, grids=False)), "2024-01-01"))


@query("extraction_summary")
def q_extraction_summary(spark, sf):
    items, errors = _sparrow_run(spark, sf)
    return reduce.extraction_summary(items, errors)


@query("sink_overwrite")
def q_sink_overwrite(spark, sf):
    """K4: three commits of one run date: the even documents with wrong rows, the
    odd ones, then, after a compaction, the even ones again as they are.  Every
    document ends with its own rows, once."""
    from ..sources import commits
    from ..sources.sinks import item_sheet, read_sheet, target
    base = _scratch(spark, "sink-overwrite")
    folder = target(base, "2024-01-01")
    sheet = cr.store(item_sheet(_sparrow_run(spark, sf, numbered=True)[0]), "sheet")
    odd = F.col("doc_id").cast("bigint") % 2 == 1
    for part in (sheet.where(~odd).withColumn("Id Number", F.lit("old")), sheet.where(odd)):
        commits.write_commit({"items": part}, part.select("doc_id"), folder)
    commits.compact(spark, folder)
    even = sheet.where(~odd)
    commits.write_commit({"items": even}, even.select("doc_id"), folder)
    return read_sheet(spark, base, "2024-01-01", "items").drop("client", "run_date")


def mixed_pages(spark, sf, grids=True):
    """Documents of all clients' layouts plus unroutable ones, in one page table;
    some Sparrow documents have lost their first page.  The lines are stored once for all layouts; who reads
    the grids more than once stores them (``bucketed_pages``, page files).  Without ``grids`` the pages have no
    ``tables``, and of the lines only what texts and keys are made from is stored."""
    lost = (F.col("page_no") == 1) & (F.col("doc_id").cast("bigint") % 97 == 0)

    lines = cr.numbered(spark, sf)
    if grids:
        lines = cr.store(lines, "lines")
    else:
        others = [F.lit(None).cast(f.dataType).alias(f.name) for f in lines.schema if f.name not in cr.TEXT_COLUMNS]
        lines = cr.store(lines.select(*cr.TEXT_COLUMNS), "lines").select(*cr.TEXT_COLUMNS, *others)

    def tagged(tag, pages):
        return pages.withColumn("doc_id", F.concat(F.lit(tag), "doc_id"))
    s = tagged("S-", cr.sparrow_pages(spark, sf, lines).where(~lost))
    for tag, pages in (("C-", cr.centurion_pages(spark, sf, False, lines)),
                       ("Q-", cr.centurion_pages(spark, sf, True, lines)), ("H-", cr.hendrik_pages(spark, sf, lines)),
                       *((k, cr.first_integrated_pages(spark, sf, v, lines)) for k, v in (
                           ("R-", "register"), ("F-", "cells"), ("P-", "declaration")))):
        s = s.unionByName(tagged(tag, pages))
    d = cr.table(spark, sf, "documents").select(F.concat(F.lit("D-"), _s(F.col("doc_id"))).alias("doc_id"),
                                                F.lit("documents").alias("path"), F.lit(1).alias("page_no"),
                                                "text", F.lit(None).cast("array<array<array<string>>>")
                                                .alias("tables"))
    s = s.unionByName(d)
    return s if grids else s.drop("tables")


@query("certificate_pipeline")
def q_certificate_pipeline(spark, sf):
    """X8 over all seven layouts, from a page table bucketed by document: no grid is shuffled."""
    from ..sources.page_store import bucketed_pages
    from .pipeline import extract
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    items, _, _ = extract(bucketed_pages(mixed_pages(spark, sf), buckets), cr.fixture_dictionary(spark))
    return item_table(items)


@query("union_clients")
def q_union_clients(spark, sf):
    """Item tables of two clients' layouts in one table."""
    a = item_table(run_derived(spark, sf, "Sparrows", cr.sparrow_pages)[0])
    b = item_table(run_derived(spark, sf, "Centurion", cr.centurion_pages, False)[0])
    return a.withColumn("client", F.lit("Sparrows")).unionByName(b.withColumn("client", F.lit("Centurion")))


# ======================================================================== sources / streaming (rows-only checks)
def _scratch(spark, name):
    import uuid
    from ..session import ensure_checkpoint_dir
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/{name}-{uuid.uuid4().hex}"


@query("scan_documents")
def q_scan_documents(spark, sf):
    """The documents written as files (one line each, base64), several per
    source, then read whole as binary files."""
    from ..sources.readers import scan_documents
    path = _scratch(spark, "binary")
    d = cr.table(spark, sf, "documents").where("text is not null")
    lines = d.select("source", F.pmod(F.xxhash64("doc_id"), F.lit(8)).alias("part"),
                     F.regexp_replace(F.base64(F.encode("text", "utf-8")), "\\s", "").alias("line"))
    lines.repartition("source", "part").write.partitionBy("source", "part").text(path)
    files = scan_documents(spark, path, glob="*.txt", with_content=True)
    source = F.regexp_extract("path", "source=([^/]*)", 1)
    got = files.select(source.alias("source"), F.explode(F.split(F.decode("content", "utf-8"), "\n")).alias("line"))
    text = F.decode(F.unbase64("line"), "utf-8")
    return got.where("line <> ''").groupBy("source").agg(F.count(F.lit(1)).alias("n_documents"),
                                                         F.sum(F.length(text)).alias("n_characters"))


@query("document_status_mixed")
def q_document_status_mixed(spark, sf):
    """K6 over all clients' documents, some without a first page."""
    from .pipeline import document_status, route_documents
    return document_status(route_documents(mixed_pages(spark, sf, grids=False)), "2024-01-01")


@query("stream_ingest")
def q_stream_ingest(spark, sf):
    """Newly arrived page files -> items, via the batch pipeline per micro-batch.
    The pages of a document are dealt over the files, so most documents come in
    several batches."""
    from ..sources.sinks import read_sheet
    from ..streaming.ingest import start_ingest
    base = _scratch(spark, "stream")
    mixed_pages(spark, sf).repartition(3, "doc_id", "page_no").write.parquet(f"{base}/in")
    start_ingest(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", cr.fixture_dictionary(spark), "2024-01-01",
                 max_files_per_trigger=1).awaitTermination()
    return read_sheet(spark, f"{base}/out", "2024-01-01", "items").select("doc_id", "sheet_row", "Id Number", "Errors")


@query("stream_overwrite")
def q_stream_overwrite(spark, sf):
    """Some documents arrive first with other IDs and values, then as they are, their pages over two files; then
    a new query with a new checkpoint reads all files again, into the same target, and a third one, into a new
    target, meets both versions in one batch.  Both targets end as after one clean run; the rows that are in both
    are returned."""
    from ..sources.sinks import read_sheet
    from ..streaming.ingest import start_ingest
    base = _scratch(spark, "stream")
    pages = cr.sparrow_pages(spark, sf)
    changed = F.transform("tables", lambda t: F.transform(t, lambda r, i: F.when(
        i == 4, F.transform(r, lambda c: F.concat(F.lit("OLD"), c))).otherwise(r)))
    early = pages.where(F.col("doc_id").cast("bigint") % 10 == 0).withColumn("tables", changed)

    def run(checkpoint, out, files=None):
        start_ingest(spark, f"{base}/in", f"{base}/{out}", f"{base}/{checkpoint}", cr.fixture_dictionary(spark),
                     "2024-01-01", max_files_per_trigger=files).awaitTermination()
    early.coalesce(1).write.parquet(f"{base}/in")
    run("first", "out")
    pages.repartition(2, "doc_id", "page_no").write.mode("append").parquet(f"{base}/in")
    run("first", "out", 1)
    run("second", "out")
    run("third", "other")
    both = [read_sheet(spark, f"{base}/{out}", "2024-01-01", "items").select("doc_id", "sheet_row", "Id Number", "Errors")
            for out in ("out", "other")]
    return both[0].intersectAll(both[1])


@query("extract_centurion_single_deployed")
def q_extract_centurion_single_deployed(spark, sf):
    from .pipeline import Options
    return item_table(run_derived(spark, sf, "Centurion", cr.centurion_pages, False,
                                  opts=Options(variant="deployed"))[0])


@query("extract_centurion_qty_deployed")
def q_extract_centurion_qty_deployed(spark, sf):
    from .pipeline import Options
    return item_table(run_derived(spark, sf, "Centurion", cr.centurion_pages, True,
                                  opts=Options(variant="deployed"))[0])


@query("extract_hendrik")
def q_extract_hendrik(spark, sf):
    return item_table(run_derived(spark, sf, "Centurion", cr.hendrik_pages)[0])


@query("extract_fi_register")
def q_extract_fi_register(spark, sf):
    return item_table(run_derived(spark, sf, "First Integrated", cr.first_integrated_pages, "register")[0])


@query("extract_fi_cells")
def q_extract_fi_cells(spark, sf):
    return item_table(run_derived(spark, sf, "First Integrated", cr.first_integrated_pages, "cells")[0])


@query("extract_fi_declaration")
def q_extract_fi_declaration(spark, sf):
    return item_table(run_derived(spark, sf, "First Integrated", cr.first_integrated_pages, "declaration")[0])
