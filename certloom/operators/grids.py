"""Page-grid plumbing: S3, P5-P9, P12, J6.

A page's tables are ``array<array<array<string>>>`` ([table][row][cell]); every
accessor here is null-safe (``get`` instead of ``[]``, which raises under ANSI).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col_, row_text


def cell_at(tables, t: int, r: int, c: int) -> Column:
    """``tables[t][r][c]`` or null."""
    return F.get(F.get(F.get(col_(tables), t), r), c)


def row_at(tables, t: int, r: int) -> Column:
    return F.get(F.get(col_(tables), t), r)


def label_index(header, label: str) -> Column:
    """Index of the first non-null header cell containing ``label`` (case-insensitive)."""
    h = col_(header)
    idx = F.filter(F.sequence(F.lit(0), F.greatest(F.size(h) - 1, F.lit(0))),
                   lambda i: F.coalesce(F.lower(F.get(h, i)).contains(label), F.lit(False)))
    return F.get(idx, 0)


def label_pick(header, values, label: str) -> Column:
    """The value under the first header cell containing ``label``."""
    return F.get(col_(values), label_index(header, label))


def next_row_value(tables, t: int, r, c) -> Column:
    """P9 (grid form): ``table[r + 1][c]``."""
    return F.get(F.get(F.get(col_(tables), t), r + 1), c)


def classify_layout(first_row, prefixes: dict) -> Column:
    """P5: the first ``name -> [prefix, ...]`` whose prefix starts the joined
    first row (case-insensitive); null when none does."""
    joined = F.lower(row_text(first_row))
    expr = None
    for name, options in prefixes.items():
        cond = None
        for p in options:
            c = joined.startswith(p.lower())
            cond = c if cond is None else (cond | c)
        cond = F.coalesce(cond, F.lit(False))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def classify_header(cell, headers: dict) -> Column:
    """The first ``name -> phrase`` contained (case-sensitively) in a header cell."""
    c = col_(cell)
    expr = None
    for name, phrase in headers.items():
        cond = F.coalesce(c.contains(phrase), F.lit(False))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def explode_rows(pages: DataFrame, keys=("doc_id", "page_no"), tables_col: str = "tables") -> DataFrame:
    """G7 building block: one row per (table, row) with its cells."""
    t = pages.select(*keys, F.posexplode(tables_col).alias("table_no", "_tbl"))
    return t.select(*keys, "table_no", F.posexplode("_tbl").alias("row_no", "cells"))


def assemble_grid(cells: DataFrame) -> DataFrame:
    """S3: long cells ``(doc_id, page_no, table_no, row_no, col_no, cell)`` ->
    ``(doc_id, page_no, tables)``.  One shuffle: the input is clustered by page
    once and the three nested collects reuse that clustering.  Positions are
    placed by index, so missing cells become nulls and order never depends on
    collect order."""
    by_page = cells.repartition("doc_id", "page_no")

    def placed(items, pos_field, val_field):
        srt = F.array_sort(items)
        last = F.get(srt, F.size(srt) - 1)[pos_field]
        # positions without gaps need no search
        dense = (F.size(srt) == last + 1) & F.forall(
            F.transform(srt, lambda e, i: e[pos_field] == i), lambda ok: ok)
        return F.when(dense, F.transform(srt, lambda e: e[val_field])).otherwise(F.transform(
            F.sequence(F.lit(0), last), lambda i: F.get(F.filter(srt, lambda e: e[pos_field] == i), 0)[val_field]))

    rows = by_page.groupBy("doc_id", "page_no", "table_no", "row_no").agg(
        F.collect_list(F.struct(F.col("col_no").alias("p"), F.col("cell").alias("v"))).alias("_c"))
    rows = rows.select("doc_id", "page_no", "table_no", "row_no", placed(F.col("_c"), "p", "v").alias("row"))
    tables = rows.groupBy("doc_id", "page_no", "table_no").agg(
        F.collect_list(F.struct(F.col("row_no").alias("p"), F.col("row").alias("v"))).alias("_r"))
    tables = tables.select("doc_id", "page_no", "table_no", placed(F.col("_r"), "p", "v").alias("tbl"))
    pages = tables.groupBy("doc_id", "page_no").agg(
        F.collect_list(F.struct(F.col("table_no").alias("p"), F.col("tbl").alias("v"))).alias("_t"))
    return pages.select("doc_id", "page_no", placed(F.col("_t"), "p", "v").alias("tables"))


def grid_to_cells(pages: DataFrame, keys=("doc_id", "page_no"), tables_col: str = "tables") -> DataFrame:
    """Inverse of ``assemble_grid``: one row per cell (nulls kept)."""
    r = explode_rows(pages, keys, tables_col)
    return r.select(*keys, "table_no", "row_no", F.posexplode("cells").alias("col_no", "cell"))


def header_value_join(cells: DataFrame, header_row: int, keys=("doc_id", "page_no", "table_no")) -> DataFrame:
    """J6 (long form): header cell of row ``header_row`` next to the value cell
    of the following row in the same column (an equi self-join)."""
    h = cells.where(F.col("row_no") == header_row).select(*keys, "col_no", F.col("cell").alias("header"))
    v = cells.where(F.col("row_no") == header_row + 1).select(*keys, "col_no", F.col("cell").alias("value"))
    return h.join(v, [*keys, "col_no"], "left")


def next_row_long(cells: DataFrame, keys=("doc_id", "page_no", "table_no")) -> DataFrame:
    """P9/W3 (long form): ``lead(cell)`` down each column of each table."""
    w = Window.partitionBy(*keys, "col_no").orderBy("row_no")
    return cells.withColumn("next_cell", F.lead("cell").over(w))
