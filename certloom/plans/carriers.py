"""Certificate inputs derived from the benchmark tables.

The benchmark ships TPC-H-style tables, not certificates, so every registered
query first derives certificate-shaped data from them with plain DataFrame
expressions: the ``fx`` view (capacity text, ID expressions, label blocks and
dates per ``lineitem`` row), a description per line from ``part``, and page
grids in each client layout.  Everything grows with ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.dictionary import Dictionary
from ..session import store

# The dictionary used by the tests and the derived queries.
# Sheet "Manufacture": (keyword, canonical); sheet "Model": (model, manufacturer).
FIXTURE_DICTIONARY = (
    [("TIGER", "Tiger"), ("MILLER", "Miller"), ("RIDGEGEAR", "Ridgegear"), ("red", "Redline"), ("Blue", ""),
     ("hot", "Hotworks"), ("OLD", "Oldham"), ("small", None)],
    [("TCB14", "Tiger"), ("RGL28", "Ridgegear"), ("G4163", "Van Beest"), ("GEAR", "Geartech"),
     ("anvil", "Anvilco"), ("Bolt", ""), ("rod", "Rodmakers"), ("ring", "Ringers"), ("ge", "Gecko")],
)


def fixture_dictionary(spark: SparkSession) -> Dictionary:
    return Dictionary.from_rows(spark, *FIXTURE_DICTIONARY)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c):
    return c.cast("string")


def _dmy(ts):
    return F.concat(F.lpad(_s(F.dayofmonth(ts)), 2, "0"), F.lit("/"), F.lpad(_s(F.month(ts)), 2, "0"), F.lit("/"),
                    _s(F.year(ts)))


def cert_view(lineitem: DataFrame, *more: Column) -> DataFrame:
    """The ``fx`` view: certificate fields derived from each lineitem row, and ``more`` columns of the row."""
    q = F.col("l_quantity").cast("int")
    qs = _s(q)
    ln, pk, sk, ok = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey")
    swl_suffix = (F.when(ln == 1, "kgs").when(ln == 2, ".5te @ 90").when((ln == 3) & (q % 2 == 1), "KG").when(ln == 3, " kg").when(ln == 4, "XX note")
                  .when(ln == 5, "").when(ln == 6, " Tonnes ").otherwise("KG"))
    m5 = ln % 5
    id_text = (F.when(m5 == 0, F.concat(F.lit("D"), _s(sk), F.lit("-1 to "), qs))
               .when(m5 == 1, F.concat(F.lit("MGL"), _s(pk), F.lit(" to MGL"), _s(pk + 5)))
               .when(m5 == 2, F.concat(F.lit("AB"), _s(sk), F.lit(" x3, CD"), _s(pk), F.lit(" x2")))
               .when(m5 == 3, F.concat(F.lit("A"), _s(pk), F.lit(",B"), _s(sk)))
               .otherwise(F.concat(F.lit("S"), _s(ok))))
    m4 = ln % 4
    range_text = (F.when(m4 == 0, F.concat(F.lit("TZW"), _s(sk), F.lit("-"), _s(sk + 6)))
                  .when(m4 == 1, F.concat(F.lit("TZW"), _s(sk + 9), F.lit("-"), _s(sk)))
                  .when(m4 == 2, F.concat(F.lit("TZW"), _s(sk), F.lit("/01-0"), _s(ln)))
                  .otherwise(F.concat(F.lit("ZZ-"), _s(sk))))
    date_text = _dmy(F.col("l_shipdate"))
    header_block = F.concat(F.lit("Report Number: R"), _s(ok), F.lit("\n"),
                            F.lit("Date of Thorough Examination : "), date_text, F.lit("\n"),
                            F.lit("Job Number: "), _s(sk), F.lit(":"), _s(ln))
    return lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", q.alias("qty"),
        F.concat(qs, swl_suffix).alias("swl_text"), id_text.alias("id_text"), range_text.alias("range_text"),
        header_block.alias("header_block"), date_text.alias("date_text"), *more)


def fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cert_view(table(spark, sf_dir, "lineitem"))


#: The columns of :func:`numbered` that the pages' keys and texts are made from; all others only reach their grids.
TEXT_COLUMNS = ("l_orderkey", "page_no")


#: Lines that one task makes pages of and reads, where pages are made by document.
TASK_LINES = 1 << 16


def document_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks that pages are made by document in: more with more lines, so that each holds a bounded number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), table(spark, sf_dir, "lineitem").count() // TASK_LINES + 1)


def numbered(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """Each ``lineitem`` row with its part's name and a 1-based page number per order (lines ordered by line
    number, part, supplier: that key is unique, so page numbers are deterministic).  Only the numbers that ``fx``
    reads are shuffled; texts are made from them afterwards.  ``tasks``: the rows are partitioned by document, by the
    same shuffle."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    document = _s(F.col("l_orderkey")) if tasks else F.col("l_orderkey")
    w = Window.partitionBy(document).orderBy("l_linenumber", "l_partkey", "l_suppkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                                    "l_quantity", "l_shipdate")
    lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left").drop("p_partkey")
    if tasks:
        lines = lines.repartition(tasks, document)
    return lines.withColumn("page_no", F.row_number().over(w).cast("int"))


def described(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """fx plus a per-line equipment description from ``part``, the document and the page number; ``lines``: the
    :func:`numbered` rows, where they are stored already or partitioned by document."""
    ln = F.col("l_linenumber")
    desc = F.concat(F.col("p_name"), F.when(ln % 3 == 0, F.lit(" MILLER weblift")).when(
        ln % 3 == 1, F.lit(" TCB14")).otherwise(F.lit("")))
    d = cert_view(numbered(spark, sf_dir) if lines is None else lines, F.when(ln != 7, desc).alias("description"),
                  F.col("page_no"))
    return d.withColumn("doc_id", _s(F.col("l_orderkey")))


def materialize(df: DataFrame) -> DataFrame:
    """Store derived page grids once (compressed, under ``spark.checkpoint.dir``).  Layouts then read ``tables`` as
    a stored column, as they do with real page grids, instead of an expression tree that Catalyst would inline into
    every cell access."""
    return store(df, "grids")


def apart(pages: DataFrame) -> DataFrame:
    """Derived pages for one reader, not stored: a generator keeps Catalyst from inlining the grid's expression tree
    into the layouts, and the partitioning by document stays."""
    return pages.select("doc_id", "path", "page_no", F.inline(F.array(F.struct("text", "tables"))))


def _pages(df: DataFrame, text, grid, lines: DataFrame | None, n_tables=1) -> DataFrame:
    """The page table; stored, but for one made from given ``lines``: its reader stores it (``mixed_pages``) or reads
    it once (:func:`apart`)."""
    tables = F.array(grid) if isinstance(n_tables, int) else F.slice(F.array(grid), 1, n_tables)
    pages = df.select("doc_id", F.lit("derived").alias("path"), "page_no", text.alias("text"), tables.alias("tables"))
    return materialize(pages) if lines is None else pages


def sparrow_pages(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """X1 grids: label block in r0, headers in r3, values in r4."""
    d = described(spark, sf_dir, lines)
    grid = F.array(F.array(F.col("header_block")), F.array(F.lit("x")), F.array(F.lit("x")),
                   F.array(*[F.lit(h) for h in ("Identification Number", "Quantity", "Description of Equipment",
                                                "SWL")]),
                   F.array(F.col("id_text"), _s(F.col("qty")), F.col("description"), F.col("swl_text")))
    no_table = (F.col("l_linenumber") == 6) & (F.col("qty") % 2 == 0)
    return _pages(d, F.lit("Sparrows inspection certificate"), grid, lines, F.when(no_table, 0).otherwise(1))


def centurion_pages(spark: SparkSession, sf_dir: str, qty_layout: bool = False,
                    lines: DataFrame | None = None) -> DataFrame:
    """X2/X3 grids: label block in r0[13], headers r2, values r4, serials r5."""
    d = described(spark, sf_dir, lines)
    nulls = [F.lit(None).cast("string")] * 11
    block = F.concat(F.lit("Report Number: C"), _s(F.col("l_orderkey")), F.lit("\nDate of Examination: "),
                     F.col("date_text"), F.lit("\nCust Ref/PO No.: P"), _s(F.col("l_suppkey")))
    head = ("Qty, Description of Equipment, Serial Numbers" if qty_layout
            else "Quantity & Description of Equipment, Serial Numbers")
    first_cell = (F.concat(_s(F.col("qty")), F.lit(" "), F.col("description")) if qty_layout
                  else F.concat(F.col("description"), F.lit(": "), _s(F.col("qty")), F.lit("m")))
    serial = (F.col("id_text") if qty_layout else F.concat(F.lit("Serial No(s): "), F.col("id_text")))
    grid = F.array(
        F.array(F.lit("13"), F.lit("x"), *nulls, block),
        F.array(F.lit("x")),
        F.array(F.lit(head), F.lit(None).cast("string"), F.lit("Safe Working Load"), F.lit("Date of next exam"),
                F.lit("Manufacturer"), F.lit("Certificate No")),
        F.array(F.lit("x")),
        F.array(first_cell, F.lit(None).cast("string"), F.col("swl_text"), F.col("date_text"),
                F.concat(F.lit("Maker"), _s(F.col("l_suppkey"))), F.concat(F.lit("C"), _s(F.col("l_partkey")))),
        F.array(serial, F.lit(None).cast("string")))
    return _pages(d, F.lit("Centurion lifting certificate"), grid, lines)


def _sa(*cells):
    return F.array(*[c if not isinstance(c, str) else F.lit(c) for c in cells])


def _null():
    return F.lit(None).cast("string")


def hendrik_pages(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """X4 grids: ID after a parenthesis in r2, capacity in r3, description and
    maker under r9's labels in r10, dashed date in r14."""
    d = described(spark, sf_dir, lines)
    ln, x = F.col("l_linenumber"), _sa("x")
    rows = [x] * 15
    rows[2] = _sa(F.concat(F.lit("Id ("), _s(ln), F.lit(") HK-"), _s(F.col("l_orderkey")), F.lit("-"),
                           _s(F.col("l_partkey")), F.lit(" more")))
    rows[3] = _sa(F.concat(F.lit("WLL "), F.col("swl_text")))
    rows[9] = _sa("Description", _null(), "Manufacturer")
    rows[10] = _sa(F.col("description"), _null(), F.when(ln % 2 == 0, F.lit("Tiger blocks")).otherwise(
        F.lit("red MILLER")))
    rows[14] = _sa(F.concat(F.lit("Date "), F.replace(F.col("date_text"), F.lit("/"), F.lit("-"))))
    text = F.concat(F.lit("Centurion Hendrik Certificate No. : "), _s(F.col("l_orderkey")))
    return _pages(d, text, F.array(*rows), lines)


def first_integrated_pages(spark: SparkSession, sf_dir: str, kind: str, lines: DataFrame | None = None) -> DataFrame:
    """X5 (``register``), X6 (``cells``) and X7 (``declaration``) grids."""
    d = described(spark, sf_dir, lines)
    ok, pk, sk, qty = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "qty"))
    desc, date, rng = F.col("description"), F.col("date_text"), F.col("range_text")
    if kind == "register":
        item_row = F.concat(F.when(F.col("l_linenumber") % 2 == 0, F.lit("(AB) ")).otherwise(F.lit("")),
                            F.lit("TZW"), _s(sk), F.lit(" "), desc, F.lit(" ("), _s(pk), F.lit(") "), _s(qty),
                            F.lit(".0 Tonnes"))
        second = F.when(F.col("l_linenumber") % 3 != 0, F.concat(
            F.lit("TZX"), _s(pk), F.lit(" spare ring ("), _s(sk), F.lit(") "), _s(qty), F.lit(".5 Kilos")))
        tbl = F.array(_sa("Name & Address of employer for Whom the examination was made: X", _null()),
                      _sa(item_row, date), F.array(second, date),
                      _sa(F.concat(F.lit("Report Ref No ABC/"), F.lpad(_s(ok), 6, "0"), F.lit("/"),
                                   F.lpad(_s(pk), 5, "0")),
                          F.concat(F.lit("Date of thorough examination "), date)))
    elif kind == "cells":
        tbl = F.array(_sa(F.concat(F.lit("Date of Thorough Examination: "), date),
                          F.concat(F.lit("Report Number: RN"), _s(ok))),
                      _sa(F.concat(F.lit("identification of the equipment\n"), desc, F.lit("\n"), rng),
                          F.concat(F.lit("WLL\na\nb\n"), _s(qty), F.lit(" TONNE"))),
                      _sa(F.concat(F.lit("Latest date by which next thorough\nexamination must be carried out: "),
                                   date)))
    elif kind == "declaration":
        tbl = F.array(_sa("Name & Address of Manufacturer: Z", _null()),
                      _sa("Id Number", "WLL", "Certificate Number"),
                      _sa(rng, F.concat(_s(qty), F.lit(" TONNES")), F.concat(F.lit("CN"), _s(pk))),
                      _sa(F.concat(F.lit("Description\n"), desc), _null(),
                          F.concat(F.lit("Date of Declaration\na\nb\n"), date)))
    else:
        raise ValueError(kind)
    return _pages(d, F.lit("First Integrated certificate"), tbl, lines)
