"""Sinks: K1-K6.

The item table keeps its 18 fixed display columns (in order).  Each run date
has an append-only target (``sources.commits``): a write adds one commit with
all tables of the documents it processed, and a reader sees each document's
last one, so a replayed or re-sent file, a second batch or a second run of the
same day neither loses nor doubles anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reduce import number_block, number_rows
from .commits import Commit, read_table, write_commit

# The output columns of the item sheet, in sheet order
# (note the trailing space of "Detailed Location ").
DISPLAY_COLUMNS = [
    "Id Number", "RFID", "Item Category", "Item Description", "Model", "SWL Value", "SWL Unit", "SWL Note",
    "Manufacturer", "Certificate No", "Location", "Detailed Location ", "Previous Inspection",
    "Next Inspection Due Date", "Fit For Purpose Y/N", "Status", "Provider Identification", "Errors",
]
# Which internal column feeds each display column (None: never filled).
SOURCE_OF = {
    "Id Number": "id_number", "Item Description": "item_description", "Model": "model", "SWL Value": "swl_value",
    "SWL Unit": "swl_unit", "SWL Note": "swl_note", "Manufacturer": "manufacturer",
    "Certificate No": "certificate_no", "Previous Inspection": "previous_inspection",
    "Next Inspection Due Date": "next_inspection_due_date", "Provider Identification": "provider_identification",
    "Errors": "errors_text",
}
# The import preamble of every item sheet.
PREAMBLE = ("Rig-Ware import v2", "CreateLocations=No")
FIRST_DATA_ROW = 3


def render_list(arr) -> F.Column:
    """``str(list_of_str)`` as Python prints it (single quotes unless a text
    holds a single quote and no double quote)."""
    def rep(e):
        esc = F.replace(F.replace(e, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
        dq = esc.contains("'") & ~esc.contains('"')
        return F.when(dq, F.concat(F.lit('"'), esc, F.lit('"'))).otherwise(
            F.concat(F.lit("'"), F.replace(esc, F.lit("'"), F.lit("\\'")), F.lit("'")))
    return F.concat(F.lit("["), F.array_join(F.transform(arr, rep), ", "), F.lit("]"))


def render_errors(arr) -> F.Column:
    """The error texts as the sheet shows them; null when there are none."""
    return F.when(F.size(arr) > 0, render_list(arr))


def item_sheet(items: DataFrame, skew_safe: bool = True) -> DataFrame:
    """The 18 display columns plus ``doc_id``, ``client`` and the
    sheet row number (3, 4, ... in first-seen order within each document).  Items that come with their ``place_no``
    are written as they are; others are stored once and shuffled once, by document, grid row and stretch of IDs."""
    d = items if "errors_text" in items.columns else items.withColumn("errors_text", render_errors(F.col("errors")))
    if "place_no" in d.columns:
        d = d.withColumn("sheet_row", F.col("place_no") + (FIRST_DATA_ROW - 1))
    else:
        d = number_rows(d, "doc_id", "first_pos", "sheet_row", start=FIRST_DATA_ROW, block=number_block(),
                        skew_safe=skew_safe)
    cols = [(F.col(SOURCE_OF[c]) if c in SOURCE_OF else F.lit(None).cast("string")).alias(c)
            for c in DISPLAY_COLUMNS]
    return d.select("doc_id", "client", "sheet_row", *cols)


def page_error_sheet(page_errors: DataFrame) -> DataFrame:
    """K2: ``Page No`` / ``Error`` per document."""
    return page_errors.select("doc_id", "client", F.col("page_no").alias("Page No"), F.col("error").alias("Error"))


def manifest(status: DataFrame) -> DataFrame:
    """K3: one preamble row per processed document."""
    ok = status.where(F.col("status") == "Success")
    return ok.select("doc_id", F.lit(PREAMBLE[0]).alias("A1"), F.col("client").alias("B1"),
                     F.lit(PREAMBLE[1]).alias("C1"))


def output_name(path, ext: str = "xlsx", compat: bool = False) -> F.Column:
    """K5: output name from the input name (extension only; ``compat``
    replaces every ``pdf`` as the deployed rules do)."""
    p = F.col(path) if isinstance(path, str) else path
    if compat:
        return F.replace(p, F.lit("pdf"), F.lit(ext))
    return F.regexp_replace(p, r"\.pdf$", "." + ext)


def write_all(items: DataFrame, page_errors: DataFrame, status: DataFrame, out_dir: str, run_date: str) -> Commit:
    """K1-K6 in one commit of the run date's target: item sheet, page errors, manifest and document status of the
    documents of ``status`` (every processed document has a status row)."""
    tables = {"items": item_sheet(items), "page_errors": page_error_sheet(page_errors), "manifest": manifest(status),
              "document_status": status.drop("run_date")}
    return write_commit(tables, status.select("doc_id"), target(out_dir, run_date))


def target(out_dir: str, run_date: str) -> str:
    """K4: the folder of one run date."""
    return f"{out_dir.rstrip('/')}/{run_date}"


def read_sheet(spark: SparkSession, out_dir: str, run_date: str, table: str) -> DataFrame:
    """The current rows of ``items``, ``page_errors``, ``manifest`` or ``document_status`` of a run date."""
    return read_table(spark, target(out_dir, run_date), table).withColumn("run_date", F.lit(run_date))
