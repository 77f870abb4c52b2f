"""Layout fixtures (X1-X7) run through the whole batch pipeline."""

import pytest

from certloom.plans import pipeline
from certloom.plans.carriers import FIXTURE_DICTIONARY, fixture_dictionary
from certloom.sources.readers import PAGE_GRIDS_SCHEMA

N = None


def pages_df(spark, rows):
    return spark.createDataFrame(rows, PAGE_GRIDS_SCHEMA)


SPARROW_TABLE = [
    ["Report Number: R100\nDate of Thorough Examination: 01/02/2024\nJob Number: 77\n"
     "Due Date of Next Thorough Examination: 01/08/2024"],
    ["x"], ["x"],
    ["Identification Number", "Quantity", "Description of Equipment", "SWL"],
    ["D971-1 to 3", "3", "Chain Block TIGER TCB14", "5te"],
]


def run(spark, rows, **kw):
    items, errors, status = pipeline.extract(pages_df(spark, rows), fixture_dictionary(spark),
                                             pipeline.Options(**kw))
    it = {r["id_number"]: r.asDict() for r in items.collect()}
    return it, [r.asDict() for r in errors.collect()], [r.asDict() for r in status.collect()]


def test_sparrow(spark):
    bad = [row[:] for row in SPARROW_TABLE]
    bad[4] = ["A1", "3", "Chain Block TIGER TCB14", "5te"]
    rows = [("d1", "p", 1, "Sparrows certificate", [SPARROW_TABLE]),
            ("d2", "p", 1, "Sparrows certificate", [bad]),
            ("d2", "p", 2, "no table", [])]
    it, errs, status = run(spark, rows)
    for k in ("D971-1", "D971-2", "D971-3"):
        r = it[k]
        assert (r["manufacturer"], r["model"]) == ("Tiger", "TCB14")
        assert (r["swl_value"], r["swl_unit"], r["swl_note"]) == ("5", "te", "")
        assert (r["certificate_no"], r["previous_inspection"], r["next_inspection_due_date"],
                r["provider_identification"]) == ("R100", "01/02/2024", "01/08/2024", "LOFT-77")
        assert r["errors"] == []
    assert it["A1"]["errors"][-2:] == [
        "Error in extracting identification numbers. So, appending the identification number as found in the page",
        "page no: 1"]
    assert len(errs) == 1 and errs[0]["page_no"] == 2 and errs[0]["error"].startswith("No text found on page")
    assert {s["doc_id"]: s["status"] for s in status} == {"d1": "Success", "d2": "Success"}


CENTURION_SINGLE = [
    ["13", "x"] + [N] * 11 + ["Report Number: C55\nDate of Examination: 03/04/2024\nCust Ref/PO No.: P9"],
    ["x"],
    ["Quantity & Description of Equipment, Serial Numbers", N, "Safe Working Load", "Date of next exam",
     "Manufacturer", "Certificate No"],
    ["x"],
    ["Lifting Sling: 2m", N, "2t", "03/10/2024", "Acme", "C1"],
    ["Serial No(s): S1, S2", N],
]


def test_centurion(spark):
    qty = [row[:] for row in CENTURION_SINGLE]
    qty[2] = ["Qty, Description of Equipment, Serial Numbers"] + qty[2][1:]
    qty[4] = ["3 RIDGEGEAR RGL28 lanyard"] + qty[4][1:]
    qty[5] = ["S1,S2,S3"]
    rows = [("c1", "p", 1, "Centurion", [CENTURION_SINGLE]), ("c2", "p", 1, "Centurion", [qty])]
    it, errs, _ = run(spark, rows)
    r = it["S1,S2"]
    assert (r["item_description"], r["manufacturer"], r["model"]) == ("Lifting Sling", "Acme", None)
    assert (r["swl_value"], r["swl_unit"], r["swl_note"]) == ("2", "t", "")
    assert (r["certificate_no"], r["previous_inspection"], r["next_inspection_due_date"],
            r["provider_identification"]) == ("C55", "03/04/2024", "03/10/2024", "P9")
    assert r["errors"] == ["Model not found"]
    assert {"S1", "S2", "S3"} <= set(it) and it["S2"]["model"] == "RGL28"
    assert errs == []


def test_hendrik(spark):
    table = [["x"] for _ in range(15)]
    table[2] = ["Id (x) HK-77 more"]
    table[3] = ["WLL 2.5 t"]
    table[9] = ["Description", N, "Manufacturer"]
    table[10] = ["Shackle: 5", N, "Tiger blocks"]
    table[14] = ["Date 01-02-2024"]
    rows = [("h1", "p", 1, "Centurion Hendrik Certificate No. : 123", [table])]
    it, errs, _ = run(spark, rows)
    r = it["HK-77"]
    assert (r["item_description"], r["manufacturer"], r["model"]) == ("Shackle", "TIGER", None)
    assert (r["swl_value"], r["swl_unit"], r["swl_note"]) == ("2.5", None, "t")
    assert (r["certificate_no"], r["previous_inspection"], r["next_inspection_due_date"]) == \
        ("123", "01/02/2024", None)
    assert r["errors"] == ["Model not found", "SWL Unit not Found"]


def test_first_integrated(spark):
    t1 = [["Name & Address of employer for Whom the examination was made: X", N],
          ["(ABC) TZW12 Shackle (blue) TCB14 2.0 Tonnes", "01/08/2024"],
          ["Report Ref No ABC/123456/12345", "Date of thorough examination 01/02/2024"]]
    t2 = [["Date of Thorough Examination: 01/02/2024", "Report Number: RN1"],
          ["identification of the equipment\nWire Sling TCB14\nTZW238-240", "WLL\na\nb\n2 TONNE"],
          ["Latest date by which next thorough\nexamination must be carried out: 01/08/2024"]]
    t3 = [["Name & Address of Manufacturer: Z", N],
          ["Id Number", "WLL", "Certificate Number"],
          ["TZW1/01-02", "3 TONNES", "CN7"],
          ["Description\nHoist TCB14", N, "Date of Declaration\na\nb\n23/02/2024"]]
    rows = [("f1", "p", 1, "First Integrated", [t1]), ("f2", "p", 1, "First Integrated", [t2]),
            ("f3", "p", 1, "First Integrated", [t3]), ("f3", "p", 2, "First Integrated", [[["junk"]]])]
    it, errs, _ = run(spark, rows)
    r = it["(ABC) TZW12"]
    assert (r["item_description"], r["manufacturer"], r["model"]) == ("Shackle TCB14", "Tiger", "TCB14")
    assert (r["swl_value"], r["swl_unit"], r["swl_note"]) == ("2.0", "te", "")
    assert (r["next_inspection_due_date"], r["previous_inspection"], r["certificate_no"]) == \
        ("01/08/2024", "01/02/2024", "ABC/123456/12345")
    for k in ("TZW238", "TZW239", "TZW240"):
        r = it[k]
        assert (r["item_description"], r["manufacturer"], r["model"]) == ("Wire Sling TCB14", "Tiger", "TCB14")
        assert (r["swl_value"], r["swl_unit"], r["swl_note"]) == ("2", "te", "")
        assert (r["certificate_no"], r["previous_inspection"], r["next_inspection_due_date"]) == \
            ("RN1", "01/02/2024", "01/08/2024")
    for k in ("TZW1/01", "TZW1/02"):
        r = it[k]
        assert (r["item_description"], r["manufacturer"], r["model"]) == ("Hoist TCB14", "Tiger", "TCB14")
        assert (r["swl_value"], r["swl_unit"], r["swl_note"]) == ("3", "te", "")
        assert (r["certificate_no"], r["previous_inspection"], r["next_inspection_due_date"]) == \
            ("CN7", "23/02/2024", "21/08/2024")
    assert [e["error"] for e in errs] == ["No recognized table found on page 2"]


def test_routing_status(spark):
    rows = [("b", "p", 1, "   ", []), ("n", "p", 1, "nothing here", []),
            ("both", "p", 1, "Centurion and Sparrows", [])]
    _, _, status = run(spark, rows)
    st = {s["doc_id"]: (s["client"], s["status"]) for s in status}
    assert st == {"b": (None, "Failure"), "n": (None, "Failure"), "both": ("Sparrows", "Success")}


def test_dictionary_fixture(spark):
    from pyspark.sql import functions as F
    from certloom.operators.dictionary import substring_lookup, token_lookup
    df = spark.createDataFrame([(d,) for d in ["Chain Block TIGER TCB14", "shackle g4163", "MILLER WEBLIFT sling",
                                               "Wire Rope Pulling Machine", "xtcb14y"]], "d string")
    got = {r["d"]: (r["manufacturer"], r["model"]) for r in token_lookup(df, "d", fixture_dictionary(spark)).collect()}
    assert got["Chain Block TIGER TCB14"] == ("Tiger", "TCB14")
    assert got["shackle g4163"] == ("Van Beest", "G4163")
    assert got["MILLER WEBLIFT sling"] == ("Miller Weblift", None)
    assert got["Wire Rope Pulling Machine"] == (None, None)
    sub = {r["d"]: (r["manufacturer"], r["model"]) for r in
           substring_lookup(df, "d", fixture_dictionary(spark)).collect()}
    assert sub["xtcb14y"] == ("Tiger", "TCB14")
    assert FIXTURE_DICTIONARY[0][0] == ("TIGER", "Tiger")


def centurion_table(swl="5KG", serial="Item: Serial No(s): S1"):
    block = "Report Number: C1\nDate of Examination: 01/02/2024\nCust Ref/PO No.: P1"
    return [["13", "x"] + [N] * 11 + [block], ["x"],
            ["Quantity & Description of Equipment, Serial Numbers", N, "Safe Working Load", "Date of next exam",
             "Manufacturer", "Certificate No"], ["x"],
            ["Chain TCB14: 2m", N, swl, "01/08/2024", "Maker", "C9"], [serial, N]]


@pytest.mark.parametrize("variant,ident,unit,note", [
    ("local", "Item:SerialNo(s):S1", "KG", None), ("deployed", "S1", None, "KG")])
def test_centurion_variants(spark, variant, ident, unit, note):
    rows = [("d1", "p", 1, "Centurion certificate", [centurion_table()])]
    it, errs, _ = run(spark, rows, variant=variant)
    assert set(it) == {ident} and not errs
    assert it[ident]["swl_unit"] == unit and (it[ident]["swl_note"] or None) == note
    assert ("SWL Unit not Found" in it[ident]["errors"]) == (unit is None)


def test_first_integrated_pages_without_ids(spark):
    declaration = [["Name & Address of Manufacturer: Z", N], ["Id Number", "WLL"], ["TZW1", "5 TONNES"],
                   ["Certificate Number", N]]
    rows = [("d1", "p", 1, "First Integrated", [[["Date of Thorough Examination: 01/02/2024", N]]]),
            ("d2", "p", 1, "First Integrated", [[["Name & Address of employer for Whom the examination was made", N],
                                                 ["nothing", N]]]),
            ("d3", "p", 1, "First Integrated", [declaration])]
    it, errs, _ = run(spark, rows)
    assert sorted(e["doc_id"] for e in errs) == ["d1", "d2"]
    assert set(it) == {"TZW1"}
    # no Description label: no dictionary errors; the certificate label has no row below
    assert it["TZW1"]["errors"] == ["Certificate Number not found", "for ID: TZW1"]


def test_document_without_first_page(spark):
    rows = [("d1", "p", 2, "Sparrows certificate", [SPARROW_TABLE]), ("d2", "p", 1, "Sparrows certificate", [])]
    it, errs, status = run(spark, rows)
    assert not it
    got = {s["doc_id"]: (s["status"], s["reason"]) for s in status}
    assert got == {"d1": ("Failure", "no first page"), "d2": ("Success", None)}
