import pytest
from pyspark.sql import functions as F

from certloom.functions import dates, fields, ids, swl, text


def evaluate(spark, fn, values, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(fn(F.col(df.columns[0]))).collect()]


def as_tuple(r):
    return None if r is None else (r["value"], r["unit"], r["note"])


def test_swl_tight(spark):
    got = evaluate(spark, lambda c: swl.parse_swl(c, "sparrow"),
                   ["5kg", "5 kg", "10kgs SWL", "2.5te @ 90", "10km/h", "5m²", "12XYZ", "7", "n/a",
                    "5t\nfoo", "5t foo\nbar", "1KG"])
    assert [as_tuple(r) for r in got] == [
        ("5", "kg", ""), ("5", None, "kg"), ("10", "kg", "SWL"), ("2.5", "te", "@ 90"),
        ("10", None, "km /h"), ("5", "m", "²"), ("12", None, "XYZ"), ("7", None, ""), (None, None, "n/a"),
        ("5", "t", "foo"), (None, None, "5t foo\nbar"), ("1", None, "KG")]
    assert as_tuple(evaluate(spark, lambda c: swl.parse_swl(c, "centurion_local"), ["1KG"])[0]) == ("1", "KG", "")


def test_swl_loose(spark):
    got = evaluate(spark, lambda c: swl.parse_swl(c, "first_integrated"),
                   ["5 kg", "2.0 Tonnes ", "2.0 tonnes ", "2 Tonne", "3 Kilos"])
    assert [as_tuple(r) for r in got] == [("5", "kg", ""), ("2.0", "te", ""), ("2.0", None, "tonnes"),
                                          ("2", None, "Tonne"), ("3", "kg", "")]


def test_quantities(spark):
    assert evaluate(spark, fields.extract_quantity, [" 4 RIDGEGEAR RGL28", "RIDGE 4", "4"]) == [4, None, None]
    assert evaluate(spark, fields.quantity_cell, ["3.9", "abc"]) == [3, None]


def test_serials_and_labels(spark):
    assert evaluate(spark, fields.serial_clean, ["Serial No(s): A1, B2 , C3"]) == ["A1,B2,C3"]
    assert evaluate(spark, fields.label_value_last, ["a:b:c", "plain"]) == ["c", "plain"]
    assert evaluate(spark, fields.label_value_first, ["a:b:c", "plain"]) == ["b:c", None]


def test_dates(spark):
    assert evaluate(spark, dates.date_plus_180, ["23/02/2024", "1/2/2024", "31/02/2024"]) == \
        ["21/08/2024", "30/07/2024", None]


def test_between(spark):
    assert evaluate(spark, fields.between_matches, ["TZW12 Shackle (blue) 2.0 Tonnes x"]) == ["Shackle "]
    assert evaluate(spark, fields.between_matches, ["TZW12 Shackle"]) == ["Shackle"]
    assert evaluate(spark, lambda c: fields.between_matches(c, compat=True), ["TZW12 Shackle"]) == ["Shackl"]


def render(spark, segs_fn, values, schema="s string"):
    out = evaluate(spark, lambda c: ids.render_ids(segs_fn(c)), values, schema)
    return out


def test_id_generators(spark):
    df = spark.createDataFrame([("1", 4), ("001", 3), ("AB7", 2)], "s string, q int")
    got = [r[0] for r in df.select(ids.render_ids(ids.id_parts("s", "q"))).collect()]
    assert got == [["1", "2", "3", "4"], ["1", "2", "3"], ["AB7", "AB8"]]
    df = spark.createDataFrame([("D971-1 to 6", 3), ("MGL1 to MGL36", 2), ("A1 TO A6", 2), ("A-1-2 to 5", 2)],
                               "s string, q int")
    got = [r[0] for r in df.select(ids.render_ids(ids.id_to_range("s", "q"))).collect()]
    assert got == [["D971-1", "D971-2", "D971-3"], ["MGL1", "MGL2"], ["A1 TO 16", "A1 TO 17"], None]
    assert render(spark, ids.id_multiplier, ["AB12 x3, CD9 x2", "AB1 x2, CD9"]) == \
        [["AB12-1", "AB12-2", "AB12-3", "CD9-1", "CD9-2"], None]
    assert render(spark, ids.id_comma, ["A1, B2"]) == [["A1", " B2"]]
    df = spark.createDataFrame([("ABC1-5",), ("1-5",), ("A-B-C",)], "s string")
    got = [r[0] for r in df.select(ids.render_ids(ids.id_expression("s", F.lit(2), "centurion_local"))).collect()]
    assert got == [["ABC1", "ABC2", "ABC3", "ABC4", "ABC5"], [], ["A-B-C"]]


def test_hyphen_range(spark):
    df = spark.createDataFrame([(v,) for v in ["TZW238-243", "TZW243-238", "TZW007-009", "ABC12-14X", "12-14",
                                               "TZW1/01-04", "TZW1/04-01"]], "s string")
    rows = df.select(ids.id_hyphen_range("s").alias("r")).select(
        ids.render_ids("r.segments").alias("ids"), F.col("r.errors").alias("e")).collect()
    assert rows[0]["ids"] == ["TZW238", "TZW239", "TZW240", "TZW241", "TZW242", "TZW243"]
    assert rows[1]["ids"] == ["TZW243"] and rows[1]["e"] == [
        "Error: End of range (238) is less than start of range (243) for ID number TZW243-238"]
    assert rows[2]["ids"] == ["TZW7", "TZW8", "TZW9"]
    assert rows[3]["ids"] == ["ABC12", "ABC13", "ABC14"]
    assert rows[4]["ids"] == ["12-14"]
    assert rows[5]["ids"] == ["TZW1/01", "TZW1/02", "TZW1/03", "TZW1/04"]
    assert rows[6]["ids"] == ["TZW1/04"] and len(rows[6]["e"]) == 1


def test_text_helpers(spark):
    df = spark.createDataFrame([(["a", None, "b"],)], "r array<string>")
    r = df.select(text.row_text("r"), text.row_text_nonnull("r")).collect()[0]
    assert (r[0], r[1]) == ("a  b", "a b")
    assert evaluate(spark, text.pystrip, [" \t x \n"]) == ["x"]
    assert evaluate(spark, text.pysplit, ["  A b\tc  "]) == [["A", "b", "c"]]
    assert evaluate(spark, text.splitlines, ["a\r\nb\n"]) == [["a", "b"]]


LABEL_BLOCKS = [
    None, "", "Report Number: R1", "report number : a : b\nREPORTNUMBER:c ", "Report Number", " re port num ber :\nx:y",
    "Report Number:\nJob Number: 7:8", "a:b\r\nReport Number: 1\r\nReport No.: 2", "Cust Ref/PO No.: P9\u2028Report Number:z",
    "\tReport Number\t: v\t\n\n", "xReport Number: 1", "Report Number x: 1", "Report\tNumber: 1", "Report Number:a\nReport Number",
    "Cust./Ref PO No: q:r\x0bcustrefpono:last", "Job Number: \u212a", "Report Number:1\n", "Jo\nb Number: 3", ":\n::", "\u212aey: 5"]


def test_label_values_equal_the_entries(spark):
    """One anchored pattern a key gives what the list of entries gives."""
    from certloom.functions import fields
    df = spark.createDataFrame(list(enumerate(LABEL_BLOCKS)), "k int, b string")
    for key in ("reportnumber", "jobnumber", "custrefpono", "key", "x"):
        d = df.select("k", fields.label_lookup(fields.label_entries_last("b"), key).alias("l0"),
                      fields.label_value("b", key, "last").alias("l1"),
                      fields.label_lookup(fields.label_entries_first("b"), key).alias("f0"),
                      fields.label_value("b", key, "first").alias("f1"))
        for r in d.collect():
            assert (r.l0, r.f0) == (r.l1, r.f1), (key, LABEL_BLOCKS[r.k], r)
