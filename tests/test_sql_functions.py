from pyspark.sql import functions as F

from certloom.functions import swl
from certloom.functions.sql import register_sql_functions


def test_sql_functions_match_column_functions(spark):
    names = register_sql_functions(spark)
    assert "swl_value" in names and "date_plus_180" in names
    vals = ["5kg", "5 kg", "10kgs SWL", "2.5te @ 90", "10km/h", "12XYZ", "7", "n/a", "2.0 Tonnes "]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    df.createOrReplaceTempView("swl_cases")
    got = spark.sql("SELECT t, swl_value(t) v, swl_unit(t) u, swl_note(t) n, swl_unit_loose(t) ul FROM swl_cases")
    p = swl.parse_swl(F.col("t"), swl.SPARROW)
    pl = swl.parse_swl(F.col("t"), swl.FIRST_INTEGRATED)
    exp = df.select("t", p["value"].alias("v"), p["unit"].alias("u"), p["note"].alias("n"), pl["unit"].alias("ul"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))
    r = spark.sql("SELECT date_plus_180('23/02/2024') a, extract_quantity(' 4 RIDGEGEAR') b, "
                  "description_head('Sling: 2m') c").collect()[0]
    assert (r["a"], r["b"], r["c"]) == ("21/08/2024", 4, "Sling")
