"""IDs that cannot meet are not sorted one by one (pipeline.expand_apart)."""

from pyspark.sql import functions as F

from certloom.functions import ids
from certloom.operators.expand import explode_ids
from certloom.plans import pipeline as pl
from certloom.plans.layouts import ITEM_TYPE
from certloom.sources import commits

SEGS = [  # doc, page, (prefix, start, n, suffix, pad)
    ("a", 1, [("MGL", 5, 3, "", 0), ("CD-", 1, 2, "", 0)]), ("a", 2, [("MGL", 8, 2, "", 0), ("MGL", None, 1, "", 0)]),
    ("same", 1, [("S7", None, 1, "", 0), ("X", 1, 3, "", 0)]), ("same", 2, [("S7", None, 1, "", 0), ("X", 1, 3, "", 0)]),
    ("same", 3, [("Z", 1, 1, "", 0)]),
    ("over", 1, [("MGL", 5, 3, "", 0)]), ("over", 2, [("MGL", 7, 3, "", 0)]), ("over", 3, [("MGL6", None, 1, "", 0)]),
    ("pad", 1, [("X/", 1, 3, "", 2)]), ("pad", 2, [("X/01", None, 1, "", 0)]),
    ("tail", 1, [("", 1, 3, "AB", 0)]), ("tail", 2, [("1AB", None, 1, "", 0)]),
    ("digits", 1, [("ABC1", 2, 3, "", 0)]), ("digits", 2, [("ABC13", None, 1, "", 0)]),
    ("alone", 1, [("", 1, 3, "AB", 0)]), ("none", 1, [(None, None, 1, "", 0)]), ("none", 2, [(None, None, 1, "", 0)]),
]


def _outcomes(spark):
    names = [f.split(":")[0] for f in ITEM_TYPE[len("struct<"):].split(",") if ":" in f]
    rows = spark.createDataFrame(SEGS, f"doc_id string, page_no int, segs array<{ids.SEGMENT_TYPE.replace('decimal(38,0)', 'int')}>")
    kind = spark.sql(f"SELECT CAST(NULL AS {ITEM_TYPE}) AS i").schema["i"].dataType
    given = {"table_no": F.lit(0), "row_no": F.lit(4), "id_segments": F.col("segs"),
             "certificate_no": F.concat("doc_id", F.col("page_no").cast("string")), "err_head": F.array(),
             "err_tail": F.array(), "suffix_always": F.array(), "suffix_if_any": F.array(), "dict_errors": F.lit(False)}
    item = F.struct(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kind.fields])
    assert names[0] == "table_no"
    return rows.select("doc_id", "page_no", F.lit("Sparrows").alias("client"),
                       F.struct(F.array(item).alias("items"), F.lit(None).cast("string").alias("error")).alias("outcome"))


def test_meeting_documents(spark):
    got = {r.doc_id for r in pl.meeting_documents(_outcomes(spark)).collect()}
    assert got == {"over", "pad", "tail", "digits"}


def test_apart_and_in_place_agree(spark):
    out = _outcomes(spark)
    items = pl.raw_items_of(out).withColumn("errors", F.array().cast("array<string>")).withColumn(
        "errors_text", F.lit(None).cast("string"))
    cols = ["doc_id", "id_number", "certificate_no", "first_pos", "place_no"]
    w = pl.document_weights(out)
    got = pl.expand_and_reduce(items, weights=w, numbered=True, outcomes=out).select(cols).collect()
    want = pl.expand_and_reduce(items, weights=w, numbered=True).select(cols).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert len(got) == len({(r.doc_id, r.id_number) for r in got})


def test_long_segments_are_dealt_as_few_rows(spark):
    df = spark.createDataFrame([(1, [("A", 1, 100_000, "", 0)])], f"k int, segs array<{ids.SEGMENT_TYPE.replace('decimal(38,0)', 'int')}>")
    x = explode_ids(df.select("k", F.col("segs").cast(f"array<{ids.SEGMENT_TYPE}>").alias("segs")), "segs", tasks=3)
    got = x.withColumn("p", F.spark_partition_id()).agg(
        F.count("*").alias("n"), F.countDistinct("id_number").alias("d"), F.max("id_idx").alias("m"),
        F.countDistinct("p").alias("p")).first()
    assert (got.n, got.d, got.m, got.p) == (100_000, 100_000, 99_999, 1)


def test_last_commit_is_read_without_a_join(spark, tmp_path):
    target = str(tmp_path / "t")

    def write(pairs):
        d = spark.createDataFrame(pairs, "doc_id string, v int")
        commits.write_commit({"items": d}, d, target)
    write([("a", 1)])
    write([("b", 2)])
    apart = commits.read_table(spark, target, "items")
    assert "Join" not in apart._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, apart.collect())) == [("a", 1), ("b", 2)]
    write([("a", 3), ("c", 4)])
    assert sorted(map(tuple, commits.read_table(spark, target, "items").collect())) == [("a", 3), ("b", 2), ("c", 4)]
