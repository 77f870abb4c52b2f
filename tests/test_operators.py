"""Operator properties: expansion counts, last-wins invariance, skew-safe numbering, streaming replay."""

import os
import tempfile

from pyspark.sql import functions as F

from certloom.functions import ids
from certloom.operators.expand import explode_ids
from certloom.operators.reduce import last_wins, number_rows


def test_expansion_count_and_chunking(spark):
    df = spark.createDataFrame([("d", "TZW1-25000"), ("e", "AB3 x5, CD1 x2")], "doc string, s string")
    segs = F.when(F.col("doc") == "d", F.col("r.segments")).otherwise(ids.id_multiplier("s"))
    d = df.select("doc", ids.id_hyphen_range("s").alias("r"), "s").select("doc", segs.alias("segs"))
    counts = {r["doc"]: r["n"] for r in d.select("doc", ids.segment_count("segs").alias("n")).collect()}
    assert counts == {"d": 25000, "e": 7}
    out = explode_ids(d, "segs", chunk_size=1000, rebalance_cols=["doc"])
    got = out.groupBy("doc").agg(F.count("*").alias("n"), F.countDistinct("id_idx").alias("k"),
                                 F.min("id_idx").alias("lo"), F.max("id_idx").alias("hi")).collect()
    got = {r["doc"]: (r["n"], r["k"], r["lo"], r["hi"]) for r in got}
    assert got == {"d": (25000, 25000, 0, 24999), "e": (7, 7, 0, 6)}
    first = out.where((F.col("doc") == "d") & (F.col("id_idx") == 24999)).collect()[0]["id_number"]
    assert first == "TZW25000"


def test_last_wins_keeps_first_position(spark):
    rows = [("doc", "A", 1, "p1"), ("doc", "B", 1, "p1b"), ("doc", "A", 2, "p2")]
    df = spark.createDataFrame(rows, "doc_id string, id string, pos int, v string")
    for parts in (1, 3):
        r = {x["id"]: (x["first_pos"], x["v"]) for x in
             last_wins(df.repartition(parts), ["doc_id", "id"], "pos", ["v"]).collect()}
        assert r == {"A": (1, "p2"), "B": (1, "p1b")}


def test_skew_safe_numbering_matches_window(spark):
    big = spark.range(0, 5000).select(F.lit("hot").alias("doc"), F.col("id").alias("pos"))
    small = spark.range(0, 300).select((F.col("id") % 7).cast("string").alias("doc"), F.col("id").alias("pos"))
    df = big.unionByName(small).repartition(8)
    a = number_rows(df, "doc", "pos", "rn", start=3)
    b = number_rows(df, "doc", "pos", "rn2", start=3, skew_safe=False)
    j = a.join(b, ["doc", "pos"])
    assert j.count() == 5300
    assert j.where(F.col("rn") != F.col("rn2")).count() == 0


def test_stream_replay_is_idempotent(spark):
    from certloom.plans.carriers import fixture_dictionary
    from certloom.sources.readers import PAGE_GRIDS_SCHEMA
    from certloom.sources.sinks import read_sheet
    from certloom.streaming.ingest import start_ingest
    base = tempfile.mkdtemp(prefix="certloom-stream-", dir="/tmp")
    table = [["Report Number: R1\nDate of Thorough Examination: 01/02/2024\nJob Number: 7"], ["x"], ["x"],
             ["Identification Number", "Quantity", "Description of Equipment", "SWL"],
             ["MGL1 to MGL9", "3", "Chain Block TIGER TCB14", "5te"]]
    pages = spark.createDataFrame([(f"d{i}", "p", 1, "Sparrows", [table]) for i in range(4)], PAGE_GRIDS_SCHEMA)
    pages.repartition(2, "doc_id").write.parquet(os.path.join(base, "in"))
    for ck in ("c1", "c2"):
        start_ingest(spark, os.path.join(base, "in"), os.path.join(base, "out"), os.path.join(base, ck),
                     fixture_dictionary(spark), "2024-01-01").awaitTermination()
    out = read_sheet(spark, os.path.join(base, "out"), "2024-01-01", "items")
    assert out.count() == 12
    assert sorted(r["sheet_row"] for r in out.where(F.col("doc_id") == "d0").collect()) == [3, 4, 5]


def test_long_numbers_never_vanish(spark):
    n = "1" * 39
    texts = [f"TZW{n}-{n}", f"TZW{n}-{n[:-1]}3", "TZW1-99999999999999999999", f"TZW{n}-5", "X1/01-03"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, s string")
    d = df.select("k", ids.id_hyphen_range("s").alias("r"))
    out = explode_ids(d.select("k", F.col("r.segments").alias("g"), F.size("r.errors").alias("e")), "g")
    got = {}
    for r in out.orderBy("k", "id_idx").collect():
        got.setdefault((r.k, r.e), []).append(r.id_number)
    assert got == {
        (0, 0): [f"TZW{n}"], (1, 0): [f"TZW{n}", f"TZW{n[:-1]}2", f"TZW{n[:-1]}3"], (2, 1): [texts[2]],
        (3, 1): [f"TZW{n}"], (4, 0): ["X1/01", "X1/02", "X1/03"]}
    parts = spark.createDataFrame([(f"MGL{n}",)], "s string").select(ids.id_parts("s", F.lit(2)).alias("g"))
    assert [r.id_number for r in explode_ids(parts, "g").orderBy("id_idx").collect()] == [
        f"MGL{n}", f"MGL{n[:-1]}2"]


def test_packed_positions(spark):
    from certloom.operators.reduce import pack_position, position_part
    big = 2**31 - 1
    rows = [(1, 0, 4, 0), (1, 0, 4, 99_999_999), (1, 0, 70_000, 0), (1, 70_000, 0, 3), (big, big, big, 7), (1, 2, 0, 0)]
    df = spark.createDataFrame(rows, "page int, tbl int, rw int, seg int")
    out = df.withColumn("p", pack_position("page", "tbl", "rw", "seg"))
    got = out.select("page", "tbl", "rw", "seg", *[position_part("p", i).alias(f"x{i}") for i in range(3)]).orderBy("p")
    assert [tuple(r) for r in got.collect()] == [r + r[:3] for r in sorted(rows)]


def test_last_wins_on_far_rows(spark):
    """Rows past 65,535, IDs named twice in one item, and a document of a million IDs."""
    from certloom.operators.reduce import last_wins_ids
    place = "doc_id string, page_no int, table_no int, row_no int"
    items = spark.createDataFrame(
        [("d", 1, 0, 70_000, "x"), ("d", 1, 0, 5, "y"), ("d", 1, 1, 0, "z"), ("h", 1, 0, 0, "v")], place + ", v string")
    segments = spark.createDataFrame(
        [("d", 1, 0, 70_000, "A1,A1,B"), ("d", 1, 0, 5, "A1"), ("d", 1, 1, 0, "C")], place + ", s string")
    listed = segments.select(*items.columns[:4], ids.id_comma("s").alias("g"))
    million = spark.createDataFrame([("h", 1, 0, 0)], place).select("*", F.array(ids.segment(
        F.lit("R"), F.lit(1), F.lit(1_000_000))).alias("g"))
    x = explode_ids(listed.unionByName(million), "g", rebalance_cols=items.columns[:4], segment_col="segment")
    out = last_wins_ids(x, items, ["v"])
    small = {(r.id_number, r.v, r.first_pos.row_no, r.first_pos.id_idx) for r in out.where("doc_id = 'd'").collect()}
    assert small == {("A1", "x", 5, 0), ("B", "x", 70_000, 2), ("C", "z", 0, 0)}
    assert out.where("doc_id = 'h'").agg(F.count("*"), F.max("first_pos.id_idx")).first()[:] == (1_000_000, 999_999)


def test_only_large_ranges_are_shuffled(spark):
    df = spark.createDataFrame([(1, "A1-3"), (2, "B7"), (3, "C1-9000")], "k int, s string").select(
        "k", ids.id_hyphen_range("s")["segments"].alias("g"))
    one = explode_ids(df.where("k < 3"), "g", chunk_size=4, rebalance_cols=["k"]).collect()
    assert sorted((r.k, r.id_number) for r in one) == [(1, "A1"), (1, "A2"), (1, "A3"), (2, "B7")]
    many = explode_ids(df, "g", chunk_size=4, rebalance_cols=["k"])
    assert many.count() == 9004 and many.select("id_number").distinct().count() == 9004


def test_offsets_of_many_pieces(spark):
    """Each segment's offset, past a block of segments, with empty segments and in linear time."""
    import time
    n = 50_000
    df = spark.createDataFrame([(1, ",".join(f"P{i}x{i % 3}" for i in range(n))), (2, "Ax2,Bx3"), (3, ",".join("Qx2" for _ in range(600)))],
                               "k int, s string").select("k", ids.id_multiplier("s").alias("g"))
    start = time.time()
    got = explode_ids(df, "g").groupBy("k").agg(F.count("*").alias("n"), F.countDistinct("id_idx").alias("d"),
                                                F.max("id_idx").alias("m")).orderBy("k").collect()
    total = sum(i % 3 for i in range(n))
    assert [tuple(r) for r in got] == [(1, total, total, total - 1), (2, 5, 5, 4), (3, 1200, 1200, 1199)]
    assert time.time() - start < 60


def test_last_id_without_listing(spark):
    df = spark.createDataFrame([("TZW1-5000000000",), ("X1/01-04",), ("plain",)], "s string")
    got = [r[0] for r in df.select(ids.last_id(ids.id_hyphen_range("s")["segments"])).collect()]
    assert got == ["TZW5000000000", "X1/04", "plain"]
    assert spark.range(1).select(ids.last_id(F.array().cast(f"array<{ids.SEGMENT_TYPE}>"))).first()[0] is None


def test_numbering_over_blocks(spark):
    """A hot document whose rows are on many pages, one of them large."""
    df = spark.range(0, 20_000).select(F.lit("hot").alias("doc"), F.struct(
        F.when(F.col("id") < 9000, F.lit(3)).otherwise(F.col("id") % 50 + 4).alias("page"), F.col("id").alias("i")).alias("pos"))
    df = df.unionByName(df.where("pos.i % 7 = 0").withColumn("doc", F.lit("small"))).repartition(8)
    block = F.struct(F.col("pos.page").alias("p"), F.floor(F.col("pos.i") / 1000).alias("b"))
    a = number_rows(df, "doc", "pos", "rn", start=3, block=block)
    b = number_rows(df, "doc", "pos", "rn2", start=3, skew_safe=False)
    assert a.join(b, ["doc", "pos"]).where("rn = rn2").count() == df.count()


def test_substring_lookup_with_many_keywords(spark):
    """A long text and 10,000 keywords: rows follow the distinct grams, and only near candidates are verified."""
    from certloom.operators.dictionary import Dictionary, gram_index, substring_lookup, text_grams
    models = [(f"KW{i:05d}X", f"M{i}") for i in range(10_000)] + [("ab", "Two"), ("q", "One"), ("", "None"), ("Kw00007", "Late")]
    d = Dictionary.from_rows(spark, [], models)
    long = " ".join(f"word{i % 500} kw{i % 40:05d}y" for i in range(20_000))
    texts = [(1, long), (2, long + " KW09999x"), (3, "kw00007x"), (4, "xxABxx"), (5, None), (6, ""), (7, "nothing"), (8, "Q")]
    df = spark.createDataFrame(texts, "k int, t string")
    got = {r.k: (r.manufacturer, r.model) for r in substring_lookup(df, "t", d).collect()}
    assert got == {1: ("Late", "Kw00007"), 2: ("M9999", "KW09999X"), 3: ("M7", "KW00007X"), 4: ("Two", "ab"), 5: (None, None),
                   6: (None, None), 7: (None, None), 8: ("One", "q")}
    rows = text_grams(df.where("k = 1").withColumn("_id", F.lit("x")), "t", [1, 2, 3]).count()
    assert rows < 5_000 < len(long)  # one row a distinct gram, not one a position and length
    assert gram_index(d.model_side()).count() == 10_003
