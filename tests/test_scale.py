"""Steps that must not shuffle or store expanded rows: one shuffle by document, few lookups broadcast, grids that nobody
reads not built, chunks dealt over tasks; the same rows on every path."""

import re

import pytest
from pyspark.sql import functions as F

from certloom.functions import fields, ids
from certloom.operators.expand import explode_ids
from certloom.plans import carriers, catalog, pipeline
from certloom.plans.carriers import fixture_dictionary
from certloom.sources.readers import PAGE_GRIDS_SCHEMA

SF = "/root/testdata/sf0.001"


def grid(ident, qty, cert):
    return [[f"Report Number: {cert}\nDate of Thorough Examination: 01/02/2024\nJob Number: 7"], ["x"], ["x"],
            ["Identification Number", "Quantity", "Description of Equipment", "SWL"],
            [ident, str(qty), "Chain Block TIGER TCB14", "5te"]]


PAGES = [("a", "p", 1, "Sparrows", [grid("X1 to X9", 9, "C1")]), ("a", "p", 2, "s", [grid("X5 to X9", 3, "C2")]),
         ("a", "p", 3, "s", [grid("X1", 1, "C3")]), ("a", "p", 4, "s", [grid("X7,X7,Y", 2, "C4")]),
         ("b", "p", 1, "Sparrows", [grid("Z1 to Z40", 40, "C5")]), ("b", "p", 2, "s", [grid("Z1 to Z40", 40, "C6")]),
         ("c", "p", 1, "Sparrows", [grid("W", 1, "C7")]), ("c", "p", 2, "s", [])]


def outcomes_of(spark):
    return catalog.page_outcomes(spark.createDataFrame(PAGES, PAGE_GRIDS_SCHEMA), "Sparrows")


def rows(df):
    return sorted((r.doc_id, r.place_no, r.id_number, tuple(r.first_pos), r.certificate_no, r.manufacturer)
                  for r in df.collect())


@pytest.mark.parametrize("limit", [1 << 19, 20])
def test_in_place_as_spread(spark, monkeypatch, limit):
    """Documents expanded in place, those over the limit over many tasks, and the lazy path: the same items."""
    monkeypatch.setattr(pipeline, "CLUSTER_IDS", limit)
    out, d = outcomes_of(spark), fixture_dictionary(spark)
    got = rows(pipeline.items_of(out, d, numbered=True))
    assert got == rows(pipeline.items_of(out, d, stored=False, numbered=True))
    assert [(p, i, c) for doc, p, i, _, c, _ in got if doc == "a"] == [
        (1, "X1", "C3"), (2, "X2", "C1"), (3, "X3", "C1"), (4, "X4", "C1"), (5, "X5", "C2"), (6, "X6", "C2"),
        (7, "X7", "C4"), (8, "X8", "C1"), (9, "X9", "C1"), (10, "Y", "C4")]
    assert {c for doc, _, _, _, c, _ in got if doc == "b"} == {"C6"} and len(got) == 51


def test_one_shuffle_of_unexpanded_items(spark):
    """Past any automatic broadcast the items are shuffled once, by document."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items = pipeline.items_of(outcomes_of(spark), fixture_dictionary(spark), numbered=True)
        plan = items._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "hashpartitioning(doc_id" in plan
        assert plan.count("BroadcastHashJoin") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("limit", [1 << 19, 20])
def test_bucketed_outcomes_shuffle_no_item(spark, monkeypatch, limit):
    """Over outcomes in buckets by document no item is shuffled, unless the buckets are too few for the IDs; the items
    are the same."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        d, pages = fixture_dictionary(spark), spark.createDataFrame(PAGES, PAGE_GRIDS_SCHEMA)
        want = rows(pipeline.items_of(catalog.page_outcomes(pages, "Sparrows"), d, numbered=True))
        monkeypatch.setattr(pipeline, "CLUSTER_IDS", limit)
        items = pipeline.items_of(catalog.page_outcomes(pages, "Sparrows", buckets=3), d, numbered=True, buckets=3)
        assert rows(items) == want
        if limit == 1 << 19:
            assert "Exchange hashpartitioning" not in items._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_derived_pages_are_shuffled_once(spark):
    """The shuffle that numbers the lines partitions them by document: storing outcomes adds none, and no grid is
    stored."""
    tasks = carriers.document_tasks(spark, SF)
    for make, args in ((carriers.sparrow_pages, ()), (carriers.first_integrated_pages, ("register",))):
        pages = carriers.apart(make(spark, SF, *args, lines=carriers.numbered(spark, SF, tasks)))
        plan = pages.repartition(tasks, "doc_id")._jdf.queryExecution().executedPlan().toString()
        assert re.findall(r"Exchange hashpartitioning\((\w+)", plan) == ["cast"] and "grids-" not in plan
        key = ["doc_id", "page_no", "text", "tables"]
        assert sorted(map(str, pages.select(key).collect())) == sorted(map(str, make(spark, SF, *args).select(key).collect()))
    plan = catalog.REGISTRY["extract_fi_cells"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_status_builds_no_grid(spark):
    for name in ("document_status_mixed", "sink_manifest"):
        plan = catalog.REGISTRY[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "tables" not in plan and "ExistingRDD" not in plan


def test_routing_is_hashed(spark):
    """A document's client is found without a sort: of several first pages the greatest keyword counts, and a document
    without one stays."""
    pages = spark.createDataFrame([("a", 1, "sparrows centurion"), ("a", 1, "first integrated"), ("a", 2, "Sparrows"),
                                   ("b", 2, "Sparrows"), ("c", 1, " "), ("c", 1, None), ("d", 1, "x"), (None, 1, "CENTURION")],
                                  "doc_id string, page_no int, text string")
    got = {r.doc_id: (r.client, r.blank) for r in pipeline.route_documents(pages).collect()}
    old = pages.where("page_no = 1").groupBy("doc_id").agg(F.max(pipeline.route_keyword(F.col("text"))).alias("c"))
    assert got == {"a": ("Sparrows", False), "b": (None, None), "c": (None, True), "d": (None, False),
                   None: ("Centurion", False)}
    assert {r.doc_id: r.c for r in old.collect()} == {k: c for k, (c, _) in got.items() if k != "b"}
    plan = pipeline.route_documents(pages)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Sort [" not in plan and "HashAggregate" in plan


def test_status_stores_keys_only(spark):
    """Of the lines, the status and the manifest store what keys and texts are made from; the pages stay the same."""
    few, whole = (catalog.mixed_pages(spark, SF, grids=g) for g in (False, True))
    names = ["doc_id", "path", "page_no", "text"]
    assert few.columns == names and sorted(map(str, few.collect())) == sorted(map(str, whole.select(names).collect()))
    import pyarrow.parquet as pq
    (stored,) = {f.rsplit("/", 1)[0] for f in few.inputFiles() if "/lines-" in f}
    assert pq.ParquetDataset(stored.removeprefix("file:").replace("///", "/")).schema.names == ["l_orderkey", "page_no"]


def test_range_chunks_are_dealt(spark):
    plan = catalog.REGISTRY["id_dash_range"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "_chunk" in plan and "Exchange hashpartitioning" in plan
    top = 1 << 62
    segs = F.array(ids.segment(F.lit("A"), F.lit(str(top - 2)), F.lit(4)), ids.segment(F.lit("B"), F.lit("7"), F.lit(5), None, 2))
    d = spark.range(1).select(segs.alias("s"))
    want = [f"A{top - 2 + i}" for i in range(4)] + [f"B{7 + i:02d}" for i in range(5)]
    for tasks in (None, 3):
        got = explode_ids(d, "s", chunk_size=2, tasks=tasks).orderBy("id_idx").collect()
        assert [r.id_number for r in got] == want and [r.id_idx for r in got] == list(range(9))


def test_between_matches_each_pattern_once(spark):
    """The two places are found by one match each, and a capacity before or inside the ID leaves nothing."""
    c = fields.between_matches("t")
    d = spark.createDataFrame([("TZW12 Shackle (blue) 2.0 Tonnes x",), ("2.0 Tonnes TZW12 Shackle",), ("TZW12.5 Kilos x",),
                               ("TZW12 Shackle",), ("none 2.0 Tonnes ",), ("",), (None,)], "t string")
    assert [r[0] for r in d.select(c).collect()] == ["Shackle ", "", "", "Shackle", None, None, None]
    plan = d.select(c)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.split(" AS ")[0].count("regexp_extract_all") == 2 and "RLIKE" not in plan


def test_header_cells_searched_once(spark):
    """A header fold lower-cases each cell once; only cells that name a label reach it, and these feed the first label
    still unset."""
    from certloom.plans import layouts
    schema = "h array<string>, v array<string>"
    d = spark.createDataFrame([
        ([None, "Identification description", "DESCRIPTION swl", "swl quantity", "quantity", "other"],
         ["z", " a ", "x\ny", None, "3.7", "o"]),
        (["swl", "swl", "quantity", "quantity"], [None, " 5te", "x", "2"]), (None, None)], schema)
    for fold in (layouts.sparrow_header_fold, lambda h, v: layouts.centurion_header_fold(h, v, True)):
        plan = d.select(fold(F.col("h"), F.col("v")).alias("s"))._jdf.queryExecution().analyzed().toString()
        assert plan.count("lower(") == 1
    got = [tuple(r.s) for r in d.select(layouts.sparrow_header_fold(F.col("h"), F.col("v")).alias("s")).collect()]
    assert got == [("a", "x y", None, 3), (None, None, "5te", 2), (None, None, None, None)]
    c = spark.createDataFrame([(["Description", "working", "next", "next", "certificate"],
                                ["d\ne", " 5t", "31/02/2024", "1/2/2024", " C1 "])], schema)
    assert tuple(c.select(layouts.centurion_header_fold(F.col("h"), F.col("v"), True).alias("s")).first().s) == (
        "d e", 0, 0, "5t", "01/02/2024", "C1")
